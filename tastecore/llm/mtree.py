"""Exact top-k inner products by best-first search over an M-tree.

The tree has two levels of routing objects over pages of vectors. A routing object keeps its covering
radius and its distance to its parent; a page keeps the least and largest distance of its entries to
their routing object, and every entry its own. By the triangle inequality no entry within distance r of p
scores above q.p + |q| r, and q.p itself is at most q.u + |q| d(p, u) with the parent u, so nodes are
discarded without computing q.p, and entries without computing q.x.

Search is best-first in two steps, in bulk over all queries: each query reads the most promising leaf
first, which gives it a score to beat; then all nodes whose bound reaches that score. Routing objects
are drawn by a hash (at most `ROUTING`) and sent to the tasks; vectors are only dealt out in pages of
bounded size, a page for each block of queries that needs it. Equal vectors are one entry.

Edge cases: see `vectors.usable`; scores beyond 64 bits stop at the largest ones; ties go to the smaller
id; repeated rows are rows of their own unless their id repeats too, then either is a candidate of the other's
queries only under another id; without candidates a query has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.llm.batches import map_arrow, slices
from tastecore.llm.vectors import classes, drawn, ranked, usable
from tastecore.plans.staging import stage

ROUTING = 4_096  # leaf routing objects at most
LEAF_ROWS = 512  # vectors for which another routing object is drawn, up to ROUTING
PAGE_ROWS = 1_024
QUERY_BLOCK = 2_048


@dataclass(frozen=True)
class Routing:
    """Upper objects `u`, leaf objects `p` with their parent, distance to it, and covering radii."""

    u: np.ndarray
    p: np.ndarray
    parent: np.ndarray
    parent_distance: np.ndarray
    radius: np.ndarray | None = None
    upper_radius: np.ndarray | None = None


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0))


def _routing(sample: np.ndarray) -> Routing:
    u = sample[:: max(1, int(np.sqrt(len(sample))))]
    far = _distances(sample, u)
    parent = far.argmin(1)
    return Routing(u, sample, parent, far[np.arange(len(sample)), parent])


def _matrix(column: pa.Array) -> np.ndarray:
    """An array column as integers, one row per vector."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


PAGE_SCHEMA = "page long, leaf int, nearest double, farthest double, nodes binary, apart binary, vectors binary"


def _assign(batches: Iterator[pa.RecordBatch], routing: Routing) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        far = _distances(_matrix(rows.column(1)).astype(float), routing.p)
        leaf = far.argmin(1)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(leaf, pa.int32()), pa.array(far[np.arange(len(leaf)), leaf])],
            names=["node", "vector", "leaf", "apart"],
        )


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most PAGE_ROWS entries of one leaf, in order of their distance."""
    number = TaskContext.get().partitionId() << 32
    names = [c.split()[0] for c in PAGE_SCHEMA.split(", ")]
    kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary())
    held: list[tuple[int, np.ndarray, float]] = []
    current = None

    def full() -> pa.RecordBatch:
        apart = np.array([h[2] for h in held])
        row = (number, current, apart[0], apart[-1], np.array([h[0] for h in held]).tobytes(), apart.tobytes(), np.stack([h[1] for h in held]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    for rows in slices(batches):
        for node, vector, leaf, apart in zip(rows.column(0).to_pylist(), _matrix(rows.column(1)), rows.column(2).to_pylist(), rows.column(3).to_pylist()):
            if held and (leaf != current or len(held) == PAGE_ROWS):
                yield full()
                number, held = number + 1, []
            current = leaf
            held.append((node, vector, apart))
    if held:
        yield full()


def _route(batches: Iterator[pa.RecordBatch], routing: Routing, first: bool) -> Iterator[pa.RecordBatch]:
    """(query_id, leaf, center score): the most promising leaf, or all whose bound reaches the score to beat."""
    for rows in slices(batches):
        q = _matrix(rows.column(1)).astype(float)
        norm = np.sqrt((q * q).sum(1))[:, None]
        if first:
            center = q @ routing.p.T
            leaf = center.argmax(1)
            who, where, score = np.arange(len(q)), leaf, center[np.arange(len(q)), leaf]
        else:
            beat = np.array([-np.inf if b is None else b for b in rows.column(2).to_pylist()])[:, None]
            slack = 1e-9 * (1 + np.abs(beat))
            upper = q @ routing.u.T
            open_upper = upper + norm * routing.upper_radius >= beat - slack
            near = upper[:, routing.parent] + norm * (routing.parent_distance + routing.radius) >= beat - slack
            who, where = np.nonzero(open_upper[:, routing.parent] & near)  # the others need no product with p
            score = np.einsum("ij,ij->i", q[who], routing.p[where])
            reach = score + norm[who, 0] * routing.radius[where] >= (beat - slack)[who, 0]
            who, where, score = who[reach], where[reach], score[reach]
        yield pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(who)), pa.array(where, pa.int32()), pa.array(score, pa.float64())],
            names=["query_id", "leaf", "center"],
        )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows, exact; beyond 64 bits the largest integers."""
    most = a.shape[1] * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    limit = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limit.min, limit.max).astype(np.int64)


def _last_kept(score: np.ndarray, keep: int) -> np.ndarray:
    """The `keep`-th largest score of each row; minus infinity where there are fewer."""
    if score.shape[1] < keep:
        return np.full(len(score), -np.inf)
    return np.partition(score, score.shape[1] - keep, axis=1)[:, score.shape[1] - keep].astype(float)


def _score(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Per page and block of queries: the `keep` best entries of each query."""
    for rows in slices(batches, 1):
        row = rows.to_pylist()[0]
        nodes, apart = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["apart"])
        vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(nodes), -1)
        asked = row["asked"]
        q = np.array([a["vector"] for a in asked], np.int64).reshape(len(asked), -1)
        center, beat = np.array([a["center"] for a in asked]), np.array([-np.inf if a["beat"] is None else a["beat"] for a in asked])
        norm = np.sqrt((q.astype(float) ** 2).sum(1))
        # Entries are in order of their distance: those too near their routing object for every query are not computed.
        reach = ((beat - 1e-9 * (1 + np.abs(beat)) - center) / np.maximum(norm, 1e-300)).min(initial=np.inf)
        from_entry = int(np.searchsorted(apart, reach * (1 - 1e-12))) if np.isfinite(reach) else 0
        nodes, vectors = nodes[from_entry:], vectors[from_entry:]
        score = products(q, vectors)
        who, place = np.nonzero(score >= np.maximum(beat, _last_kept(score, keep))[:, None])
        order = np.lexsort((nodes[place], -score[who, place], who))
        who, place = who[order], place[order]
        first = np.arange(len(who)) - np.searchsorted(who, who) < keep  # equal scores: the smaller ids
        who, place = who[first], place[first]
        ids = np.array([a["query_id"] for a in asked], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[who]), pa.array(nodes[place]), pa.array(score[who, place])], names=["query_id", "node", "score"]
        )


class MTree:
    def __init__(self, entries: DataFrame, total: int) -> None:
        """`entries`: (node, vector array<long>), one row per distinct vector."""
        leaves = min(ROUTING, -(-total // LEAF_ROWS))
        sample = sorted(drawn(entries, "node", leaves, total).collect() or entries.orderBy("node").limit(1).collect())
        routing = _routing(np.array([r["vector"] for r in sample], float))
        assigned = map_arrow(entries, lambda rows: _assign(rows, routing), "node long, vector array<long>, leaf int, apart double")
        ordered = assigned.repartitionByRange("leaf", "apart", "node").sortWithinPartitions("leaf", "apart", "node")
        self.pages = stage(map_arrow(ordered, _pages, PAGE_SCHEMA), "pages")
        radius = np.zeros(len(routing.p))
        for r in self.pages.groupBy("leaf").agg(F.max("farthest").alias("r")).collect():  # at most ROUTING rows
            radius[r["leaf"]] = r["r"]
        upper = np.zeros(len(routing.u))
        np.maximum.at(upper, routing.parent, routing.parent_distance + radius)
        self.routing = Routing(routing.u, routing.p, routing.parent, routing.parent_distance, radius, upper)

    def _visit(self, queries: DataFrame, first: bool, blocks: int, keep: int) -> DataFrame:
        routing = self.routing
        routed = map_arrow(queries.select("query_id", "vector", "beat"), lambda rows: _route(rows, routing, first), "query_id long, leaf int, center double")
        asked = routed.join(queries, "query_id")
        pages = self.pages.select("page", "leaf", "farthest")
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
        reach = F.col("beat").isNull() | (F.col("center") + norm * F.col("farthest") >= F.col("beat") - 1e-9 * (1 + F.abs("beat")))
        cells = asked.join(pages, "leaf").filter(reach).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
        # A list holds the queries of one block, about QUERY_BLOCK.
        lists = cells.groupBy("page", "block").agg(F.collect_list(F.struct("query_id", "vector", "center", "beat")).alias("asked"))
        work = lists.join(self.pages.select("page", "nodes", "apart", "vectors"), "page").select("nodes", "apart", "vectors", "asked")
        found = map_arrow(work, lambda rows: _score(rows, keep), "query_id long, node long, score long")
        return ranked(found, "query_id", [F.desc("score"), F.asc("node")], keep)

    def search(self, queries: DataFrame, count: int, keep: int) -> DataFrame:
        """(query_id, node, score): the `keep` best entries of each query (query_id, vector array<long>)."""
        blocks = max(1, -(-count // QUERY_BLOCK))
        nothing = queries.withColumn("beat", F.lit(None).cast("long"))
        seen = self._visit(nothing, True, blocks, keep)
        beat = seen.filter(F.col("rank") == keep).select("query_id", F.col("score").alias("beat"))
        second = stage(queries.join(beat, "query_id", "left").select("query_id", "vector", "beat"), "queries")
        return self._visit(second, False, blocks, keep).drop("rank")


def top_products(table: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows by inner product of floor(256 * x), exact.

    `queries` holds the vec_id of the rows that ask.
    """
    rows = usable(table).select("vec_id", F.transform("vector", lambda x: F.floor(F.lit(256.0) * x).cast("long")).alias("vector"))
    rows = stage(rows, "vectors")
    asked = stage(rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi").dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), "vector"), "queries")
    entries, members = (stage(x, "classes") for x in classes(rows, "vector", k + 1))
    total, count = entries.count(), asked.count()
    schema = "query_id long, rank int, vec_id long, score long"
    if not total or not count:
        return table.sparkSession.createDataFrame([], schema)
    best = MTree(entries, total).search(asked, count, k + 1)
    found = best.join(members, "node").filter("vec_id <> query_id")
    return ranked(found, "query_id", [F.desc("score"), F.asc("vec_id")], k).select("query_id", "rank", "vec_id", "score")
