"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

The graph starts from blocks of vectors that lie near each other along random hyperplanes, compared
within the block. Then neighbours of neighbours are joined: around every node, a drawn part of its
neighbours and of the nodes it is a neighbour of are compared with each other, and each keeps its nearest.
A node's part is bounded (AROUND) whatever the number of nodes that name it. Rounds go on until fewer than SETTLED of all
neighbours are new; every change brings a node nearer neighbours, so they end.

Search is greedy over the graph and its reverse, for all queries at once: the nearest nodes seen that
were not opened yet are opened, their neighbours compared, and the nearest `beam` kept, until all of those
are opened. A query starts at drawn entry nodes and, if it is a row of the index, at its own node.

Graph and walk compare the original components, held as they are in the table (float or double), in doubles: the
graph by products around the mean of the vectors that are compared with each other, the walk by differences.
So neither one very long vector nor near copies change what is near.

Equal vectors are one node. Edge cases: see `vectors.usable`; zero vectors take no part; with few
candidates all are returned; ties go to the smaller id; without candidates a query has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tastecore.llm.batches import map_arrow, slices
from tastecore.llm.vectors import drawn, in_classes, ranked, usable
from tastecore.plans.staging import stage

NEIGHBOURS = 30
STARTS, BLOCK, BLOCK_NEIGHBOURS = 8, 512, 15
DRAWN, AROUND = 12, 30  # of a node's neighbours, on average; of those and of the nodes it is a neighbour of, at most
SETTLED = 0.05  # share of new neighbours after which the graph is done
ENTRIES, BEAM, OPENED = 1_024, 200, 100
PLANES = 10

PAIRS = "node long, other long, apart double"


def _codes(codes: Sequence[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(codes), kind).reshape(len(codes), -1).astype(np.float64)


def _apart(a: np.ndarray) -> np.ndarray:
    """Squared distances between all rows; infinite to itself."""
    a = a - a.mean(0)
    square = (a * a).sum(1)
    apart = np.maximum(square[:, None] + square - 2 * (a @ a.T), 0)
    np.fill_diagonal(apart, np.inf)
    return apart


def _pair_batch(node: np.ndarray, other: np.ndarray, apart: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(apart, pa.float64())], names=["node", "other", "apart"])


def _sides(batches: Iterator[pa.RecordBatch], kind: str, planes: np.ndarray, middles: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each set of hyperplanes its number, the sides as one number, and the place along the last."""
    for rows in slices(batches, 4096):
        codes = _codes(rows.column(1).to_pylist(), kind)
        for start, (plane, middle) in enumerate(zip(planes, middles)):
            along = codes @ plane - middle
            side = (along[:, :-1] > 0) @ (1 << np.arange(PLANES)[::-1])
            columns = [rows.column(0), rows.column(1), pa.array(np.full(len(along), start)), pa.array(side, pa.int64()), pa.array(along[:, -1], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "code", "start", "side", "along"])


def _block_pairs(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Nearest rows within runs of at most BLOCK rows of one start."""
    for rows in _regrouped(batches, BLOCK):
        borders = np.flatnonzero(np.diff(rows.column("start").to_numpy())) + 1
        for begin, end in pairwise([0, *borders.tolist(), rows.num_rows]):
            nodes = rows.column("node").to_numpy()[begin:end]
            apart = _apart(_codes(rows.column("code").slice(begin, end - begin).to_pylist(), kind))
            keep = min(BLOCK_NEIGHBOURS, len(nodes) - 1)
            if keep > 0:
                best = np.argpartition(apart, keep - 1, axis=1)[:, :keep]
                yield _pair_batch(np.repeat(nodes, keep), nodes[best].ravel(), np.take_along_axis(apart, best, 1).ravel())


def _regrouped(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of exactly `size`, but for the last."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _around(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Rows (center, node, code, farthest) in order of center: pairs around a center nearer than a node's farthest.

    A node that stands twice around a center counts once.
    """
    held: dict[int, tuple] = {}
    center = None

    def pairs() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes = np.array(list(held), np.int64)
        apart = _apart(_codes([code for code, _ in held.values()], kind))
        i, j = np.nonzero(apart < np.array([far for _, far in held.values()])[:, None])
        return nodes[i], nodes[j], apart[i, j]

    for rows in slices(batches, 4096):
        found = []
        for around, node, code, far in zip(*[c.to_pylist() for c in rows.columns]):
            if held and around != center:
                found.append(pairs())
                held = {}
            center = around
            held[node] = (code, far)
        if found:
            yield _pair_batch(*map(np.concatenate, zip(*found)))
    if held:
        yield _pair_batch(*pairs())


def _nearest(pairs: DataFrame, most: int) -> DataFrame:
    """The `most` nearest different others of each node, `known` if a pair was; one exchange by node serves both steps."""
    once = pairs.repartition("node").groupBy("node", "other").agg(F.min("apart").alias("apart"), F.max("known").alias("known"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("apart", "other"))
    return once.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def build_graph(codes: DataFrame, total: int, kind: str, seed: int = 0) -> DataFrame:
    """(node, other, apart): about the NEIGHBOURS nearest others of each node of (node, code)."""
    sample = drawn(codes, "node", ENTRIES, total).collect() or codes.limit(1).collect()  # about ENTRIES rows
    values = _codes([r["code"] for r in sample], kind)
    planes = np.random.default_rng(seed).normal(size=(STARTS, values.shape[1], PLANES + 1))
    middles = np.median(values @ planes, axis=1)
    # All starts are dealt together: with one exchange each, many partitions would leave short blocks.
    sides = map_arrow(codes, lambda rows: _sides(rows, kind, planes, middles), "node long, code binary, start long, side long, along double")
    order = ["start", "side", "along", "node"]
    blocks = sides.repartitionByRange(*order).sortWithinPartitions(*order).select("node", "code", "start")
    graph = stage(_nearest(map_arrow(blocks, lambda rows: _block_pairs(rows, kind), PAIRS).withColumn("known", F.lit(False)), NEIGHBOURS), "graph")
    for turn in count():
        # A drawn neighbour meets the others around a node, and the node those around its neighbour.
        drawn_edges = graph.withColumn("_draw", F.pmod(F.xxhash64("node", "other", F.lit(turn)), F.lit(1 << 30))).filter(F.col("_draw") < F.lit(int((1 << 30) * DRAWN / NEIGHBOURS)))
        ahead = drawn_edges.select(F.col("node").alias("center"), F.col("other").alias("node"), "_draw")
        back = drawn_edges.select(F.col("other").alias("center"), "node", "_draw")
        farthest = graph.groupBy("node").agg(F.when(F.count(F.lit(1)) >= NEIGHBOURS, F.max("apart")).otherwise(F.lit(float("inf"))).alias("farthest"))
        around = ranked(ahead.unionAll(back).join(codes, "node").join(farthest, "node"), "center", [F.col("_draw"), F.col("node")], AROUND)
        found = map_arrow(around.select("center", "node", "code", "farthest").sortWithinPartitions("center"), lambda rows: _around(rows, kind), PAIRS).withColumn("known", F.lit(False))
        graph = stage(_nearest(graph.withColumn("known", F.lit(True)).unionAll(found), NEIGHBOURS), "graph")
        edges, new = graph.agg(F.count(F.lit(1)), F.count(F.when(~F.col("known"), 1))).head()
        if new <= SETTLED * edges:
            return graph.drop("known")


def _first_nodes(batches: Iterator[pa.RecordBatch], kind: str, entries: np.ndarray, codes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        q = _codes(rows.column(1).to_pylist(), kind)
        apart = (q * q).sum(1)[:, None] + (codes * codes).sum(1) - 2 * q @ codes.T
        best = np.argsort(apart, axis=1)[:, :most]
        ids = rows.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, best.shape[1])), pa.array(entries[best].ravel())], names=["query_id", "node"])


def _measure(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, 4096):
        gap = _codes(rows.column(2).to_pylist(), kind) - _codes(rows.column(3).to_pylist(), kind)
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array((gap * gap).sum(1), pa.float64())], names=["query_id", "node", "apart"])


def greedy_search(graph: DataFrame, codes: DataFrame, queries: DataFrame, total: int, kind: str, most: int = BEAM) -> DataFrame:
    """(query_id, node, apart): the `most` nearest nodes that the walk from each query (query_id, code, node) found.

    `node` is the query's own node in the index, or null.
    """
    sample = sorted(drawn(codes, "node", ENTRIES, total).collect() or codes.limit(1).collect())
    entries = np.array([r["node"] for r in sample], np.int64)
    entry_codes = _codes([r["code"] for r in sample], kind)
    edges = graph.select("node", "other")
    edges = stage(edges.unionAll(edges.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    asked = queries.select("query_id", F.col("code").alias("query_code"))

    def measured(found: DataFrame) -> DataFrame:
        both = found.join(codes, "node").join(asked, "query_id").select("query_id", "node", "code", "query_code")
        return map_arrow(both, lambda rows: _measure(rows, kind), "query_id long, node long, apart double")

    first = map_arrow(queries.select("query_id", "code"), lambda rows: _first_nodes(rows, kind, entries, entry_codes, STARTS), "query_id long, node long")
    first = first.unionAll(queries.filter("node is not null").select("query_id", "node")).distinct()
    new = stage(measured(first), "measured")
    seen, beam = new, new.withColumn("opened", F.lit(False))
    while True:
        kept = ranked(beam, "query_id", [F.col("apart"), F.col("node")], most).drop("rank")
        turn = F.row_number().over(Window.partitionBy("query_id").orderBy("opened", "apart", "node"))
        kept = stage(kept.withColumn("now", ~F.col("opened") & (turn <= OPENED)), "beam")
        opening = kept.filter("now").select("query_id", "node")
        if not opening.head(1):
            return kept.select("query_id", "node", "apart")
        ahead = opening.join(edges, "node").select("query_id", F.col("other").alias("node"), F.lit(False).alias("seen"))
        # One exchange by node serves what is new and the codes.
        met = ahead.unionAll(seen.select("query_id", "node", F.lit(True))).repartition("node").groupBy("query_id", "node").agg(F.max("seen").alias("seen"))
        new = stage(measured(met.filter(~F.col("seen"))), "measured")
        seen = seen.unionAll(new)
        beam = kept.select("query_id", "node", "apart", (F.col("opened") | F.col("now")).alias("opened")).unionAll(new.withColumn("opened", F.lit(False)))


def nearest_rows(table: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found, by Euclidean distance.

    `queries` holds the vec_id of the rows that ask. A vec_id that stands in several rows is one row; of its vectors the smallest.
    """
    rows = stage(usable(table, with_zero=False).groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    placed = stage(in_classes(rows, "vector", k + 1), "classes")
    nodes, members = placed.filter("_place = 1").select("node", "vector"), placed.select("node", "vec_id")
    total = nodes.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return table.sparkSession.createDataFrame([], schema)
    kind = "f4" if isinstance(table.schema["embedding"].dataType.elementType, FloatType) else "f8"
    codes = stage(map_arrow(nodes, lambda batches: _coded(batches, kind), "node long, code binary"), "codes")
    asked = rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    asked = asked.join(nodes, "vector").select(F.col("vec_id").alias("query_id"), "node", "vector")
    asked = stage(asked.join(codes, "node"), "queries")
    close = greedy_search(build_graph(codes, total, kind), codes, asked, total, kind, max(BEAM, k + 1)).select("query_id", "node")
    gap = F.aggregate(F.zip_with("vector", "query_vector", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    exact = close.join(nodes, "node").join(asked.select("query_id", F.col("vector").alias("query_vector")), "query_id")
    exact = exact.select("query_id", "node", F.sqrt(gap).alias("score"))
    others = exact.join(members, "node").filter("vec_id <> query_id")
    return ranked(others, "query_id", [F.col("score"), F.col("vec_id")], k).select("query_id", "rank", "vec_id", "score")


def _coded(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """The components as bytes."""
    for rows in slices(batches):
        values = rows.column(1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([v.astype(kind).tobytes() for v in values], pa.binary())], names=["node", "code"])
