"""Hard negatives: rows of another label whose score is high, but below a share of a positive's score.

Every vector is summarised by segments of its components, each with its mean and its deviation (the root of the summed
squared differences from the mean). Over a segment of n components the inner product is n * mean * mean give or take
deviation * deviation (Cauchy and Schwarz), so sums over segments bound the score from both sides. Segments are refined
hierarchically: pairs that the coarse segments can't exclude are met with finer ones, and only what is left is multiplied
exactly, in integers.

Vectors are stored in pages, with their summaries. Anchors come in blocks; a task takes one block through a shard of
pages and keeps the best of each anchor so far, so the scores to beat rise as it goes. A first search
finds the positives (same label); a second one keeps, for each positive, the best scores inside its window
[low * positive, high * positive]; a pair is excluded when no window can still take it. Equal vectors of one label are one
entry with its smallest ids.

Edge cases: rows with a null label or id, or a vector that can't be compared (see `vectors.usable`), take no part; a repeated
anchor id asks once, with the row that is smallest by label and vector, and no row of that id is its own positive or
negative; ties go to the smaller id; an anchor without positives, or a positive without rows in its window, has no rows;
scores beyond 64 bits stop at the largest ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.llm.batches import map_arrow, ship_package, slices
from tastecore.llm.vectors import ranked, usable
from tastecore.plans.staging import stage

PAGE_ROWS = 1_024
SHARD_PAGES = 32  # pages that one task takes a block of anchors through: 32,768 vectors
ANCHOR_BLOCK = 1_024
LEVELS = (1, 4, 16)  # segments of the summaries, coarse to fine
PAIRS_AT_ONCE = 1 << 18
DENSE = 0.1  # share of pairs from which on matrices are multiplied whole


@dataclass
class Counters:
    """Pairs met, left after each level, and multiplied exactly."""

    pairs: int = 0
    left: list[int] = field(default_factory=lambda: [0] * len(LEVELS))
    exact: int = 0


def levels(dims: int) -> tuple[int, ...]:
    return tuple(n for n in LEVELS if n <= dims) or (1,)


def summaries(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level the means, times the root of the segment's length, and the deviations, one column per segment."""
    out = []
    for n in levels(vectors.shape[1]):
        starts = np.linspace(0, vectors.shape[1], n + 1).astype(int)
        means, deviations = np.empty((len(vectors), n)), np.empty((len(vectors), n))
        for s, (a, b) in enumerate(zip(starts, starts[1:])):
            part = vectors[:, a:b].astype(float)
            mean = part.mean(1)
            means[:, s] = mean * np.sqrt(b - a)
            deviations[:, s] = np.sqrt(((part - mean[:, None]) ** 2).sum(1))
        out.append((means, deviations))
    return out


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of paired rows; beyond 64 bits the largest integers."""
    if not len(a):
        return np.empty(0, np.int64)
    most = a.shape[1] * float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max())
    if most < 2**53:
        return np.einsum("ij,ij->i", a.astype(float), b.astype(float)).astype(np.int64)
    limit = np.iinfo(np.int64)
    return np.array([min(max(sum(x * y for x, y in zip(p, q)), limit.min), limit.max) for p, q in zip(a.tolist(), b.tolist())], np.int64)


class Best:
    """For each anchor and window the `keep` best nodes so far, by score and smallest id, and the score to beat.

    Windows are given by their least and largest score. Positives have one window that takes every score.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int) -> None:
        self.low, self.high, self.keep = low, high, keep  # anchors x windows, in floats; low > high: none
        self.beat = low.copy()
        self.held = tuple(np.empty(0, np.int64) for _ in range(4))  # cell, score, smallest id, node
        self.least, self.most = self.beat.min(1), high.max(1)  # what any of an anchor's windows can still take

    def add(self, who: np.ndarray, score: np.ndarray, first: np.ndarray, node: np.ndarray) -> None:
        windows = self.low.shape[1]
        fits = (score[:, None] >= self.beat[who]) & (score[:, None] <= self.high[who])
        row, window = np.nonzero(fits)
        if not len(row):
            return
        fresh = (who[row] * windows + window, score[row], first[row], node[row])
        cell, score, first, node = (np.concatenate(x) for x in zip(self.held, fresh))
        order = np.lexsort((node, first, ~score, cell))
        cell, score, first, node = cell[order], score[order], first[order], node[order]
        place = np.arange(len(cell)) - np.searchsorted(cell, cell)
        last = place == self.keep - 1
        self.beat.reshape(-1)[cell[last]] = np.maximum(self.beat.reshape(-1)[cell[last]], score[last])
        kept = place < self.keep
        self.held = (cell[kept], score[kept], first[kept], node[kept])
        self.least = self.beat.min(1)


def _products(a: np.ndarray, b: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray | tuple]:
    """Products of the pairs that are alive, and their places: by matrices where many are, else pair by pair."""
    if alive.mean() > DENSE:
        return a @ b.T, np.s_[:, :]
    who, where = np.nonzero(alive)
    return np.einsum("ij,ij->i", a[who], b[where]), (who, where)


def search_page(best: Best, anchors: np.ndarray, anchor_labels: np.ndarray, own, page: dict, same: bool, counters: Counters | None = None) -> None:
    """Meet all anchors with one page: coarse bounds, finer bounds, exact scores."""
    counters = Counters() if counters is None else counters
    at_once = max(1, PAIRS_AT_ONCE // max(1, len(page["labels"])))
    most_apart = anchors.shape[1] * float(np.abs(anchors.astype(float)).max(initial=0)) * float(np.abs(page["vectors"].astype(float)).max(initial=0))
    for start in range(0, len(anchors), at_once):
        rows = slice(start, start + at_once)
        alive = (anchor_labels[rows, None] == page["labels"]) == same
        counters.pairs += int(alive.sum())
        shape = alive.shape
        least, most = np.broadcast_to(best.least[rows, None], shape), np.broadcast_to(best.most[rows, None], shape)
        for level, ((mean, deviation), (page_mean, page_deviation)) in enumerate(zip(own, page["summary"])):
            middle, at = _products(mean[rows], page_mean, alive)
            reach, _ = _products(deviation[rows], page_deviation, alive)
            reach = reach + 1e-9 * (1 + reach + np.abs(middle))  # rounding
            alive[at] &= (middle + reach >= least[at]) & (middle - reach <= most[at])
            counters.left[level] += int(alive.sum())
        counters.exact += int(alive.sum())
        if most_apart < 2**53 and alive.mean() > DENSE:
            score = anchors[rows].astype(float) @ page["vectors"].astype(float).T
            alive &= (score >= least) & (score <= most)
            who, where = np.nonzero(alive)
            best.add(who + start, score[who, where].astype(np.int64), page["firsts"][where], page["nodes"][where])
        else:
            who, where = np.nonzero(alive)
            score = exact(anchors[rows][who], page["vectors"][where])
            best.add(who + start, score, page["firsts"][where], page["nodes"][where])


PAGE = "page long, nodes binary, firsts binary, labels binary, vectors binary, means binary, deviations binary"
PAGE_NAMES = [c.split()[0] for c in PAGE.split(", ")]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors with their summaries, PAGE_ROWS at a time."""
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []

    def full() -> pa.RecordBatch:
        nonlocal number
        number += 1
        vectors = np.concatenate([_matrix(r.column(3)) for r in held]).astype(np.int64)
        nodes, firsts, labels = (np.concatenate([r.column(i).to_numpy() for r in held]).astype(np.int64) for i in range(3))
        summary = summaries(vectors)
        row = (number, nodes.tobytes(), firsts.tobytes(), labels.tobytes(), vectors.tobytes(), np.hstack([m for m, _ in summary]).tobytes(), np.hstack([d for _, d in summary]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i == 0 else pa.binary()) for i, v in enumerate(row)], names=PAGE_NAMES)

    for rows in slices(batches):
        held.append(rows)
        if sum(r.num_rows for r in held) >= PAGE_ROWS:
            yield full()
            held = []
    if held:
        yield full()


def _read_page(row: dict) -> dict:
    nodes = np.frombuffer(row["nodes"], np.int64)
    vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(nodes), -1)
    means, deviations = (np.frombuffer(row[k]).reshape(len(nodes), -1) for k in ("means", "deviations"))
    ends = np.cumsum(levels(vectors.shape[1]))
    parts = [slice(e - n, e) for n, e in zip(levels(vectors.shape[1]), ends)]
    firsts, labels = (np.frombuffer(row[k], np.int64) for k in ("firsts", "labels"))
    return {"nodes": nodes, "firsts": firsts, "labels": labels, "vectors": vectors, "summary": [(means[:, p], deviations[:, p]) for p in parts]}


FOUND = "anchor_id long, place int, score long, first long, node long"


def _search(anchors: pa.Table, pages: pa.Table, keep: int, same: bool) -> pa.Table:
    """One block of anchors through one shard of pages."""
    ids, labels = (anchors.column(c).to_numpy() for c in ("anchor_id", "label"))
    columns = [c.combine_chunks() for c in (anchors.column("vector"), anchors.column("low"), anchors.column("high"))]
    vectors, low, high = (_matrix(c) for c in columns)
    best, own = Best(low.astype(float).copy(), high.astype(float), keep), summaries(vectors)
    for batch in pages.to_batches(max_chunksize=1):
        for row in batch.to_pylist():
            search_page(best, vectors, labels, own, _read_page(row), same)
    cell, score, first, node = best.held
    windows = low.shape[1]
    out = (ids[cell // windows], (cell % windows + 1).astype(np.int32), score, first, node)
    return pa.table(dict(zip(("anchor_id", "place", "score", "first", "node"), map(pa.array, out))))


def _met(anchors: DataFrame, pages: DataFrame, keep: int, same: bool) -> DataFrame:
    """(anchor_id, place, node, score): at least the `keep` best of every window, from each shard of pages.

    A group holds one block of anchors and one shard of pages, both of bounded size.
    """
    blocks = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    shards = max(1, -(-pages.count() // SHARD_PAGES))

    def number(key: str, most: int):
        return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(most)).cast("int")

    def every(most: int):
        return F.explode(F.sequence(F.lit(0), F.lit(most - 1)))

    left = anchors.select("*", number("anchor_id", blocks).alias("block")).select("*", every(shards).alias("shard"))
    right = pages.select("*", number("page", shards).alias("shard")).select("*", every(blocks).alias("block"))
    ship_package(anchors)
    grouped = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard"))
    return grouped.applyInArrow(lambda a, p: _search(a, p, keep, same), FOUND)


def hard_negatives(
    table: DataFrame, anchors: DataFrame, label: str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale * x). Each anchor (`anchors`: their vec_id) has its `positives` best
    rows of its label; each of those, the `negatives` best rows of other labels between `low` and `high` percent of its score.
    """
    whole = F.transform("vector", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("vector")
    rows = usable(table.filter(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("long")), also=["_label"])
    rows = stage(rows.select("vec_id", F.col("_label").alias("label"), whole), "vectors")
    # Equal vectors of one label are one entry; a window of `negatives` rows needs no more of its ids, a positive one more.
    keyed = rows.select("vec_id", F.struct("label", "vector").alias("entry"))
    few = ranked(keyed, "entry", [F.asc("vec_id")], max(positives, negatives) + 1)
    listed = few.groupBy("entry").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    # Numbered, as a repeated id may be the smallest one of several entries.
    entries = stage(listed.select(F.monotonically_increasing_id().alias("node"), "ids", F.get("ids", F.lit(0)).alias("first"), "entry"), "entries")
    members = entries.select("node", F.explode("ids").alias("vec_id"))
    pages = stage(map_arrow(entries.select("node", "first", "entry.label", "entry.vector"), _pages, PAGE), "pages")
    asked = rows.join(anchors.select("vec_id").distinct(), "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("entry"))
    asked = stage(asked.select(F.col("vec_id").alias("anchor_id"), "entry.label", "entry.vector"), "anchors")

    def best(found: DataFrame, most: int) -> DataFrame:
        """The first `most` rows for each anchor and place."""
        key = F.struct("anchor_id", "place").alias("key")
        nodes = ranked(found.select(key, "node", "first", "score"), "key", [F.desc("score"), F.asc("first")], most + 1).drop("rank")
        own = nodes.join(members, "node").filter("vec_id <> key.anchor_id")
        return ranked(own, "key", [F.desc("score"), F.asc("vec_id")], most).select("key.anchor_id", "key.place", "rank", "vec_id", "score")

    everything = asked.select("*", F.array(F.lit(float("-inf"))).alias("low"), F.array(F.lit(float("inf"))).alias("high"))
    first = best(_met(everything, pages, positives + 1, True), positives)
    first = stage(first.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Windows in whole numbers: a score of 100 * s >= low * p is one of s >= ceil(low * p / 100). At most `positives` each.
    p = F.col("positive_score").cast("decimal(38,0)")
    least, most = F.ceil(p * low / 100).cast("double"), F.floor(p * high / 100).cast("double")
    by_place = first.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", least.alias("low"), most.alias("high")))).alias("windows"))

    def bounds(name: str, none: float):
        """A window for every place, empty where there is no positive."""
        return F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get("windows", i).getField(name), F.lit(none))).alias(name)

    windows = asked.join(by_place, "anchor_id").select("anchor_id", "label", "vector", bounds("low", float("inf")), bounds("high", float("-inf")))
    second = best(_met(stage(windows, "windows"), pages, negatives + 1, False), negatives)
    joined = second.join(first, ["anchor_id", "place"])
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
