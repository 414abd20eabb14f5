"""Best-fit decreasing packing of token sequences.

Best fit looks for the open bin with the least remaining capacity that still takes a piece. Open
bins are kept by remaining capacity in a segment tree, so the tightest one is found in logarithmic
time. Pieces of one length are alike, and so are bins filled in the same way: the plan is made for
runs of pieces and bins, by the counts per length alone, and is exactly what best-fit decreasing does
piece by piece. Its size depends on the capacity, not on the corpus. Spark tokenizes, numbers the pieces of
each length across all partitions, and places every piece by the run that its number falls into.

Edge cases: a null or empty text is one piece that holds only the end id; repeated rows and null ids
are packed like any others; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastecore.llm.batches import map_arrow, slices, text_of
from tastecore.llm.token_ids import encoder
from tastecore.plans.staging import stage


@dataclass(frozen=True)
class Run:
    """Pieces first .. first + pieces - 1 of a length go to bins from `bin` on, `each` to a bin, from `offset` on."""

    length: int
    first: int
    pieces: int
    bin: int
    each: int
    offset: int


class OpenBins:
    """Runs of alike bins by remaining capacity, under a segment tree of which capacities are there."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.there = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _mark(self, remaining: int) -> None:
        node = self.leaves + remaining
        self.there[node] = bool(self.runs[remaining])
        while node > 1:
            node //= 2
            self.there[node] = self.there[2 * node] or self.there[2 * node + 1]

    def put(self, remaining: int, first: int, count: int) -> None:
        if count and remaining:
            self.runs[remaining].append((first, count))
            self._mark(remaining)

    def take(self, remaining: int) -> tuple[int, int]:
        run = self.runs[remaining].pop()
        self._mark(remaining)
        return run

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that takes `length`."""
        node = self.leaves + length
        while not self.there[node]:
            while node & 1:  # a right child: what is larger lies beyond its parent
                node //= 2
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of this level
                return None
        while node < self.leaves:
            node = 2 * node if self.there[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(counts: Mapping[int, int], capacity: int) -> list[Run]:
    """Where the pieces of each length go, given how many there are of each."""
    bins, plan, used = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        first, left = 0, counts[length]
        while left:
            remaining = bins.tightest(length)
            if remaining is None:
                remaining, start, count = capacity, used, -(-left // (capacity // length))
                used += count
            else:
                start, count = bins.take(remaining)
            each = remaining // length
            placed = min(left, count * each)
            full, rest = divmod(placed, each)
            plan.append(Run(length, first, placed, start, each, capacity - remaining))
            bins.put(remaining - each * length, start, full)
            if rest:
                bins.put(remaining - rest * length, start + full, 1)
            after = full + bool(rest)
            bins.put(remaining, start + after, count - after)
            first, left = first + placed, left - placed
    return plan


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of at most `capacity` tokens, numbered by length within the partition that made them."""
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, number long"
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        numbers: dict[int, int] = defaultdict(int)
        encode = encoder(tokenizer).encode
        for rows in slices(batches):
            out: list[tuple] = []
            for doc_id, ids in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                start, length = 0, (len(ids) - 1) % capacity + 1  # the first piece takes what is over
                for piece in range(-(-len(ids) // capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((doc_id, piece, start, length, crc, part, numbers[length]))
                    numbers[length] += 1
                    start, length = start + length, capacity
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return map_arrow(text_of(docs), run, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece with its place."""
    spark = docs.sparkSession
    # Staged: a piece's number within its partition has to be the same for the counts and for its place.
    made = stage(pieces(docs, tokenizer, end_id, capacity), "pieces")
    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # A length has one row per partition here, whatever its number of pieces.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(counts.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")), "shifts")
    # At most `capacity` rows.
    totals = {r["length"]: r["n"] for r in shifts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = [(r.length, r.first, r.first + r.pieces, r.bin, r.each, r.offset) for r in best_fit_decreasing(totals, capacity)]
    runs = spark.createDataFrame(plan, "length int, run_first long, run_end long, bin long, each long, base long")
    # One row per partition and length: it grows with the corpus, so it is not sent to every task.
    numbered = made.join(shifts.drop("n").hint("merge"), ["part", "length"]).withColumn("number", F.col("number") + F.col("shift"))
    # Broadcast bound: a length either uses up runs of open bins or ends in one, and adds three at most,
    # so there are no more than 4 * capacity runs in all.
    placed = numbered.join(F.broadcast(runs), "length").filter("number >= run_first and number < run_end")
    within = F.col("number") - F.col("run_first")
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("bin") + F.floor(within / F.col("each"))).alias("sequence_id"),
        (F.col("base") + within % F.col("each") * F.col("length")).alias("offset"),
    )
