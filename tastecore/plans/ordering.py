"""Global positions and running totals without an unpartitioned window.

`Window.orderBy(...)` alone sends every row to one task, and a window per key
sends the whole of a hot key to one task. Here the rows are range sorted, so
a hot key is spread over many partitions ("chunks"); each chunk is summed on
its own and then shifted by the totals of the chunks before it.

The sorted rows are staged: the chunk number of a row has to be the same in
both uses, also when a lost task is run again. The order has to be total
(end it with a unique key), which also keeps the chunks even.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastecore.plans.staging import stage

CHUNK, POSITION = "_chunk", "_position"
# monotonically_increasing_id: partition number above bit 33, row number below.
ROW_BITS = 33


def sorted_chunks(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows range sorted and staged, with POSITION (rising; not without gaps) and CHUNK, the sort partition."""
    numbered = df.orderBy(*order).withColumn(POSITION, F.monotonically_increasing_id())
    return stage(numbered, "sorted").withColumn(CHUNK, F.shiftright(POSITION, ROW_BITS))


_sorted_chunks = sorted_chunks  # its former name, which the tests use


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Row number from 0 in the given total order."""
    chunks = sorted_chunks(df, order)
    # One row per sort partition, so this window is bounded by the partition count.
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        chunks.groupBy(CHUNK)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    row = F.col(POSITION).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # Broadcast bound: one row per sort partition.
    return (
        chunks.join(F.broadcast(shifts), CHUNK)
        .withColumn(name, row + F.col("_shift"))
        .drop(CHUNK, POSITION, "_shift")
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums, per `by` group if given.

    `order` is the order inside a group and has to be total there.
    """
    by = list(by)
    chunks = sorted_chunks(df, [*by, *order])
    inside = (
        Window.partitionBy(*by, CHUNK)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy(*by).orderBy(CHUNK)
    totals = chunks.groupBy(*by, CHUNK).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    keys = [F.col(k).alias(f"_key{i}") for i, k in enumerate([*by, CHUNK])]
    shifts = totals.select(
        *keys,
        F.lag(CHUNK).over(earlier).isNotNull().alias("_continued"),
        *[
            F.sum(n).over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_shift_{n}")
            for n in sums
        ],
    ).filter("_continued")
    same = F.lit(True)
    for i, key in enumerate([*by, CHUNK]):
        same = same & F.col(key).eqNullSafe(F.col(f"_key{i}"))
    local = chunks.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    # Broadcast bound: a border between two chunks cuts one group at most, and a
    # group that fills whole chunks has one row in each, so shifts has no more
    # rows than there are sort partitions.
    joined = local.join(F.broadcast(shifts), same, "left")
    return joined.select(
        *df.columns,
        *[(F.col(n) + F.coalesce(F.col(f"_shift_{n}"), F.lit(0))).alias(n) for n in sums],
    )


def rank_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "position"
) -> DataFrame:
    """Row number from 1 per `by` group; a hot group does not end up in one task."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, by)
