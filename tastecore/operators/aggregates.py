"""Group-by aggregates. Sums and counts are combined before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastecore.functions import at_most
from tastecore.operators.gram import correlations
from tastecore.plans.ordering import rank_within

# Columns aggregated together: keeps the compiled aggregate small; the result does not depend on it.
COLUMNS_AT_ONCE = 50


def count_by(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, largest first."""
    return df.groupBy(col).count().orderBy(F.desc("count"), col)


def song_popularity(triplets: DataFrame) -> DataFrame:
    return triplets.groupBy("song_id").agg(F.sum("playcount").alias("playcount"))


def matched_popularity(triplets: DataFrame, mismatches: DataFrame) -> DataFrame:
    """Popularity of the songs that are not mismatched, summed per song before the anti join.

    A song goes as a whole, so this equals summing what the anti join leaves; but rows of a hot
    song are combined map-side, and the join sees one row per song.
    """
    return song_popularity(triplets).join(mismatches.select("song_id"), "song_id", "left_anti")


def user_activity(triplets: DataFrame) -> DataFrame:
    return triplets.groupBy("user_id").agg(F.count("song_id").alias("songcount"))


def most_active(triplets: DataFrame, k: int = 1) -> DataFrame:
    """Users with the most plays and their number of songs."""
    totals = triplets.groupBy("user_id").agg(
        F.sum("playcount").alias("playcount"), F.count("song_id").alias("songs")
    )
    return totals.orderBy(F.desc("playcount"), "user_id").limit(k)


def songs_of(triplets: DataFrame, users: DataFrame) -> DataFrame:
    """Triplets of a few users as rows, in place of one list per user."""
    return triplets.join(users.select("user_id"), "user_id", "left_semi")


def ordered_rows(df: DataFrame, by: str, order: Sequence[Column | str]) -> DataFrame:
    """All rows with their position inside the group, from 1; no list is built."""
    return rank_within(df, [by], order)


def top_rows(df: DataFrame, by: str, order: Sequence[Column | str], k: int) -> DataFrame:
    """The first k rows of every group with their position, from 1.

    Catalyst pushes the rank limit below the shuffle, so a task sends k rows
    per group at most and a hot group costs no more than a small one.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("position", place).filter(F.col("position") <= k)


def ordered_lists(df: DataFrame, by: str, item: str, order: Sequence[Column | str], k: int) -> DataFrame:
    """The first k items of every group as an array, in order."""
    pairs = F.sort_array(F.collect_list(F.struct("position", item)))
    return top_rows(df, by, order, k).groupBy(by).agg(pairs.getField(item).alias("items"))


def short_lists(df: DataFrame, by: str, order: Sequence[str], item: str) -> DataFrame:
    """All items of every group as one array, in order. For groups that the data keep short (the lines of an
    order); where a group can grow with the table use `ordered_rows`.
    """
    pairs = F.sort_array(F.collect_list(F.struct(*order, item)))
    return df.groupBy(by).agg(pairs.getField(item).alias("items"))


def collect_distinct(df: DataFrame, col: str) -> DataFrame:
    """The distinct values as rows; one row holding all of them would not scale."""
    return df.select(col).distinct()


def stage_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several stages as rows (stage, rows)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def distinct_count(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column as one row; null counts as a value.

    Counted per column by a plain two-step group-by, as several count(distinct)
    in one aggregate would multiply the rows.
    """
    if approx:
        return df.agg(
            *[(F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in cols]
        )
    counts = [df.select(c).distinct().agg(F.count(F.lit(1)).alias(c)).scalar().alias(c) for c in cols]
    return df.sparkSession.range(1).select(*counts)


def cap_fractions(df: DataFrame, label: str, cap: int = 5000, also: Sequence[str] = ()) -> DataFrame:
    """Rows per class and the fraction that brings the class down to `cap`."""
    return df.groupBy(*also, label).count().withColumn("fraction", at_most("count", cap)).orderBy(label)


def balance_fractions(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the fraction that brings it down to the smallest class."""
    counts = df.groupBy(label).count()
    smallest = counts.agg(F.min("count")).scalar()
    return counts.withColumn("fraction", smallest / F.col("count"))


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min and max, one row per numeric column."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])

    def stats(c: str) -> list[Column]:
        return [
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        ]

    def described(part: Sequence[str]) -> DataFrame:
        row = numbers.agg(*[F.struct(*stats(c)).alias(c) for c in part])
        return row.unpivot([], list(part), "column", "s").select("column", "s.*")

    parts = [cols[i : i + COLUMNS_AT_ONCE] for i in range(0, len(cols), COLUMNS_AT_ONCE)]
    return reduce(DataFrame.unionByName, map(described, parts))


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Pearson correlations as rows (i, j, corr), rounded; NaN for a constant column, and 1 of a column with itself."""
    cols = list(cols)
    names = F.array(*[F.lit(c) for c in cols])
    found = correlations(df, cols)
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    return found.select(F.get(names, F.col("i")).alias("i"), F.get(names, F.col("j")).alias("j"), (F.round("corr", digits) + F.lit(0.0)).alias("corr"))
