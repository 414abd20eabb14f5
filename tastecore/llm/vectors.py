"""Vector tables: which rows take part, classes of equal vectors, and binary columns for numpy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(table: DataFrame, with_zero: bool = True, also: Sequence[str] = ()) -> DataFrame:
    """(vec_id, vector array<double>) and the columns `also` of the rows whose vectors can be compared.

    Left out: null ids or vectors, vectors with a null, NaN or infinite component, zero vectors unless
    `with_zero`, and vectors of another length than the most frequent one (the longer, if equally frequent).
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), *also)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite)
    if not with_zero:
        rows = rows.filter(F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().agg(F.max_by("n", F.struct("count", "n")).alias("n"))
    return rows.filter(F.size("vector") == length.scalar())


def classes(rows: DataFrame, vector: str, members: int) -> tuple[DataFrame, DataFrame]:
    """(node, vector) per distinct vector, and (node, vec_id) with its `members` smallest ids; node is the smallest.

    For the k nearest, k + 1 members of a class are enough: equal vectors are equally near, and smaller ids go first.
    Only that many rows of a vector leave any task.
    """
    ranked = in_classes(rows, vector, members)
    return ranked.filter("_place = 1").select("node", vector), ranked.select("node", "vec_id")


def in_classes(rows: DataFrame, vector: str, members: int) -> DataFrame:
    """(node, vector, vec_id, _place): the rows of `classes` in one table, with their places from 1."""
    same = Window.partitionBy(vector).orderBy("vec_id")
    ranked = rows.withColumn("_place", F.row_number().over(same)).filter(F.col("_place") <= members)
    return ranked.withColumn("node", F.min("vec_id").over(Window.partitionBy(vector))).select("node", vector, "vec_id", "_place")


def drawn(rows: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """About `most` rows, chosen by a hash of the key."""
    draw = F.pmod(F.xxhash64(F.lit("drawn"), key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.filter(draw < F.lit(min(1.0, most / max(total, 1))))


def ranked(rows: DataFrame, by: str, order: list[Column], most: int) -> DataFrame:
    """The first `most` rows per key with their rank from 1; tasks send no more than that many per key."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("int")
    return rows.withColumn("rank", rank).filter(F.col("rank") <= most)
