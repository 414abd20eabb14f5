"""Projections, filters, limits and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.operators.quantiles import quantile_value


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename; `names` maps the new name to the old one."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def select_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix)])


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return df.select(*[df.columns[i] for i in positions])


def rename_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position."""
    return df.toDF(*names)


def filter_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop nulls but not NaN, which dropna would take along."""
    return reduce(lambda out, c: out.filter(F.col(c).isNotNull()), cols, df)


def filter_below_quantile(df: DataFrame, col: str, q: float, strict: bool = True) -> DataFrame:
    """Rows below (or at) an exact quantile of the same column.

    The threshold is a literal, so it also reaches the parquet scan.
    """
    threshold = quantile_value(df, col, q)
    return df.filter(F.col(col) < threshold if strict else F.col(col) <= threshold)


def filter_in(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Membership in a literal list, or in the first column of a table."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(col)), col, "left_semi")
    return df.filter(F.col(col).isin(*values))


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == value)


def filter_all(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return reduce(lambda out, item: out.filter(F.col(item[0]) == item[1]), values.items(), df)


def drop_nan(df: DataFrame, col: str) -> DataFrame:
    """Drop NaN and null."""
    return df.filter(F.col(col).isNotNull() & ~F.isnan(col))


def top_k(df: DataFrame, col: str, k: int, keys: Sequence[str]) -> DataFrame:
    """The k largest values; ties are ordered by `keys`."""
    return df.orderBy(F.desc(col), *keys).limit(k)


def top_users(test: DataFrame, k: int) -> DataFrame:
    """Users of the k highest-rated test rows."""
    return top_k(test, "rating", k, ["user", "item"]).select("user").distinct()


def sort_by(df: DataFrame, cols: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*cols)


def limit_n(df: DataFrame, n: int, keys: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
