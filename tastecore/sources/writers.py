"""Sinks. `files=None` keeps the partitioning; `files=1` gives a single part file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    files: int | None = None,
    compression: str = "none",
    mode: str = "overwrite",
) -> None:
    out = df.coalesce(files) if files else df
    out.write.mode(mode).csv(path, sep=sep, header=header, compression=compression)


def write_gzip_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    write_delimited(df, path, files=files, compression="gzip")


def preview_json(df: DataFrame, order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first n rows as JSON text; a top-n, so the table is not sorted as a whole."""
    return df.orderBy(*order).limit(n).select(F.to_json(F.struct("*")).alias("json"))
