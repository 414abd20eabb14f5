"""Column helpers. All of them stay inside JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = float(2**32)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_slice(line: Column | str, start: int, length: int) -> Column:
    """Trimmed slice of a fixed-width line; `start` counts from 1."""
    return F.trim(F.substring(as_column(line), start, length))


def strip_quotes(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "'", "")


def capitalise(value: Column | str) -> Column:
    return F.initcap(as_column(value))


def binary_label(value: Column | str, positive) -> Column:
    """1.0 for the positive class, 0.0 for everything else, null included."""
    return F.when(as_column(value) == F.lit(positive), 1.0).otherwise(0.0)


def at_most(count: Column | str, cap: int) -> Column:
    """Sampling fraction that brings `count` rows down to an expected `cap`."""
    count = as_column(count)
    return F.when(count < cap, 1.0).otherwise(F.lit(float(cap)) / count)


def safe_ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom, 0.0 where the denominator is 0 (ANSI division would raise)."""
    top, bottom = as_column(top), as_column(bottom)
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def unit_hash(keys: Sequence[Column | str], salt: str = "") -> Column:
    """A number in [0, 1) that depends on the key values alone.

    A split on it gives the same rows whatever the partitioning and however
    often a lost task is run again, which a seeded random number does not.
    """
    parts = [as_column(k).cast("string") for k in keys]
    if salt:
        parts.insert(0, F.lit(salt))
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(HASH_RANGE)


def project_items(recommendations: Column | str, field: str = "item") -> Column:
    """array<struct<item, rating>> to array<item> by field access, no UDF."""
    return as_column(recommendations).getField(field)
