"""Splits and class-balanced samples, all by key hash: the same rows on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.functions import unit_hash
from tastecore.operators.aggregates import balance_fractions, cap_fractions
from tastecore.plans.staging import stage


def hash_split(
    df: DataFrame, keys: Sequence[str], fraction: float, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(kept, rest): two complementary row filters, no shuffle."""
    inside = unit_hash(keys, salt) < F.lit(float(fraction))
    return df.filter(inside), df.filter(~inside)


def with_folds(df: DataFrame, keys: Sequence[str], folds: int, name: str = "fold") -> DataFrame:
    """Fold number per row for cross validation."""
    return df.withColumn(name, F.floor(unit_hash(keys, "fold") * folds).cast("int"))


def sample_by(df: DataFrame, fractions: DataFrame, label: str, keys: Sequence[str], salt: str = "") -> DataFrame:
    """Keep each row with the fraction of its class; a class without one is dropped.

    The fractions are staged: one row per class, broadcast only if that is small.
    """
    shares = stage(fractions.select(label, "fraction"), "fractions")
    return (
        df.join(shares, label)
        .filter(unit_hash(keys, salt) < F.col("fraction"))
        .select(*df.columns)
    )


def balance(df: DataFrame, label: str, keys: Sequence[str], salt: str = "balance") -> DataFrame:
    """Sample every class down to the expected size of the smallest one."""
    return sample_by(df, balance_fractions(df, label), label, keys, salt)


def cap_classes(
    df: DataFrame,
    label: str,
    cap: int,
    keys: Sequence[str],
    fractions_from: DataFrame | None = None,
    salt: str = "cap",
) -> DataFrame:
    """Sample every class down to `cap` expected rows of `fractions_from` (df itself by default)."""
    source = df if fractions_from is None else fractions_from
    return sample_by(df, cap_fractions(source, label, cap), label, keys, salt)


def user_holdout(
    df: DataFrame, fraction: float = 0.3, keys: Sequence[str] = ("user", "item")
) -> tuple[DataFrame, DataFrame]:
    """(training, test): every user's rows enter the test with the same chance.

    One fraction for all users is a plain row filter, and training is its
    negation, so neither needs a list of users or an anti join.
    """
    test, training = hash_split(df, keys, fraction)
    return training, test
