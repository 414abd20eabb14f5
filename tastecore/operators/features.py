"""Vectors, scaling and string indexing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.plans.ordering import number_rows
from tastecore.plans.staging import stage


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def _scaler(col: str, out: str) -> StandardScaler:
    return StandardScaler(inputCol=col, outputCol=out, withStd=True, withMean=False)


def scale(df: DataFrame, col: str, out: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Divide by the sample stddev, no centring; a constant column becomes 0."""
    return _scaler(col, out).fit(df if fit_on is None else fit_on).transform(df)


def prepare(df: DataFrame, prefix: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Assemble the columns with a prefix into `features` and scale them to `scfeatures`.

    Fitted on all rows unless `fit_on` gives the training rows.
    """
    cols = [c for c in df.columns if c.startswith(prefix)]
    stages = [VectorAssembler(inputCols=cols, outputCol="features"), _scaler("features", "scfeatures")]
    return Pipeline(stages=stages).fit(df if fit_on is None else fit_on).transform(df)


def string_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """(value, code): codes from 0 by falling frequency, ties by value.

    The codes stay a table, as the values can be too many for the driver.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_count"))
    return number_rows(counts, [F.desc("_count"), col], out).select(col, out)


def index_strings(df: DataFrame, col: str, out: str, codes: DataFrame | None = None) -> DataFrame:
    """Add the code of `col` as a double; a value without code is an error."""
    codes = stage(string_codes(df, col, out), "codes") if codes is None else codes
    problem = F.concat(F.lit(f"{col} has no code: "), F.coalesce(F.col(col).cast("string"), F.lit("null")))
    code = F.when(F.col(out).isNull(), F.raise_error(problem)).otherwise(F.col(out))
    return df.join(codes, col, "left").select(*df.columns, code.cast("double").alias(out))


def index_triplets(triplets: DataFrame) -> DataFrame:
    """(user_id, song_id, playcount) to integer (user, item, rating).

    Codes are cast to 32 bits, as ALS needs; more values than that raise.
    """
    users = index_strings(triplets, "user_id", "user")
    both = index_strings(users, "song_id", "item")
    return both.select(
        F.col("user").cast("int"), F.col("item").cast("int"), F.col("playcount").cast("int").alias("rating")
    )
