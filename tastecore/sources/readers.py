"""Batch readers. Each one is a lazy scan; compressed text is decoded by suffix."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastecore.functions import capitalise, strip_quotes, text_slice
from tastecore.sources.schemas import attribute_path, data_glob, schema_from_attributes


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """A gzip file is one split: spread its rows before costly work if asked to."""
    return df.repartition(partitions) if partitions else df


def read_features(
    spark: SparkSession, name: str, root: str, id_name: str = "track_id", partitions: int | None = None
) -> DataFrame:
    """Headerless CSV parts, typed by the attribute file next to them."""
    root = root.rstrip("/")
    attributes = spark.read.csv(attribute_path(root, name))
    # Rows of several files or splits would come in no certain order.
    if len(attributes.inputFiles()) != 1 or len(attributes.select(F.spark_partition_id()).distinct().collect()) > 1:
        raise ValueError(f"the attributes of {name} have to be one file in one split")
    schema = schema_from_attributes(attributes, id_name=id_name)
    rows = spark.read.schema(schema).csv(data_glob(root, name))
    return _spread(rows.withColumn(id_name, strip_quotes(id_name)), partitions)


def read_tsv(
    spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None
) -> DataFrame:
    return _spread(spark.read.schema(schema).csv(path, sep="\t"), partitions)


def parse_fixed_width(
    lines: DataFrame, fields: Mapping[str, tuple[int, int]], column: str = "value"
) -> DataFrame:
    """Cut text lines into columns; `fields` maps a name to (start from 1, length)."""
    return lines.select(*[text_slice(column, start, n).alias(f) for f, (start, n) in fields.items()])


def read_fixed_width(spark: SparkSession, path: str, fields: Mapping[str, tuple[int, int]]) -> DataFrame:
    return parse_fixed_width(spark.read.text(path), fields)


def read_header_csv(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """All columns as strings, names from the header, empty fields as null."""
    return _spread(spark.read.csv(path, header=True, inferSchema=False), partitions)


def read_parts(
    spark: SparkSession, folder: str, schema: T.StructType, header: bool = False
) -> DataFrame:
    """All part files of a folder as one table; use the header setting it was written with."""
    return spark.read.schema(schema).csv(folder, header=header)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def labelled(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Numeric feature columns as doubles and a capitalised class name."""
    return df.select(
        *[F.col(c).cast("double").alias(c) for c in features],
        capitalise(F.col(label).cast("string")).alias("label"),
    )
