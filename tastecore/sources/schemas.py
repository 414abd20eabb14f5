"""Schemas: built from an attribute table, or fixed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The names and types the published data set uses.
ID_ALIASES = ("msd_trackid", "track_id", "instancename")
ATTRIBUTE_TYPES = {"real": T.DoubleType(), "numeric": T.DoubleType(), "string": T.StringType()}
FEATURE_SETS = (
    "msd-jmir-area-of-moments-all-v1.0",
    "msd-jmir-lpc-all-v1.0",
    "msd-jmir-methods-of-moments-all-v1.0",
    "msd-jmir-mfcc-all-v1.0",
    "msd-jmir-spectral-all-all-v1.0",
    "msd-jmir-spectral-derivatives-all-all-v1.0",
    "msd-marsyas-timbral-v1.0",
    "msd-mvd-v1.0",
    "msd-rh-v1.0",
    "msd-rp-v1.0",
    "msd-ssd-v1.0",
    "msd-trh-v1.0",
    "msd-tssd-v1.0",
)
TRIPLET_SCHEMA = (
    T.StructType()
    .add("user_id", T.StringType())
    .add("song_id", T.StringType())
    .add("playcount", T.IntegerType())
)
GENRE_SCHEMA = T.StructType().add("track_id", T.StringType()).add("genre", T.StringType())
MISMATCH_FIELDS = {"song_id": (9, 18), "track_id": (28, 18)}


def schema_from_attributes(
    attributes: DataFrame, id_aliases: Iterable[str] = ID_ALIASES, id_name: str = "track_id"
) -> T.StructType:
    """Rows (name, type), in their order, to a schema with every column nullable.

    A schema lives on the driver, so all rows are collected; `read_features` makes sure that
    they come from one file, whose lines keep their order.
    """
    aliases = set(id_aliases)
    pairs = attributes.toDF("name", "type").collect()
    schema = T.StructType()
    for pair in pairs:
        name, kind = pair["name"].lower(), pair["type"].lower()
        if kind not in ATTRIBUTE_TYPES:
            raise ValueError(f"attribute {name}: unknown type {kind}")
        schema.add(id_name if name in aliases else name, ATTRIBUTE_TYPES[kind], True)
    return schema


def attribute_path(root, name):
    """Works on strings and on Columns alike."""
    return root + "/audio/attributes/" + name + ".attributes.csv"


def data_glob(root, name):
    return root + "/audio/features/" + name + ".csv/*"


def feature_catalog(names: DataFrame, root: str) -> DataFrame:
    """One row per feature set: name, path of its attributes, glob of its data."""
    root = root.rstrip("/")
    name = F.col("name")
    return names.select(
        name,
        F.concat(F.lit(root + "/audio/attributes/"), name, F.lit(".attributes.csv")).alias("attr_path"),
        F.concat(F.lit(root + "/audio/features/"), name, F.lit(".csv/*")).alias("data_glob"),
    )
