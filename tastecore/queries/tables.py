"""Inputs of the registered queries, as DataFrames and as SQL.

Play-count triplets are the quantities a customer ordered of a part; the
mismatched songs are the parts of size 1.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastecore.functions import binary_label
from tastecore.operators.aggregates import matched_popularity
from tastecore.operators.joins import active_triplets, remove_mismatches
from tastecore.operators.sampling import user_holdout
from tastecore.plans.staging import stage

KEYS = ["user_id", "song_id"]
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("song_id"))
        .agg(F.sum("l_quantity").cast("int").alias("playcount"))
    )


def mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter("p_size = 1").select(F.col("p_partkey").alias("song_id"))


def triplets_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triplets written out once, as the stored table that an analysis of several steps starts from."""
    return stage(triplets(spark, sf_dir), "triplets")


def matched(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Triplets without mismatched songs; `stored` where more than one step reads them."""
    rows = triplets_table(spark, sf_dir) if stored else triplets(spark, sf_dir)
    return remove_mismatches(rows, mismatches(spark, sf_dir))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_triplets(triplets_table(spark, sf_dir), mismatches=mismatches(spark, sf_dir))


def popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per song that is not mismatched."""
    return matched_popularity(triplets(spark, sf_dir), mismatches(spark, sf_dir))


def active_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return user_holdout(active(spark, sf_dir), keys=KEYS)


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled vectors with all their components."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        F.concat(F.lit("class_"), F.col("label").cast("string")).alias("genre"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("scfeatures"),
    )


def embedded_binary(spark: SparkSession, sf_dir: str, positive: str = "class_3") -> DataFrame:
    return embedded(spark, sf_dir).withColumn("label", binary_label("genre", positive))


# --- the same inputs as SQL -------------------------------------------------

HASH_SQL = "(('0x' || substr(md5({}), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"


def hash_sql(keys: list[str], salt: str = "") -> str:
    parts = ([f"'{salt}'"] if salt else []) + [f"CAST({k} AS VARCHAR)" for k in keys]
    return HASH_SQL.format(f"concat_ws('|', {', '.join(parts)})")


_TRIPLETS = """triplets AS (
  SELECT o_custkey AS user_id, l_partkey AS song_id, CAST(SUM(l_quantity) AS INTEGER) AS playcount
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)"""
_MATCHED = """matched AS (
  SELECT t.* FROM triplets t WHERE NOT EXISTS (
    SELECT 1 FROM part p WHERE p.p_size = 1 AND p.p_partkey = t.song_id))"""
_TOTALS = """songs AS (
  SELECT song_id, CAST(SUM(playcount) AS BIGINT) AS playcount FROM matched GROUP BY 1),
users AS (SELECT user_id, COUNT(song_id) AS songcount FROM matched GROUP BY 1)"""
_ACTIVE = """active AS (
  SELECT m.* FROM matched m
  WHERE NOT EXISTS (SELECT 1 FROM songs s WHERE s.song_id = m.song_id
      AND s.playcount < (SELECT quantile_disc(playcount, 0.25) FROM songs))
    AND NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = m.user_id
      AND u.songcount < (SELECT quantile_disc(songcount, 0.25) FROM users)))"""
_SPLIT = f"""test AS (SELECT * FROM active WHERE {hash_sql(KEYS)} < 0.3::DOUBLE),
training AS (SELECT * FROM active WHERE {hash_sql(KEYS)} >= 0.3::DOUBLE)"""

TRIPLETS_SQL = f"WITH {_TRIPLETS}"
MATCHED_SQL = f"{TRIPLETS_SQL}, {_MATCHED}, {_TOTALS}"
ACTIVE_SQL = f"{MATCHED_SQL}, {_ACTIVE}, {_SPLIT}"
