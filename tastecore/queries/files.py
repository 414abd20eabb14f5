"""Sources and sinks. Text inputs are written from the tables, then read back."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastecore import sources
from tastecore.plans import flows
from tastecore.plans.staging import scratch_path
from tastecore.queries.registry import query
from tastecore.queries.tables import table


def _attributes(part: DataFrame) -> DataFrame:
    """Attribute rows from the parts: one name per type and size, one of them an id alias."""
    name = F.concat_ws("_", "p_type", F.col("p_size").cast("string"))
    kind = F.when(F.col("p_size") % 3 == 0, "Real").when(F.col("p_size") % 3 == 1, "NUMERIC").otherwise("String")
    return (
        part.select(
            F.when(name == "PROMO_2", "MSD_TRACKID").otherwise(name).alias("name"), kind.alias("type")
        )
        .distinct()
        .orderBy("name")
    )


@query(
    "attribute_schema",
    """WITH named AS (
  SELECT DISTINCT lower(p_type || '_' || CAST(p_size AS VARCHAR)) AS name, p_size % 3 AS m FROM part)
SELECT CASE name WHEN 'promo_2' THEN 'track_id' ELSE name END AS name,
  CASE m WHEN 2 THEN 'string' ELSE 'double' END AS type FROM named""",
)
def attribute_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = sources.schema_from_attributes(_attributes(table(spark, sf_dir, "part")))
    rows = [(f.name, f.dataType.simpleString()) for f in schema]
    return spark.createDataFrame(rows, "name string, type string")


@query(
    "attribute_csv_scan",
    """SELECT l_extendedprice AS a_1, l_quantity AS a_2,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS track_id FROM lineitem""",
)
def attribute_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, name = scratch_path(spark, "features"), "lines"
    attributes = [("A_1", "real"), ("A_2", "NUMERIC"), ("MSD_TRACKID", "String")]
    sources.write_delimited(
        spark.createDataFrame(attributes, "name string, type string").coalesce(1),
        sources.schemas.attribute_path(root, name),
        header=False,
    )
    quoted = F.concat(F.lit("'"), F.col("l_orderkey"), F.lit("-"), F.col("l_partkey"), F.lit("'"))
    lines = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", quoted)
    sources.write_delimited(lines, sources.schemas.data_glob(root, name)[:-2], header=False)
    return sources.read_features(spark, name, root)


@query(
    "feature_catalog",
    """SELECT DISTINCT lower(p_type) AS name,
  'root/audio/attributes/' || lower(p_type) || '.attributes.csv' AS attr_path,
  'root/audio/features/' || lower(p_type) || '.csv/*' AS data_glob FROM part""",
)
def feature_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.lower("p_type").alias("name")).distinct()
    return sources.feature_catalog(names, "root/")


@query(
    "tsv_scan",
    """SELECT CAST(o_custkey AS VARCHAR) AS user_id, 'order ' || CAST(o_orderkey AS VARCHAR) AS song_id,
  CAST(floor(o_totalprice) AS INTEGER) AS playcount FROM orders""",
)
def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "triplets")
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", F.concat(F.lit("order "), F.col("o_orderkey")), F.floor("o_totalprice").cast("int")
    )
    sources.write_delimited(rows, path, sep="\t", header=False, compression="gzip")
    return sources.read_tsv(spark, path, sources.TRIPLET_SCHEMA)


@query(
    "fixed_width_parse",
    """SELECT 'SO' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS song_id,
  'TR' || CAST(p_partkey AS VARCHAR) AS track_id FROM part""",
)
def fixed_width_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ids are padded to the field width; the second one varies in length."""
    path = scratch_path(spark, "mismatches")
    key = F.col("p_partkey").cast("string")
    song = F.rpad(F.concat(F.lit("SO"), F.lpad(key, 12, "0")), 18, " ")
    track = F.rpad(F.concat(F.lit("TR"), key), 18, " ")
    lines = table(spark, sf_dir, "part").select(
        F.concat(F.lit("ERROR: <"), song, F.lit(" "), track, F.lit("> "), F.col("p_name")).alias("value")
    )
    lines.write.text(path)
    return sources.read_fixed_width(spark, path, sources.MISMATCH_FIELDS)


@query(
    "header_csv_scan",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer""",
)
def header_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metadata")
    segment = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", segment.alias("segment"))
    sources.write_gzip_csv(rows, path)
    return sources.read_header_csv(spark, path)


@query("glob_append_scan", "SELECT o_orderkey AS song_id, o_custkey AS playcount FROM orders")
def glob_append_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parts")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(4)
    sources.write_delimited(rows, path, header=False)
    schema = T.StructType().add("song_id", T.LongType()).add("playcount", T.LongType())
    return sources.read_parts(spark, path, schema)


@query(
    "literal_rows",
    """SELECT meaning, COUNT(*) AS n FROM lineitem
JOIN (VALUES ('A', 'accepted'), ('N', 'new'), ('R', 'returned')) v(flag, meaning) ON flag = l_returnflag
GROUP BY meaning""",
)
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = sources.literal_rows(
        spark, [("A", "accepted"), ("N", "new"), ("R", "returned")], "l_returnflag string, meaning string"
    )
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(flags, "l_returnflag").groupBy("meaning").agg(F.count(F.lit(1)).alias("n"))


@query(
    "labelled_table",
    """SELECT CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
  upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS label FROM part""",
)
def labelled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.labelled(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"], "p_type")


def _order_lines(spark: SparkSession, sf_dir: str) -> str:
    """Orders as text lines, two directory levels, without a _SUCCESS file beside them; returns the root."""
    path = scratch_path(spark, "inventory")
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    table(spark, sf_dir, "orders").select(
        F.concat_ws(" ", key, customer, "o_orderpriority").alias("value"),
        F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").alias("year"),
    ).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("status", "year").text(path)
    return path


_LEVELS = """WITH placed AS (
  SELECT 'status=' || o_orderstatus AS top, '/year=' || CAST(year(o_orderdate) AS VARCHAR) AS rest,
    1 + strlen(concat_ws(' ', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderpriority)) AS size
  FROM orders)"""


@query("file_inventory", f"{_LEVELS} SELECT top || rest AS directory, 3 AS depth, CAST(SUM(size) AS BIGINT) AS bytes FROM placed GROUP BY 1")
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = sources.file_inventory(spark, _order_lines(spark, sf_dir))
    return files.groupBy("directory", "depth").agg(F.sum("length").alias("bytes"))


@query(
    "directory_usage",
    f"""{_LEVELS} SELECT top AS directory, 1 AS level, CAST(SUM(size) AS BIGINT) AS bytes FROM placed GROUP BY 1
UNION ALL SELECT top || rest, 2, CAST(SUM(size) AS BIGINT) FROM placed GROUP BY 1""",
)
def directory_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = sources.file_inventory(spark, _order_lines(spark, sf_dir))
    return sources.directory_usage(files, 2).select("directory", "level", "bytes")


@query("file_line_counts", f"{_LEVELS} SELECT top || rest AS directory, COUNT(*) AS lines FROM placed GROUP BY 1")
def file_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = sources.file_line_counts(spark, _order_lines(spark, sf_dir))
    folder = F.regexp_extract("path", "(status=[^/]*/year=[^/]*)/", 1)
    return counts.groupBy(folder.alias("directory")).agg(F.sum("lines").alias("lines"))


@query("parquet_roundtrip", "SELECT doc_id, text, lang FROM documents")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "genres")
    sources.write_parquet(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return spark.read.parquet(path)


@query("delimited_roundtrip", "SELECT l_partkey AS song_id, COUNT(*) AS playcount FROM lineitem GROUP BY 1")
def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "delimited")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("song_id"))
    sources.write_delimited(rows.agg(F.count(F.lit(1)).alias("playcount")), path, sep=";")
    return spark.read.csv(path, sep=";", header=True, schema="song_id long, playcount long")


@query("gzip_csv_roundtrip", "SELECT o_custkey AS user_id, COUNT(*) AS songcount FROM orders GROUP BY 1")
def gzip_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gzip")
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id"))
    sources.write_gzip_csv(rows.agg(F.count(F.lit(1)).alias("songcount")), path)
    return spark.read.csv(path, header=True, schema="user_id long, songcount long")


@query(
    "preview_json",
    """SELECT CAST(to_json({l_orderkey: l_orderkey, l_partkey: l_partkey, l_linenumber: l_linenumber, l_returnflag: l_returnflag}) AS VARCHAR) AS json
FROM lineitem ORDER BY l_orderkey, l_partkey, l_linenumber, l_returnflag LIMIT 1""",
)
def preview_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    return sources.preview_json(lines, ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"])


@query(
    "genre_features",
    """WITH f AS (SELECT o_totalprice AS a, o_custkey AS b, o_orderpriority AS genre,
  CAST(o_orderkey AS VARCHAR) AS track_id FROM orders WHERE o_orderstatus <> 'P')
SELECT track_id, genre, round(a / (SELECT stddev_samp(a) FROM f), 5) AS scaled_a,
  round(b / (SELECT stddev_samp(b) FROM f), 5) AS scaled_b FROM f""",
)
def genre_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From attribute, feature and genre files to labelled, scaled vectors; tracks without a genre go."""
    root, name = scratch_path(spark, "genres"), "lines"
    attributes = [("METHOD_A", "real"), ("METHOD_B", "NUMERIC"), ("MSD_TRACKID", "String")]
    sources.write_delimited(
        spark.createDataFrame(attributes, "name string, type string").coalesce(1),
        sources.schemas.attribute_path(root, name),
        header=False,
    )
    orders = table(spark, sf_dir, "orders").withColumn("track", F.col("o_orderkey").cast("string"))
    rows = orders.select("o_totalprice", "o_custkey", F.concat(F.lit("'"), "track", F.lit("'")))
    sources.write_delimited(rows, sources.schemas.data_glob(root, name)[:-2], header=False)
    genres = orders.filter("o_orderstatus <> 'P'").select("track", "o_orderpriority")
    sources.write_delimited(genres, f"{root}/genres", sep="\t", header=False)
    labelled = flows.genre_dataset(
        sources.read_features(spark, name, root), sources.read_tsv(spark, f"{root}/genres", sources.GENRE_SCHEMA), "method"
    )
    scaled = vector_to_array("scfeatures")
    return labelled.select("track_id", "genre", F.round(scaled[0], 5).alias("scaled_a"), F.round(scaled[1], 5).alias("scaled_b"))
