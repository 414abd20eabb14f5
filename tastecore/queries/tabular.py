"""Projections, filters, joins, aggregates, top-k, set operations, scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastecore.functions import at_most, binary_label, capitalise, project_items, strip_quotes, text_slice
from tastecore.operators import aggregates, density, joins, quantiles, relational
from tastecore.operators.sampling import user_holdout
from tastecore.plans.flows import genre_report
from tastecore.plans.staging import stage
from tastecore.queries.registry import query
from tastecore.queries.tables import (
    ACTIVE_SQL,
    KEYS,
    MATCHED_SQL,
    MEASURES,
    active,
    active_split,
    matched,
    mismatches,
    popularity,
    table,
    triplets,
    triplets_table,
)

# --- projections and filters --------------------------------------------------


@query("project", "SELECT o_custkey AS user_id, o_totalprice AS price FROM orders")
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.project(table(spark, sf_dir, "orders"), {"user_id": "o_custkey", "price": "o_totalprice"})


@query("drop_columns", "SELECT p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.drop_columns(table(spark, sf_dir, "part"), ["p_partkey"])


@query("select_prefix", "SELECT l_orderkey, l_discount, l_tax, l_linenumber FROM (SELECT * FROM lineitem)")
def select_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = relational.project(
        table(spark, sf_dir, "lineitem"),
        {"l_orderkey": "l_orderkey", "method_1": "l_discount", "method_2": "l_tax", "method_3": "l_linenumber"},
    )
    picked = relational.select_prefix(named, "method", keep=["l_orderkey"])
    return relational.rename_columns(picked, ["l_orderkey", "l_discount", "l_tax", "l_linenumber"])


@query("select_positions", "SELECT p_brand, p_name FROM part")
def select_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.select_positions(table(spark, sf_dir, "part"), (2, 1))


@query(
    "filter_not_null",
    "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL",
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    rows = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    return relational.filter_not_null(rows, ["quality"]).select("doc_id", "quality")


@query(
    "filter_threshold",
    f"{MATCHED_SQL} SELECT song_id, playcount FROM songs WHERE playcount < (SELECT quantile_disc(playcount, 0.25) FROM songs)",
)
def filter_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = stage(popularity(spark, sf_dir), "songs")
    return relational.filter_below_quantile(songs, "playcount", 0.25)


@query("filter_in", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return relational.filter_in(orders, "o_orderstatus", ["F", "P"])


_NAN_SQL = """CASE WHEN l_quantity > 40 THEN 'NaN'::DOUBLE WHEN l_quantity > 30 THEN NULL ELSE l_quantity END"""


def _with_nan(lines: DataFrame) -> DataFrame:
    """Predictions with NaN and null among them, next to an integer rating."""
    quantity = F.col("l_quantity")
    prediction = F.when(quantity > 40, float("nan")).when(quantity > 30, F.lit(None)).otherwise(quantity)
    return lines.select("l_orderkey", F.col("l_linenumber").alias("rating"), prediction.alias("prediction"))


@query(
    "filter_not_nan",
    f"""SELECT * FROM (SELECT l_orderkey, l_linenumber AS rating, {_NAN_SQL} AS prediction FROM lineitem)
WHERE prediction IS NOT NULL AND NOT isnan(prediction)""",
)
def filter_not_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.drop_nan(_with_nan(table(spark, sf_dir, "lineitem")), "prediction")


@query(
    "filter_conjunction",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'",
)
def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relational.filter_all(table(spark, sf_dir, "lineitem"), {"l_returnflag": "R", "l_linestatus": "F"})
    return rows.select("l_orderkey", "l_linenumber")


@query("filter_equals", "SELECT vec_id, label FROM embeddings WHERE label = 3")
def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.filter_equals(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", 3)


@query("rename_columns", "SELECT o_orderkey AS song_id, o_custkey AS playcount FROM orders")
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return relational.rename_columns(pairs, ["song_id", "playcount"])


# --- joins --------------------------------------------------------------------


@query("mismatch_anti_join", f"{MATCHED_SQL} SELECT * FROM matched")
def mismatch_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.remove_mismatches(triplets(spark, sf_dir), mismatches(spark, sf_dir))


@query("active_triplets", f"{ACTIVE_SQL} SELECT * FROM active")
def active_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active(spark, sf_dir)


@query("holdout_complement", f"{ACTIVE_SQL} SELECT * FROM training")
def holdout_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(active(spark, sf_dir), "active")
    _, test = user_holdout(rows, keys=KEYS)
    return joins.complement(rows, test, KEYS)


@query(
    "genre_join",
    "SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL",
)
def genre_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return joins.attach_label(features, table(spark, sf_dir, "labels"), "doc_id", "quality")


_CLASS_GRID_SQL = """WITH b AS (SELECT l_returnflag, MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem GROUP BY 1)
SELECT l_returnflag, CAST(i AS INTEGER) AS i, round(lo + i * ((hi - lo) / 999), 6) AS x FROM b CROSS JOIN range(1000) r(i)"""


@query("grid_cross_join", _CLASS_GRID_SQL)
def grid_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = density.class_grid(table(spark, sf_dir, "lineitem"), "l_extendedprice", 1000, by="l_returnflag")
    return grid.select("l_returnflag", "i", F.round("x", 6).alias("x"))


# --- aggregates ---------------------------------------------------------------


@query("genre_distribution", "SELECT lang AS genre, COUNT(*) AS count FROM documents GROUP BY 1")
def genre_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_report(table(spark, sf_dir, "documents").select(F.col("lang").alias("genre")))


@query("song_popularity", f"{MATCHED_SQL} SELECT * FROM songs")
def song_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity(spark, sf_dir)


@query("user_activity", f"{MATCHED_SQL} SELECT * FROM users")
def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.user_activity(matched(spark, sf_dir))


@query(
    "most_active_user",
    f"""{MATCHED_SQL} SELECT user_id, CAST(SUM(playcount) AS BIGINT) AS playcount, COUNT(song_id) AS songs
FROM matched GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def most_active_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.most_active(matched(spark, sf_dir))


@query(
    "most_active_user_songs",
    f"""{MATCHED_SQL}, top AS (SELECT user_id FROM matched GROUP BY 1 ORDER BY SUM(playcount) DESC, 1 LIMIT 1)
SELECT user_id, song_id FROM matched WHERE user_id IN (SELECT user_id FROM top)""",
)
def most_active_user_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matched(spark, sf_dir, stored=True)
    return aggregates.songs_of(rows, aggregates.most_active(rows)).select("user_id", "song_id")


@query(
    "ground_truth_lists",
    f"""{ACTIVE_SQL} SELECT user_id, song_id,
  row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC, song_id) AS position FROM test""",
)
def ground_truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = active_split(spark, sf_dir)
    ranked = aggregates.ordered_rows(test, "user_id", [F.desc("playcount"), "song_id"])
    return ranked.select("user_id", "song_id", "position")


@query("global_collect", f"{MATCHED_SQL} SELECT user_id FROM users")
def global_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.collect_distinct(matched(spark, sf_dir), "user_id")


@query(
    "row_count",
    f"""{ACTIVE_SQL} SELECT 'triplets' AS stage, COUNT(*) AS rows FROM triplets
UNION ALL SELECT 'matched', COUNT(*) FROM matched UNION ALL SELECT 'active', COUNT(*) FROM active
UNION ALL SELECT 'test', COUNT(*) FROM test UNION ALL SELECT 'training', COUNT(*) FROM training""",
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = triplets_table(spark, sf_dir)
    clean = joins.remove_mismatches(raw, mismatches(spark, sf_dir))
    kept = stage(joins.active_triplets(clean), "active")
    training, test = user_holdout(kept, keys=KEYS)
    frames = {"triplets": raw, "matched": clean, "active": kept, "test": test, "training": training}
    return aggregates.stage_counts(frames)


@query(
    "distinct_count",
    f"{MATCHED_SQL} SELECT COUNT(DISTINCT user_id) AS user_id, COUNT(DISTINCT song_id) AS song_id FROM matched",
)
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distinct_count(matched(spark, sf_dir, stored=True), KEYS)


CAP = 100


@query(
    "class_fractions",
    f"""SELECT lang, COUNT(*) AS count,
  round(CASE WHEN COUNT(*) < {CAP} THEN 1.0::DOUBLE ELSE {CAP}.0::DOUBLE / COUNT(*) END, 9) AS fraction
FROM documents GROUP BY 1""",
)
def class_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = aggregates.cap_fractions(table(spark, sf_dir, "documents"), "lang", CAP)
    return shares.withColumn("fraction", F.round("fraction", 9))


@query(
    "class_balance_fractions",
    """WITH c AS (SELECT quality, COUNT(*) AS count FROM labels GROUP BY 1)
SELECT quality, count, round((SELECT MIN(count) FROM c) / count::DOUBLE, 9) AS fraction FROM c""",
)
def class_balance_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = aggregates.balance_fractions(table(spark, sf_dir, "labels"), "quality")
    return shares.withColumn("fraction", F.round("fraction", 9))


_DESCRIBE = """SELECT '{c}' AS "column", COUNT({c}) AS count, round(AVG({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS stddev, MIN({c}) AS min, MAX({c}) AS max FROM lineitem"""


@query("describe_columns", " UNION ALL ".join(_DESCRIBE.format(c=c) for c in MEASURES))
def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = aggregates.describe_columns(table(spark, sf_dir, "lineitem"), MEASURES)
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, round(corr({a}, {b}), 4) + 0.0::DOUBLE AS corr FROM lineitem"
        for a in MEASURES
        for b in MEASURES
    ),
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.correlation_matrix(table(spark, sf_dir, "lineitem"), MEASURES, digits=4)


_QUANTILES = "SELECT '{t}' AS measure, {p}::DOUBLE AS prob, quantile_disc({c}, {p}) AS value FROM {t}"


@query(
    "exact_quantiles",
    MATCHED_SQL
    + " "
    + " UNION ALL ".join(
        _QUANTILES.format(t=t, c=c, p=p)
        for t, c in (("songs", "playcount"), ("users", "songcount"))
        for p in (0.0, 0.25, 0.5, 0.75, 1.0)
    ),
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, bad = triplets_table(spark, sf_dir), mismatches(spark, sf_dir)
    songs = quantiles.quantiles(stage(aggregates.matched_popularity(rows, bad), "songs"), "playcount")
    users = quantiles.quantiles(stage(aggregates.user_activity(joins.remove_mismatches(rows, bad)), "users"), "songcount")
    return relational.union_all(
        [songs.withColumn("measure", F.lit("songs")), users.withColumn("measure", F.lit("users"))]
    ).select("measure", "prob", "value")


_SUMMARY = """SELECT '{c}' AS "column", MIN({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q1,
  round(quantile_cont({c}, 0.5), 4) AS median, round(AVG({c}), 4) AS mean,
  round(quantile_cont({c}, 0.75), 4) AS q3, MAX({c}) AS max FROM lineitem"""


@query("summary_quartiles", " UNION ALL ".join(_SUMMARY.format(c=c) for c in MEASURES))
def summary_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = quantiles.summary_quartiles(table(spark, sf_dir, "lineitem"), MEASURES)
    return summary.withColumns({c: F.round(c, 4) for c in ("q1", "median", "mean", "q3")})


# --- top-k, sort, limit, set operations ------------------------------------------


@query("top_plays", f"{MATCHED_SQL} SELECT * FROM matched ORDER BY playcount DESC, user_id, song_id LIMIT 10")
def top_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.top_k(matched(spark, sf_dir), "playcount", 10, KEYS)


@query(
    "top_test_ratings",
    f"""{ACTIVE_SQL}, best AS (SELECT * FROM test ORDER BY playcount DESC, user_id, song_id LIMIT 10)
SELECT DISTINCT user_id AS "user" FROM best""",
)
def top_test_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = active_split(spark, sf_dir)
    return relational.top_users(test.toDF("user", "item", "rating"), 10)


@query("sort_ascending", "SELECT label, COUNT(*) AS count FROM embeddings GROUP BY 1 ORDER BY label")
def sort_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.sort_by(table(spark, sf_dir, "embeddings").groupBy("label").count(), ["label"])


@query("limit_n", "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 1")
def limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.limit_n(table(spark, sf_dir, "events").select("event_id", "user_id"), 1, ["event_id"])


@query(
    "union_all",
    """SELECT c_custkey AS key, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
)
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = relational.project(table(spark, sf_dir, "customer"), {"key": "c_custkey", "balance": "c_acctbal"})
    suppliers = relational.project(table(spark, sf_dir, "supplier"), {"key": "s_suppkey", "balance": "s_acctbal"})
    return relational.union_all([customers, suppliers])


@query("distinct_rows", "SELECT DISTINCT p_type, p_brand FROM part")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.distinct_rows(table(spark, sf_dir, "part"), ["p_type", "p_brand"])


# --- scalars and arrays -----------------------------------------------------------


@query(
    "string_scalars",
    """SELECT p_partkey, trim(substr(p_name, 2, 6)) AS slice, replace(p_brand || '''s', '''', '') AS plain,
  lower(p_type) AS small, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS title FROM part""",
)
def string_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text_slice("p_name", 2, 6).alias("slice"),
        strip_quotes(F.concat("p_brand", F.lit("'s"))).alias("plain"),
        F.lower("p_type").alias("small"),
        capitalise("p_type").alias("title"),
    )


@query(
    "cast_scalars",
    """SELECT CAST(l_orderkey AS VARCHAR) AS text, CAST(l_quantity AS INTEGER) AS number,
  CAST(l_quantity > 25 AS INTEGER) AS flag FROM lineitem""",
)
def cast_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("text"),
        F.col("l_quantity").cast("int").alias("number"),
        (F.col("l_quantity") > 25).cast("int").alias("flag"),
    )


@query(
    "conditional_label",
    "SELECT doc_id, CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM documents",
)
def conditional_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", binary_label("lang", "en").alias("label"))


@query(
    "math_scalars",
    """SELECT l_orderkey, l_linenumber, 1 AS one, least(l_quantity, 30.0::DOUBLE) AS lesser,
  round(l_extendedprice / l_quantity, 9) AS unit,
  round(CASE WHEN l_quantity < 20 THEN 1.0::DOUBLE ELSE 20.0::DOUBLE / l_quantity END, 9) AS share FROM lineitem""",
)
def math_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.lit(1).alias("one"),
        F.least("l_quantity", F.lit(30.0)).alias("lesser"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 9).alias("unit"),
        F.round(at_most("l_quantity", 20), 9).alias("share"),
    )


@query("array_length", "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS words FROM documents")
def array_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.split("text", " ")).alias("words"))


@query(
    "array_project_field",
    """SELECT l_orderkey, l_linenumber,
  CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) AS items FROM lineitem""",
)
def array_project_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(
        F.struct(F.col("l_partkey").alias("item"), F.col("l_quantity").alias("rating")),
        F.struct(F.col("l_suppkey").alias("item"), F.col("l_tax").alias("rating")),
    )
    lists = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pairs.alias("recommendations"))
    items = project_items("recommendations").cast("array<string>")
    return lists.select("l_orderkey", "l_linenumber", F.array_join(items, ",").alias("items"))


@query(
    "array_build",
    """SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS items
FROM lineitem GROUP BY 1""",
)
def array_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of an order: its lists are short by nature, so they are complete."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    lists = aggregates.short_lists(lines, "l_orderkey", ["l_linenumber"], "l_partkey")
    return lists.select("l_orderkey", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query(
    "top_song_lists",
    f"""{MATCHED_SQL}, best AS (SELECT user_id, song_id,
  row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC, song_id) AS place FROM matched)
SELECT user_id, string_agg(CAST(song_id AS VARCHAR), ',' ORDER BY place) AS items FROM best WHERE place <= 10 GROUP BY 1""",
)
def top_song_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("playcount"), "song_id"]
    lists = aggregates.ordered_lists(matched(spark, sf_dir), "user_id", "song_id", order, 10)
    return lists.select("user_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))
