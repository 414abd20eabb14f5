"""Samples, features, evaluation metrics, density curves."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastecore.functions import binary_label
from tastecore.operators import aggregates, density, features, joins, metrics, ranking, sampling, svm
from tastecore.plans.staging import stage
from tastecore.queries.registry import query
from tastecore.queries.tables import (
    ACTIVE_SQL,
    KEYS,
    LINE_KEYS,
    MATCHED_SQL,
    MEASURES,
    active,
    active_split,
    hash_sql,
    matched,
    popularity,
    table,
)
from tastecore.queries.tabular import CAP, _NAN_SQL, _with_nan

# --- samples --------------------------------------------------------------------

_LINE_HASH = hash_sql(LINE_KEYS)


@query(
    "random_split",
    f"SELECT {', '.join(LINE_KEYS)}, CASE WHEN {_LINE_HASH} < 0.7::DOUBLE THEN 'training' ELSE 'test' END AS part FROM lineitem",
)
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, test = sampling.hash_split(table(spark, sf_dir, "lineitem").select(*LINE_KEYS), LINE_KEYS, 0.7)
    return training.withColumn("part", F.lit("training")).union(test.withColumn("part", F.lit("test")))


@query(
    "balanced_downsample",
    f"""WITH c AS (SELECT quality, COUNT(*) AS n FROM labels GROUP BY 1),
f AS (SELECT quality, (SELECT MIN(n) FROM c) / n::DOUBLE AS fraction FROM c)
SELECT l.doc_id, l.quality FROM labels l JOIN f ON l.quality = f.quality
WHERE {hash_sql(['doc_id'], 'balance')} < f.fraction""",
)
def balanced_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return sampling.balance(labels, "quality", ["doc_id"])


@query(
    "capped_downsample",
    f"""WITH f AS (SELECT lang, CASE WHEN COUNT(*) < {CAP} THEN 1.0::DOUBLE ELSE {CAP}.0::DOUBLE / COUNT(*) END AS fraction
  FROM documents GROUP BY 1)
SELECT d.doc_id, d.lang FROM documents d JOIN f ON d.lang = f.lang
WHERE {hash_sql(['doc_id'])} < 0.7::DOUBLE AND {hash_sql(['doc_id'], 'cap')} < f.fraction""",
)
def capped_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    training, _ = sampling.hash_split(documents, ["doc_id"], 0.7)
    return sampling.cap_classes(training, "lang", CAP, ["doc_id"], fractions_from=documents)


@query("per_user_holdout", f"{ACTIVE_SQL} SELECT * FROM test")
def per_user_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_split(spark, sf_dir)[1]


# --- features -------------------------------------------------------------------


def _methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *MEASURES)
    return lines.withColumnsRenamed({c: f"method_{c}" for c in MEASURES})


def _unpacked(df: DataFrame, vector: str) -> DataFrame:
    values = vector_to_array(vector)
    return df.select(*LINE_KEYS, *[F.round(values[i], 6).alias(f"v{i}") for i in range(len(MEASURES))])


def _scaled_sql(fit_filter: str = "TRUE") -> str:
    stds = ", ".join(f"stddev_samp({c}) AS s{i}" for i, c in enumerate(MEASURES))
    scaled = ", ".join(f"round({c} / s{i}, 6) AS v{i}" for i, c in enumerate(MEASURES))
    return f"""WITH s AS (SELECT {stds} FROM lineitem WHERE {fit_filter})
SELECT {', '.join(LINE_KEYS)}, {scaled} FROM lineitem CROSS JOIN s"""


@query(
    "assemble_vector",
    f"SELECT {', '.join(LINE_KEYS)}, {', '.join(f'round({c}, 6) AS v{i}' for i, c in enumerate(MEASURES))} FROM lineitem",
)
def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _methods(spark, sf_dir)
    return _unpacked(features.assemble(rows, [c for c in rows.columns if c.startswith("method")]), "features")


@query("standard_scale", _scaled_sql())
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unpacked(features.prepare(_methods(spark, sf_dir), "method"), "scfeatures")


@query("standard_scale_on_training", _scaled_sql(f"{_LINE_HASH} < 0.7::DOUBLE"))
def standard_scale_on_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _methods(spark, sf_dir)
    training, _ = sampling.hash_split(rows, LINE_KEYS, 0.7)
    return _unpacked(features.prepare(rows, "method", fit_on=training), "scfeatures")


_CODES = "(SELECT {c}, row_number() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS {o} FROM {t} GROUP BY {c})"


@query(
    "string_index",
    f"""SELECT p_partkey, CAST(label AS DOUBLE) AS label
FROM part JOIN {_CODES.format(c='p_type', o='label', t='part')} USING (p_type)""",
)
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return features.index_strings(parts, "p_type", "label").select("p_partkey", "label")


@query(
    "index_users_items",
    f"""{MATCHED_SQL} SELECT CAST(u AS INTEGER) AS "user", CAST(i AS INTEGER) AS item, playcount AS rating
FROM matched JOIN {_CODES.format(c='user_id', o='u', t='matched')} USING (user_id)
JOIN {_CODES.format(c='song_id', o='i', t='matched')} USING (song_id)""",
)
def index_users_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.index_triplets(matched(spark, sf_dir, stored=True))


_RFF = {"cols": ["l_discount", "l_tax"], "gamma": 0.7, "n_features": 8, "seed": 0}


def _rff_sql() -> str:
    directions, phases = svm.fourier_weights(2, _RFF["gamma"], _RFF["n_features"], _RFF["seed"])
    size = (2.0 / _RFF["n_features"]) ** 0.5
    terms = [
        f"round({size!r}::DOUBLE * cos({float(b)!r}::DOUBLE + l_discount * ({float(w[0])!r}::DOUBLE)"
        f" + l_tax * ({float(w[1])!r}::DOUBLE)), 6) AS rff_{i}"
        for i, (w, b) in enumerate(zip(directions, phases))
    ]
    return f"SELECT {', '.join(LINE_KEYS)}, {', '.join(terms)} FROM lineitem"


@query("fourier_features", _rff_sql())
def fourier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *svm.fourier_columns(**_RFF))
    return rows.select(*LINE_KEYS, *[F.round(c, 6).alias(c) for c in rows.columns if c.startswith("rff_")])


# --- evaluation -----------------------------------------------------------------


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines as the positive class, a discount rule as the prediction."""
    return table(spark, sf_dir, "lineitem").select(
        binary_label("l_returnflag", "R").alias("label"),
        (F.col("l_discount") > 0.05).cast("double").alias("prediction"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_discount").alias("rough"),
    )


_JUDGED = """WITH judged AS (SELECT l_returnflag = 'R' AS y, l_discount > 0.05 AS p, l_extendedprice AS score,
  l_discount AS rough FROM lineitem),
c AS (SELECT COUNT(*) FILTER (y AND p) AS tp, COUNT(*) FILTER (NOT y AND p) AS fp,
  COUNT(*) FILTER (NOT y AND NOT p) AS tn, COUNT(*) FILTER (y AND NOT p) AS fn FROM judged)"""


@query("confusion_counts", f"{_JUDGED} SELECT * FROM c")
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_counts(_judged(spark, sf_dir))


@query(
    "precision_recall_f1",
    f"""{_JUDGED}, r AS (SELECT tp / (tp + fp)::DOUBLE AS precision, tp / (tp + fn)::DOUBLE AS recall FROM c)
SELECT round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(2 * precision * recall / (precision + recall), 9) AS f1 FROM r""",
)
def precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = metrics.binary_metrics(_judged(spark, sf_dir))
    return row.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "roc_auc",
    f"""{_JUDGED}, ranked AS (SELECT y, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r
  FROM judged)
SELECT round((SUM(r) FILTER (y) - COUNT(*) FILTER (y) * (COUNT(*) FILTER (y) + 1) / 2.0::DOUBLE)
  / (COUNT(*) FILTER (y)::DOUBLE * COUNT(*) FILTER (NOT y)), 9) AS auc FROM ranked""",
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(_judged(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


@query(
    "multiclass_metrics",
    """WITH j AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y, l_linenumber % 3 AS p FROM lineitem),
k AS (SELECT y AS cls, COUNT(*)::DOUBLE AS support, COUNT(*) FILTER (y = p)::DOUBLE AS hit,
  (SELECT COUNT(*) FROM j q WHERE q.p = j.y)::DOUBLE AS predicted FROM j GROUP BY y),
m AS (SELECT support, hit, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS p, hit / support AS r FROM k)
SELECT round(SUM(hit) / SUM(support), 9) AS accuracy, round(SUM(support * p) / SUM(support), 9) AS precision,
  round(SUM(support * r) / SUM(support), 9) AS recall,
  round(SUM(support * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / SUM(support), 9) AS f1 FROM m""",
)
def multiclass_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0).alias("label"),
        (F.col("l_linenumber") % 3).cast("double").alias("prediction"),
    )
    found = metrics.multiclass_metrics(rows)
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query(
    "roc_curve",
    f"""{_JUDGED}, s AS (SELECT rough AS threshold, COUNT(*) FILTER (y) AS pos, COUNT(*) FILTER (NOT y) AS neg FROM judged GROUP BY 1)
SELECT threshold, round(SUM(neg) OVER w / (SUM(neg) OVER ())::DOUBLE, 9) AS fpr,
  round(SUM(pos) OVER w / (SUM(pos) OVER ())::DOUBLE, 9) AS tpr FROM s WINDOW w AS (ORDER BY threshold DESC)""",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = metrics.roc_curve(_judged(spark, sf_dir), score="rough")
    return curve.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


_RANKED = f"""{ACTIVE_SQL}, predicted AS (SELECT * FROM (SELECT user_id, song_id,
  row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC, song_id) AS position FROM active) WHERE position <= 10),
size AS (SELECT user_id, COUNT(DISTINCT song_id) AS n FROM test GROUP BY 1),
hits AS (SELECT p.user_id, p.position, row_number() OVER (PARTITION BY p.user_id ORDER BY p.position) AS h
  FROM predicted p JOIN test t ON p.user_id = t.user_id AND p.song_id = t.song_id),
per_user AS (SELECT u.user_id, coalesce(s.n, 0) AS n,
  (SELECT COUNT(*) FROM hits h WHERE h.user_id = u.user_id AND position <= 5) / 5.0::DOUBLE AS pk,
  coalesce((SELECT SUM(1 / log2(position + 1)) FROM hits h WHERE h.user_id = u.user_id AND position <= 10), 0) AS dcg,
  coalesce((SELECT SUM(h / position::DOUBLE) FROM hits h WHERE h.user_id = u.user_id), 0) AS ap
  FROM (SELECT DISTINCT user_id FROM predicted) u LEFT JOIN size s ON s.user_id = u.user_id),
ideal AS (SELECT m, SUM(1 / log2(i + 1)) AS best FROM range(1, 11) a(m) JOIN range(1, 11) b(i) ON i <= m GROUP BY m)"""


def _predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each user's ten most played active songs, against the held-out ones."""
    rows = stage(active(spark, sf_dir), "active")
    _, test = sampling.user_holdout(rows, keys=KEYS)
    best = aggregates.top_rows(rows, "user_id", [F.desc("playcount"), "song_id"], 10)
    return (
        best.select(F.col("user_id").alias("user"), F.col("song_id").alias("item"), "position"),
        test.select(F.col("user_id").alias("user"), F.col("song_id").alias("item")),
    )


@query(
    "prediction_truth_join",
    f"""{_RANKED} SELECT p.user_id AS "user", p.song_id AS item, CAST(p.position AS INTEGER) AS position, t.song_id IS NOT NULL AS hit
FROM predicted p LEFT JOIN test t ON p.user_id = t.user_id AND p.song_id = t.song_id""",
)
def prediction_truth_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.pair_rows(*_predictions(spark, sf_dir)).select("user", "item", "position", "hit")


@query("precision_at_k", f"{_RANKED} SELECT round(AVG(pk), 9) AS precision_at_k FROM per_user")
def precision_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = ranking.ranking_metrics(*_predictions(spark, sf_dir), k=5)
    return row.select(F.round("precision_at_k", 9).alias("precision_at_k"))


@query(
    "ndcg_at_k",
    f"""{_RANKED} SELECT round(AVG(coalesce(dcg / best, 0)), 9) AS ndcg_at_k
FROM per_user LEFT JOIN ideal ON m = least(n, 10)""",
)
def ndcg_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = ranking.ranking_metrics(*_predictions(spark, sf_dir), k=10)
    return row.select(F.round("ndcg_at_k", 9).alias("ndcg_at_k"))


@query(
    "mean_average_precision",
    f"{_RANKED} SELECT round(AVG(CASE WHEN n > 0 THEN ap / n ELSE 0 END), 9) AS map FROM per_user",
)
def mean_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = ranking.ranking_metrics(*_predictions(spark, sf_dir), k=10)
    return row.select(F.round("map", 9).alias("map"))


@query(
    "rmse",
    f"""SELECT round(sqrt(AVG((prediction - rating) * (prediction - rating))), 9) AS rmse
FROM (SELECT l_linenumber AS rating, {_NAN_SQL} AS prediction FROM lineitem)
WHERE prediction IS NOT NULL AND NOT isnan(prediction)""",
)
def rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rmse(_with_nan(table(spark, sf_dir, "lineitem"))).select(F.round("rmse", 9).alias("rmse"))


# --- density --------------------------------------------------------------------


def _kde_sql(points: int) -> str:
    return f"""SELECT {{keys}}CAST(i AS INTEGER) AS i, round(any_value(lo + i * (hi - lo) / {points - 1}), 6) AS x,
  round(SUM(w * exp(-0.5 * pow((lo + i * ((hi - lo) / {points - 1}) - v) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 9) AS density
FROM g JOIN b {{on}} CROSS JOIN range({points}) r(i) GROUP BY {{keys}}i"""


@query(
    "kde_by_class",
    """WITH g AS (SELECT l_returnflag, l_quantity AS v, COUNT(*)::DOUBLE AS w FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_returnflag, COUNT(*)::DOUBLE AS n, MIN(l_quantity) AS lo, MAX(l_quantity) AS hi,
  stddev_samp(l_quantity) * pow(COUNT(*)::DOUBLE, -0.2) AS h FROM lineitem GROUP BY 1)
"""
    + _kde_sql(1000).format(keys="l_returnflag, ", on="USING (l_returnflag)"),
)
def kde_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = density.kde(table(spark, sf_dir, "lineitem"), "l_quantity", by="l_returnflag", points=1000)
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


@query(
    "density_curve",
    MATCHED_SQL
    + """, g AS (SELECT playcount::DOUBLE AS v, COUNT(*)::DOUBLE AS w FROM songs GROUP BY 1),
b AS (SELECT COUNT(*)::DOUBLE AS n, MIN(playcount)::DOUBLE AS lo, MAX(playcount)::DOUBLE AS hi,
  0.9::DOUBLE * least(stddev_samp(playcount), (quantile_cont(playcount, 0.75) - quantile_cont(playcount, 0.25)) / 1.34::DOUBLE)
    * pow(COUNT(*)::DOUBLE, -0.2) AS h FROM songs)
"""
    + _kde_sql(512).format(keys="", on="ON TRUE"),
)
def density_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = stage(popularity(spark, sf_dir), "songs")
    curve = density.kde(songs, "playcount", points=512, bandwidth="nrd0")
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


BINS = 20


def _pairs_sql() -> str:
    ends = ", ".join(f"MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in MEASURES)
    cells = ", ".join(
        f"CAST(least(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / {BINS})), {BINS - 1}) AS INTEGER) AS {c}" for c in MEASURES
    )
    pairs = [
        f"SELECT l_returnflag, '{a}' AS x_col, '{b}' AS y_col, {a} AS x_bin, {b} AS y_bin, COUNT(*) AS count FROM c GROUP BY ALL"
        for i, a in enumerate(MEASURES)
        for b in MEASURES[i:]
    ]
    return (
        f"WITH e AS (SELECT {ends} FROM lineitem), c AS (SELECT l_returnflag, {cells} FROM lineitem CROSS JOIN e) "
        + " UNION ALL ".join(pairs)
    )


@query("scatter_matrix_bins", _pairs_sql())
def scatter_matrix_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.pair_bins(table(spark, sf_dir, "lineitem"), MEASURES, BINS, by="l_returnflag")


@query(
    "mesh_grid",
    """WITH e AS (SELECT MIN(l_quantity) - 1 AS x0, MAX(l_quantity) + 1 AS x1, MIN(l_tax) - 1 AS y0, MAX(l_tax) + 1 AS y1 FROM lineitem)
SELECT round(x0 + i * 0.25::DOUBLE, 6) AS l_quantity, round(y0 + j * 0.25::DOUBLE, 6) AS l_tax
FROM e CROSS JOIN range(10000) a(i) CROSS JOIN range(100) b(j)
WHERE i < ceil((x1 - x0) / 0.25::DOUBLE) AND j < ceil((y1 - y0) / 0.25::DOUBLE)""",
)
def mesh_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    mesh = density.mesh_grid(table(spark, sf_dir, "lineitem"), "l_quantity", "l_tax", h=0.25)
    return mesh.select(F.round("l_quantity", 6).alias("l_quantity"), F.round("l_tax", 6).alias("l_tax"))
