"""Models. Their values come from training, so most have no SQL twin."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastecore.functions import binary_label
from tastecore.operators import classify, density, features, kernel_svm, logistic_grid, metrics, newton_svm, recommend, relational, sampling
from tastecore.plans import flows
from tastecore.plans.staging import stage
from tastecore.queries.registry import query
from tastecore.queries.tables import (
    ACTIVE_SQL,
    LINE_KEYS,
    MEASURES,
    active,
    embedded,
    embedded_binary,
    hash_sql,
    mismatches,
    table,
    triplets_table,
)

# Classes of the test rows, counted as the metrics count them: what a model must not change.
SPLIT = hash_sql(["vec_id"], "split")
TEST_SIZES = f"""SELECT count(*) FILTER (label = 3) AS positives, count(*) FILTER (label <> 3) AS negatives
  FROM embeddings WHERE {SPLIT} >= 0.7::DOUBLE"""
DIMS = 64

# --- classifiers on the labelled vectors -------------------------------------------


def _parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    training, test = sampling.hash_split(df, ["vec_id"], 0.7, "split")
    return stage(training, "training", spread=["vec_id"]), test


def _scored(spark: SparkSession, sf_dir: str, estimator: Estimator) -> DataFrame:
    training, test = _parts(embedded_binary(spark, sf_dir))
    score = vector_to_array("rawPrediction").getItem(1).alias("score")
    return stage(estimator.fit(training).transform(test).select("label", "prediction", score), "scored")


def _binary(scored: DataFrame) -> DataFrame:
    """Test rows per class, from the four confusion counts, and whether the area under the ROC curve is a share."""
    found = metrics.binary_metrics(scored).withColumn("auc", metrics.roc_auc(scored).scalar())
    return found.select(
        (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"),
        F.col("auc").between(0.0, 1.0).alias("auc_is_a_share"),
    )


def _moments(model, training: DataFrame, cls: int) -> DataFrame:
    """(component, moment): mean of probability x component over the training rows, component -1 being 1.

    At the optimum of an unpenalised logistic fit these equal the means of label x component.
    """
    p = vector_to_array("probability").getItem(cls)
    x = vector_to_array("scfeatures")
    rows = model.transform(training).select(p.alias("p"), x.alias("x"))
    means = rows.agg(F.avg("p").alias("m"), *[F.avg(F.col("p") * F.col("x")[j]).alias(f"m{j}") for j in range(DIMS)])
    places = [F.struct(F.lit(j).alias("component"), F.round(f"m{j}" if j >= 0 else "m", 5).alias("moment")) for j in range(-1, DIMS)]
    return means.select(F.explode(F.array(*places)).alias("r")).select("r.*")


MOMENTS_SQL = f"""WITH t AS (SELECT *, (label = 3)::INTEGER::DOUBLE AS y FROM embeddings WHERE {SPLIT} < 0.7::DOUBLE)
SELECT -1 AS component, round(avg(y), 5) + 0.0 AS moment FROM t
UNION ALL SELECT j::INTEGER, round(avg(y * embedding[j + 1]::DOUBLE), 5) + 0.0 FROM t, range({DIMS}) r(j) GROUP BY j"""


@query("logistic_binary", MOMENTS_SQL)
def logistic_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, _ = _parts(embedded_binary(spark, sf_dir))
    model = classify.classifier("logistic", tol=1e-8).fit(training)
    return _moments(model, training, 1).withColumn("moment", F.col("moment") + F.lit(0.0))


@query("random_forest", f"SELECT *, true AS auc_is_a_share FROM ({TEST_SIZES})")
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary(_scored(spark, sf_dir, classify.classifier("forest", seed=1)))


@query(
    "decision_tree",
    f"""WITH t AS (SELECT *, (label = 3)::INTEGER::DOUBLE AS y FROM embeddings WHERE {SPLIT} < 0.7::DOUBLE)
SELECT positives, negatives, (SELECT round(avg(y), 9) FROM t) AS base_rate FROM ({TEST_SIZES})""",
)
def decision_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows per class; and the mean of the training probabilities, which in a tree is the base rate."""
    training, test = _parts(embedded_binary(spark, sf_dir))
    model = classify.classifier("tree", seed=1).fit(training)
    found = metrics.binary_metrics(model.transform(test))
    rate = model.transform(training).agg(F.round(F.avg(vector_to_array("probability").getItem(1)), 9)).scalar()
    return found.select((F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"), rate.alias("base_rate"))


def _search(spark: SparkSession, sf_dir: str, kind: str, grid: dict, **params) -> DataFrame:
    """Every grid point with its mean F1 over five folds, and whether it is the one chosen."""
    rows = sampling.with_folds(embedded_binary(spark, sf_dir), ["vec_id"], 5)
    if kind == "logistic":
        search = logistic_grid.LogisticSearch(grid, **params)
    else:
        search = classify.cross_validate(classify.classifier(kind, **params), grid, fold_col="fold", parallelism=8)
    scores = [float(score) for score in search.fit(stage(rows, "folds", spread=["vec_id"])).avgMetrics]
    points = [", ".join(sorted(f"{p.name}={v}" for p, v in point.items())) for point in search.getEstimatorParamMaps()]
    found = [(point, score, i == scores.index(max(scores))) for i, (point, score) in enumerate(zip(points, scores))]
    return spark.createDataFrame(found, "point string, f1 double, chosen boolean")


def _usable(found: DataFrame) -> DataFrame:
    """Every grid point, and whether its score is a share above 0."""
    return found.select("point", ((F.col("f1") > 0) & (F.col("f1") <= 1)).alias("usable"))


def _points_sql(grid: dict) -> str:
    """All grid points; the words of a point in order of their names."""
    names = sorted(grid)
    tables = ", ".join(f"(VALUES {', '.join(f'({chr(39)}{n}={v}{chr(39)})' for v in grid[n])}) g{i}(w{i})" for i, n in enumerate(names))
    return f"SELECT concat_ws(', ', {', '.join(f'w{i}' for i in range(len(names)))}) AS point, true AS usable FROM {tables}"


@query("cv_logistic", _points_sql(classify.LOGISTIC_GRID))
def cv_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usable(_search(spark, sf_dir, "logistic", classify.LOGISTIC_GRID))


@query("cv_forest", _points_sql(classify.FOREST_GRID))
def cv_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usable(_search(spark, sf_dir, "forest", classify.FOREST_GRID, seed=1))


@query("cv_tree", _points_sql(classify.TREE_GRID))
def cv_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usable(_search(spark, sf_dir, "tree", classify.TREE_GRID, seed=1))


@query("cv_logistic_scores")
def cv_logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "logistic", classify.LOGISTIC_GRID)


@query("cv_tree_scores")
def cv_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "tree", classify.TREE_GRID, seed=1)


@query("one_vs_rest")
def one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, test = _parts(embedded(spark, sf_dir))
    model = classify.one_vs_rest(classify.classifier("logistic")).fit(training)
    return metrics.multiclass_metrics(model.transform(test))


@query("binary_experiment")
def binary_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three algorithms, each plain, on balanced rows, and with its full search over five folds."""
    grids = {"logistic": classify.LOGISTIC_GRID, "forest": classify.FOREST_GRID, "tree": classify.TREE_GRID}
    runs = []
    for kind, grid in grids.items():
        estimator = classify.classifier(kind, **({} if kind == "logistic" else {"seed": 1}))
        if kind == "logistic":
            search = logistic_grid.LogisticSearch(grid, fold_col=flows.FOLD)
        else:
            search = classify.cross_validate(estimator, grid, fold_col=flows.FOLD, parallelism=8)
        runs.append((kind, estimator, search))
    return flows.binary_experiment(embedded(spark, sf_dir), runs, positive="class_3", keys=["vec_id"])


@query("multiclass_experiment")
def multiclass_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = classify.classifier("forest", seed=1)
    search = classify.cross_validate(forest, classify.FOREST_GRID, fold_col=flows.FOLD, parallelism=8)
    return flows.multiclass_experiment(
        embedded(spark, sf_dir), [("random forest", forest, search)], keys=["vec_id"], cap=40
    )


# --- support vector machines on two columns of the order lines -----------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their flag as class 0, 1 or 2."""
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0)
    return table(spark, sf_dir, "lineitem").select(*MEASURES, *LINE_KEYS, label.alias("label"))


def _pair(rows: DataFrame, positions: tuple[int, int]) -> tuple[DataFrame, list[str]]:
    """Two feature columns, as `features`, next to the label."""
    cols = [MEASURES[p] for p in positions]
    rest = [rows.columns.index(c) for c in (*LINE_KEYS, "label")]
    picked = relational.select_positions(rows, (*positions, *rest))
    return stage(features.assemble(picked, cols), "pair", spread=LINE_KEYS).drop(*LINE_KEYS), cols


@query("linear_svm_binary")
def linear_svm_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _pair(_lines(spark, sf_dir), (2, 1))
    first = rows.withColumn("label", binary_label("label", 0.0))
    return metrics.binary_metrics(newton_svm.squared_hinge_svm(first).transform(first))


@query("linear_svm_multiclass")
def linear_svm_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = []
    for positions in ((2, 1), (0, 1)):
        rows, cols = _pair(_lines(spark, sf_dir), positions)
        model = newton_svm.squared_hinge_svm(rows, multiclass=True)
        found.append(
            metrics.multiclass_metrics(model.transform(rows)).withColumn("pair", F.lit(" x ".join(cols)))
        )
    return relational.union_all(found)


@query("rbf_svm")
def rbf_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cols = _pair(_lines(spark, sf_dir), (2, 3))
    model = kernel_svm.kernel_svm(rows, cols)
    return metrics.multiclass_metrics(model.transform(rows))


@query(
    "logistic_multinomial",
    f"""WITH t AS (SELECT label FROM embeddings WHERE {SPLIT} < 0.7::DOUBLE)
SELECT label::DOUBLE AS class, round(count(*) / (SELECT count(*) FROM t), 4) AS share FROM t GROUP BY 1""",
)
def logistic_multinomial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean probability of each class over the training rows: its share, as intercepts are not penalised."""
    training, _ = _parts(embedded(spark, sf_dir))
    model = classify.classifier(
        "logistic", family="multinomial", regParam=1.0 / training.count(), standardization=False, tol=1e-8
    ).fit(training)
    p = vector_to_array("probability")
    means = model.transform(training).select(F.posexplode(p).alias("class", "p")).groupBy("class").agg(F.avg("p").alias("p"))
    return means.select(F.col("class").cast("double").alias("class"), F.round("p", 4).alias("share"))


@query("decision_surface")
def decision_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted class on every mesh point for five models: a linear one for class 0, two linear ones for all classes
    on different columns, the kernel machine, and multinomial logistic regression."""
    lines, found = _lines(spark, sf_dir), []
    narrow, wide = (2, 3), (0, 2)  # discount x tax; quantity x discount
    pairs = {positions: _pair(lines, positions) for positions in (narrow, wide)}
    for name, positions, h in (
        ("linear_svm_binary", narrow, 0.01), ("linear_svm_multiclass", narrow, 0.01), ("linear_svm_multiclass", wide, 0.05),
        ("rbf_svm", narrow, 0.01), ("logistic_multinomial", narrow, 0.01),
    ):
        rows, cols = pairs[positions]
        if name == "linear_svm_binary":
            model = newton_svm.squared_hinge_svm(rows.withColumn("label", binary_label("label", 0.0)))
        elif name == "linear_svm_multiclass":
            model = newton_svm.squared_hinge_svm(rows, multiclass=True)
        elif name == "rbf_svm":
            model = kernel_svm.kernel_svm(rows, cols)
        else:
            model = classify.classifier("logistic", features="features", family="multinomial", regParam=1.0 / rows.count(), standardization=False).fit(rows)
        surface = classify.decision_surface(model, density.mesh_grid(rows, *cols, h=h), cols)
        found.append(surface.select(F.lit(name).alias("model"), F.lit(" x ".join(cols)).alias("pair"), F.col(cols[0]).alias("x"), F.col(cols[1]).alias("y"), "prediction"))
    return relational.union_all(found)


# --- recommendation --------------------------------------------------------------


def _rated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(training, test) of the active triplets; the ids are integers already."""
    rows = active(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("user"),
        F.col("song_id").cast("int").alias("item"),
        F.col("playcount").alias("rating"),
    )
    return sampling.user_holdout(stage(rows, "rated"))


@query(
    "als_train",
    f"""{ACTIVE_SQL} SELECT 'user' AS side, user_id AS id, 10 AS rank FROM training GROUP BY 2
UNION ALL SELECT 'item', song_id, 10 FROM training GROUP BY 2""",
)
def als_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user and item of the training rows has a factor of length 10."""
    model = recommend.train_als(_rated(spark, sf_dir)[0])
    sides = [("user", model.userFactors), ("item", model.itemFactors)]
    return relational.union_all(
        [
            factors.select(F.lit(name).alias("side"), F.col("id").cast("long").alias("id"), F.size("features").alias("rank"))
            for name, factors in sides
        ]
    )


@query(
    "als_recommend",
    f"""{ACTIVE_SQL}, chosen AS (SELECT DISTINCT user_id FROM (SELECT * FROM test ORDER BY playcount DESC, user_id, song_id LIMIT 10))
SELECT user_id AS "user", p::INTEGER AS position, true AS known FROM chosen, range(1, 11) r(p)
WHERE EXISTS (SELECT 1 FROM training t WHERE t.user_id = chosen.user_id)""",
)
def als_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten places for every chosen user, and whether the item there occurs in training."""
    training, test = _rated(spark, sf_dir)
    users = stage(relational.top_users(test, 10), "users")
    found = recommend.recommend_rows(recommend.train_als(training), users, 10)
    items = training.select("item").distinct().withColumn("known", F.lit(True))
    rows = found.join(items, "item", "left").select(F.col("user").cast("long").alias("user"), "position", F.coalesce("known", F.lit(False)).alias("known"))
    return rows


@query(
    "als_predict",
    f"""{ACTIVE_SQL} SELECT user_id AS "user", song_id AS item, playcount AS rating,
  EXISTS (SELECT 1 FROM training t WHERE t.user_id = test.user_id)
    AND EXISTS (SELECT 1 FROM training t WHERE t.song_id = test.song_id) AS scored FROM test""",
)
def als_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test pairs and whether they have a usable score: both sides seen in training."""
    training, test = _rated(spark, sf_dir)
    predicted = recommend.predict_ratings(recommend.train_als(training), test)
    return predicted.select(
        F.col("user").cast("long").alias("user"), F.col("item").cast("long").alias("item"), "rating",
        (~F.isnan("prediction")).alias("scored"),
    )


@query("recommendation_experiment")
def recommendation_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.recommendation_experiment(triplets_table(spark, sf_dir), mismatches(spark, sf_dir))
