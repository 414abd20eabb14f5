"""Models on planted data: blobs, rings, a low-rank rating matrix."""

import math
import threading

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tastecore.operators import classify, density, features, metrics, recommend, svm
from tastecore.plans import flows


def _frame(spark, points, classes):
    rows = [(i, float(x), float(y), float(c), f"class_{int(c)}") for i, ((x, y), c) in enumerate(zip(points, classes))]
    df = spark.createDataFrame(rows, "id int, m_x double, m_y double, label double, genre string")
    return features.prepare(df.coalesce(1), "m_").cache()


@pytest.fixture(scope="module")
def blobs(spark):
    """Three blobs of very different size."""
    draw = np.random.default_rng(1)
    sizes, centres = (200, 100, 60), ((0, 0), (6, 0), (0, 6))
    points = np.vstack([draw.normal(c, 0.7, (n, 2)) for n, c in zip(sizes, centres)])
    return _frame(spark, points, np.repeat([0, 1, 2], sizes))


@pytest.fixture(scope="module")
def rings(spark):
    draw = np.random.default_rng(2)
    angle, radius = draw.uniform(0, 2 * np.pi, 400), np.repeat([0.5, 2.0], 200) + draw.normal(0, 0.1, 400)
    return _frame(spark, np.c_[radius * np.cos(angle), radius * np.sin(angle)], np.repeat([0, 1], 200))


def _accuracy(model, df):
    return metrics.multiclass_metrics(model.transform(df)).head()["accuracy"]


@pytest.mark.parametrize("kind", ["logistic", "forest", "tree"])
def test_classifiers_separate_blobs(blobs, kind):
    assert _accuracy(classify.classifier(kind).fit(blobs), blobs) > 0.97


def test_one_vs_rest_uses_the_scaled_column(blobs):
    model = classify.one_vs_rest(classify.classifier("logistic", maxIter=20)).fit(blobs)
    assert {m.getFeaturesCol() for m in model.models} == {"scfeatures"}
    assert _accuracy(model, blobs) > 0.97


class _Watched(LogisticRegression):
    """Notes the partitions it is fitted on, and the local property of its thread after another fit has set its own."""

    def _fit(self, dataset):
        context = dataset.sparkSession.sparkContext
        if threading.current_thread() is not threading.main_thread():
            own = f"{threading.get_ident()}"
            context.setLocalProperty("tastecore.fit", own)
            self.together.wait(60)
            self.seen.append((context.getLocalProperty("tastecore.fit") == own, dataset.rdd.getNumPartitions()))
            self.together.wait(60)
        return super()._fit(dataset)


@pytest.fixture()
def watched(monkeypatch):
    monkeypatch.setattr(_Watched, "together", threading.Barrier(2), raising=False)
    monkeypatch.setattr(_Watched, "seen", [], raising=False)
    return _Watched(featuresCol="scfeatures", labelCol="label", maxIter=2)


def test_fits_of_a_search_do_not_share_local_properties(blobs, watched):
    rows = blobs.withColumn("fold", F.col("id") % 2)
    classify.cross_validate(watched, {"regParam": [0.1, 0.2]}, folds=2, fold_col="fold", parallelism=2).fit(rows)
    assert [own for own, _ in watched.seen] == [True] * 4


def test_fits_of_one_vs_rest_do_not_share_local_properties(blobs, watched):
    classify.one_vs_rest(watched, parallelism=2).fit(blobs.filter("label < 2"))
    assert [own for own, _ in watched.seen] == [True] * 2


def test_partitions_of_a_search_follow_the_size_of_its_rows(blobs, watched, monkeypatch):
    rows = blobs.withColumn("fold", F.col("id") % 2).repartition(8, "id")
    monkeypatch.setattr(type(rows.sparkSession.sparkContext), "defaultParallelism", 2)
    for size, parts in ((classify.PART_BYTES, 1), (360 * 2 * 8 // 3, 3)):  # of 360 rows with two values
        monkeypatch.setattr(classify, "PART_BYTES", size)
        classify.cross_validate(watched, {"regParam": [0.1, 0.2]}, folds=2, fold_col="fold", parallelism=2).fit(rows)
        assert {n for _, n in watched.seen} == {parts}
        watched.seen.clear()


def test_search_grids_have_the_published_sizes(spark):
    for kind, grid, points in (
        ("logistic", classify.LOGISTIC_GRID, 9),
        ("forest", classify.FOREST_GRID, 72),
        ("tree", classify.TREE_GRID, 18),
    ):
        assert math.prod(map(len, grid.values())) == points
        search = classify.cross_validate(classify.classifier(kind), grid)
        assert len(search.getEstimatorParamMaps()) == points


def test_cross_validation_binds_the_grid_to_its_estimator(blobs):
    search = classify.cross_validate(classify.classifier("tree"), {"maxDepth": [1, 5]}, folds=2)
    assert {p.name for point in search.getEstimatorParamMaps() for p in point} == {"maxDepth"}
    model = search.fit(blobs)
    assert model.avgMetrics[1] > model.avgMetrics[0]


def test_linear_svm(blobs):
    two = blobs.withColumn("label", F.when(F.col("label") == 1.0, 1.0).otherwise(0.0))
    assert _accuracy(svm.linear_svm(two, maxIter=15), two) > 0.97
    assert _accuracy(svm.linear_svm(blobs, multiclass=True, maxIter=15), blobs) > 0.97


def test_linear_svm_penalises_the_raw_columns(spark):
    """The coefficients minimise mean hinge loss + |w|^2 / (2 C n) on columns of very different scale."""
    draw = np.random.default_rng(4)
    y = np.repeat([0.0, 1.0], 60)
    x = np.stack([draw.normal(y * 1.5, 1.0), 20 * draw.normal(y, 1.0)], axis=1)
    rows = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "m_x double, m_y double, label double")
    data, c = features.assemble(rows, ["m_x", "m_y"], "scfeatures"), 0.05
    model = svm.linear_svm(data, "scfeatures", c=c, maxIter=300, tol=1e-10)

    def loss(w, b):
        return np.maximum(0, 1 - (2 * y - 1) * (x @ w + b)).mean() + w @ w / (2 * c * len(y))

    w, b = model.coefficients.toArray(), model.intercept
    steps = [(np.array(d) * s, e * s) for d in ([1, 0], [0, 1], [-1, 0], [0, -1], [0, 0]) for e in (-1, 0, 1) for s in (0.02, 0.005)]
    assert all(loss(w, b) <= loss(w + dw, b + db) + 1e-6 for dw, db in steps)


def test_rings_need_the_kernel(rings):
    assert _accuracy(svm.linear_svm(rings, maxIter=15), rings) < 0.8
    raw = rings.select("m_x", "m_y", "label")
    assert _accuracy(svm.rbf_svm(raw, ["m_x", "m_y"], n_features=100, maxIter=15), raw) > 0.97


def test_fourier_features_approach_the_kernel(spark):
    df = spark.createDataFrame([(0.2, 0.7), (0.6, 0.3)], "x double, y double")
    want, errors = math.exp(-0.7 * (0.4**2 + 0.4**2)), []
    for n in (20, 300):
        a, b = (np.array(r) for r in df.select(*svm.fourier_columns(["x", "y"], 0.7, n)).collect())
        errors.append(abs(float(a @ b) - want))
    assert errors[0] < 0.5 and errors[1] < 0.15


def test_fourier_columns_equal_the_sql_map(spark):
    df = spark.createDataFrame([(0.2, 0.7)], "x double, y double")
    left = df.select(*svm.fourier_columns(["x", "y"], 0.7, 6, seed=4)).head()
    w, b = svm.fourier_weights(2, 0.7, 6, 4)
    assert list(left) == pytest.approx(list(np.sqrt(2 / 6) * np.cos(w @ np.array([0.2, 0.7]) + b)))
    raw = df.withColumn("label", F.lit(0.0)).union(spark.createDataFrame([(5.0, 5.0, 1.0)]))
    stage = svm.rbf_svm(raw, ["x", "y"], n_features=6, seed=4, maxIter=2).stages[0]
    mapped = stage.transform(df).select(*[f"rff_{i}" for i in range(6)]).head()
    assert list(mapped) == pytest.approx(list(left))


def test_decision_surface_covers_the_mesh(blobs):
    raw = features.assemble(blobs.select("m_x", "m_y", "label"), ["m_x", "m_y"], "features")
    model = classify.classifier("tree", features="features").fit(raw)
    mesh = density.mesh_grid(raw, "m_x", "m_y", h=0.5)
    out = classify.decision_surface(model, mesh, ["m_x", "m_y"]).collect()
    assert len(out) == mesh.count()
    near = min(out, key=lambda r: (r["m_x"] - 6) ** 2 + r["m_y"] ** 2)
    assert near["prediction"] == 1.0


def test_binary_experiment(blobs):
    tree = classify.classifier("tree", seed=1)
    search = classify.cross_validate(tree, {"maxDepth": [1, 3]}, folds=2, fold_col=flows.FOLD)
    out = flows.binary_experiment(blobs, [("tree", tree, search)], "class_2", ["id"], folds=2)
    assert out.columns == ["tp", "fp", "tn", "fn", "precision", "recall", "f1", "auc", "algorithm", "variant"]
    rows = {r["variant"]: r for r in out.collect()}
    assert set(rows) == {"normal", "balance", "cv"}
    assert len({r["tp"] + r["fn"] for r in rows.values()}) == 1
    assert len({r["tp"] + r["fp"] + r["tn"] + r["fn"] for r in rows.values()}) == 1
    assert all(r["f1"] > 0.9 and r["auc"] > 0.9 for r in rows.values()), rows


def test_multiclass_experiment(blobs):
    logistic = classify.classifier("logistic", maxIter=20)
    out = flows.multiclass_experiment(blobs, [("logistic", logistic, None)], ["id"], cap=80)
    assert out.columns == ["accuracy", "precision", "recall", "f1", "algorithm", "variant"]
    rows = {r["variant"]: r["accuracy"] for r in out.collect()}
    assert set(rows) == {"normal", "balance", "one-vs-rest"} and min(rows.values()) > 0.95


@pytest.fixture(scope="module")
def ratings(spark):
    """Rank 3 plus small noise; 60 users x 40 items."""
    draw = np.random.default_rng(3)
    matrix = draw.uniform(0.5, 2, (60, 3)) @ draw.uniform(0.5, 2, (3, 40)) + draw.normal(0, 0.05, (60, 40))
    rows = [(u, i, float(matrix[u, i])) for u in range(60) for i in range(40)]
    return spark.createDataFrame(rows, "user int, item int, rating double").coalesce(1).cache()


def test_als_recovers_a_low_rank_matrix(ratings):
    from tastecore.operators.sampling import user_holdout

    training, test = user_holdout(ratings)
    model = recommend.train_als(training, rank=3, regParam=0.01)
    error = metrics.rmse(recommend.predict_ratings(model, test)).head()["rmse"]
    spread = test.agg(F.stddev("rating")).head()[0]
    assert error < 0.2 * spread


def test_recommendations_are_ranked_and_cold_pairs_dropped(spark, ratings):
    model = recommend.train_als(ratings, rank=3)
    users = spark.createDataFrame([(1,), (2,)], "user int")
    lists = {r["user"]: list(r["recommends"]) for r in recommend.recommend(model, users, 4).collect()}
    rows = recommend.recommend_rows(model, users, 4).orderBy("user", "position").collect()
    assert {u: [r["item"] for r in rows if r["user"] == u] for u in (1, 2)} == lists
    assert all(len(set(v)) == 4 for v in lists.values())
    factors = {r["id"]: np.array(r["features"], float) for r in model.userFactors.collect()}
    songs = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    for r in rows:
        best = sorted((-float(factors[r["user"]] @ x), i) for i, x in songs.items())[r["position"] - 1]
        assert r["item"] == best[1] and r["score"] == pytest.approx(-best[0], rel=1e-12)
    cold = spark.createDataFrame([(1, 1, 2.0), (999, 1, 2.0)], "user int, item int, rating double")
    predicted = recommend.predict_ratings(model, cold)
    assert predicted.filter(F.isnan("prediction")).count() == 1
    assert metrics.rmse(predicted).head()["rmse"] is not None


@pytest.mark.parametrize("first_items", [1, 7, 500])
def test_best_products_equal_all_products(spark, first_items):
    """Ties, zero and negative scores, users without enough items, repeated factors, an item without any length."""
    draw = np.random.default_rng(first_items)
    items = [(i, [float(x) for x in draw.choice([-1.0, 0.0, 0.5, draw.normal() * 3], 4)]) for i in range(300)] + [(400, [0.0] * 4), (401, [9.0] * 4), (402, [9.0] * 4)]
    users = [(u, [float(x) for x in draw.normal(size=4)]) for u in range(6)] + [(7, [0.0] * 4), (8, [-1.0] * 4)]
    schema = "id int, features array<float>"
    table = spark.createDataFrame(items, schema).repartition(5)
    found = recommend.best_products(spark.createDataFrame(users, schema), table, 6, first_items)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    single = lambda v: np.array(v, np.float32).astype(float)
    for user, own in users:
        want = sorted((-sum(a * b for a, b in zip(single(own), single(x))), i) for i, x in items)[:6]
        rows = sorted((r["position"], r["item"], r["score"]) for r in found.filter(F.col("user") == user).collect())
        assert [(p, i) for p, i, _ in rows] == [(p, i) for p, (_, i) in enumerate(want, 1)]
        assert [s for *_, s in rows] == pytest.approx([-s for s, _ in want], abs=1e-12)
    few = recommend.best_products(spark.createDataFrame(users, schema), table.filter("id < 3"), 6)
    assert few.count() == 3 * len(users)
    assert recommend.best_products(spark.createDataFrame([], schema), table, 6).count() == 0
    assert recommend.best_products(spark.createDataFrame(users, schema), table.limit(0), 6).count() == 0


def test_recommendation_experiment(spark):
    draw = np.random.default_rng(4)
    cells = {(int(u), int(s)) for u, s in zip(draw.integers(0, 50, 3000), draw.integers(0, 60, 3000))}
    rows = [(f"u{u}", f"s{s}", int(draw.integers(1, 9))) for u, s in sorted(cells)]
    triplets = spark.createDataFrame(rows, "user_id string, song_id string, playcount int")
    mismatches = spark.createDataFrame([("s1", "t1")], "song_id string, track_id string")
    out = flows.recommendation_experiment(triplets, mismatches, users=3)
    assert out.columns == ["precision_at_k", "ndcg_at_k", "map", "rmse"]
    row = out.head()
    assert all(0 <= row[c] <= 1 for c in out.columns[:3]) and row["rmse"] > 0
