"""The shared search against one fit per point and fold."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tastecore.operators import classify
from tastecore.operators.logistic_grid import LogisticSearch


def _rows(spark, n=600, seed=5, constant=True):
    """Overlapping classes, columns of very different scale and offset, one of them constant, two correlated."""
    draw = np.random.default_rng(seed)
    y = (draw.uniform(size=n) < 0.35).astype(float)
    x = draw.normal(size=(n, 5)) + 0.8 * y[:, None] * np.array([1.0, 0.5, 0.0, -0.7, 0.2])
    x[:, 1] += 0.7 * x[:, 0]
    x = x * np.array([1.0, 40.0, 0.01, 3.0, 1.0]) + np.array([0.0, 500.0, 0.0, -7.0, 2.0])
    if constant:
        x = np.c_[x, np.full(n, 3.0)]
    data = [(float(a), int(f), Vectors.dense(v)) for a, f, v in zip(y, draw.integers(0, 3, n), x)]
    return spark.createDataFrame(data, ["label", "fold", "scfeatures"]).repartition(3).cache()


@pytest.fixture(scope="module")
def found(spark):
    rows = _rows(spark)
    return rows, LogisticSearch(classify.LOGISTIC_GRID).fit(rows)


def test_scores_and_choice_equal_one_fit_per_point_and_fold(found):
    rows, model = found
    estimator = classify.classifier("logistic", maxIter=500, tol=1e-10)
    search = classify.cross_validate(estimator, classify.LOGISTIC_GRID, folds=3, fold_col="fold", parallelism=8)
    want = search.fit(rows)
    names = [{p.name: v for p, v in point.items()} for point in search.getEstimatorParamMaps()]
    assert model.points == names and model.converged
    assert model.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-9)
    assert model.best == int(np.argmax(want.avgMetrics))
    assert model.bestModel.coefficients[0] == pytest.approx(want.bestModel.coefficients.toArray(), rel=1e-4, abs=1e-6)
    assert model.bestModel.intercepts[0] == pytest.approx(want.bestModel.intercept, rel=1e-4)


@pytest.mark.parametrize("reg,mix", [(0.0, 0.0), (0.25, 0.0), (0.05, 0.5), (0.02, 1.0)])
def test_coefficients_equal_a_single_fit(spark, reg, mix):
    rows = _rows(spark, seed=9)
    model = LogisticSearch({"regParam": [reg], "elasticNetParam": [mix]}).fit(rows)
    want = classify.classifier("logistic", regParam=reg, elasticNetParam=mix, maxIter=1000, tol=1e-12).fit(rows)
    assert model.bestModel.coefficients[0] == pytest.approx(want.coefficients.toArray(), rel=1e-4, abs=1e-7)
    assert [c == 0 for c in model.bestModel.coefficients[0]] == [c == 0 for c in want.coefficients]


def test_passes_do_not_grow_with_the_grid(spark, found):
    rows, whole = found
    alone = [LogisticSearch({"regParam": [r], "elasticNetParam": [m]}).fit(rows).passes for r, m in ((0.0, 0.0), (0.25, 0.5))]
    assert whole.passes <= 3 * max(alone) and whole.passes < 100


def test_model_transforms_and_matches_its_probability_side(found):
    rows, model = found
    out = model.transform(rows).select("label", "prediction", F.col("rawPrediction").alias("r")).collect()
    assert {r["prediction"] for r in out} <= {0.0, 1.0}
    assert all((r["r"][1] > 0) == (r["prediction"] == 1.0) for r in out)


def test_registered_search_equals_single_fits_on_the_vectors(spark):
    """The query on the given table, point by point, against Spark's own cross validation."""
    from tastecore.operators import sampling
    from tastecore.queries import QUERIES
    from tastecore.queries.tables import embedded_binary

    sf = "/root/testdata/sf0.01"
    rows = sampling.with_folds(embedded_binary(spark, sf), ["vec_id"], 5).cache()
    estimator = classify.classifier("logistic", maxIter=500, tol=1e-10)
    grid = {"elasticNetParam": [0.0, 0.5], "regParam": [0.25, 0.5]}  # on 500 vectors the classes are separable without a penalty
    search = classify.cross_validate(estimator, grid, folds=5, fold_col="fold", parallelism=8)
    want = {", ".join(sorted(f"{p.name}={v}" for p, v in point.items())): m for point, m in zip(search.getEstimatorParamMaps(), search.fit(rows).avgMetrics)}
    found = {r["point"]: (r["f1"], r["chosen"]) for r in QUERIES["cv_logistic_scores"](spark, sf).collect()}
    assert len(found) == 9 and sum(c for _, c in found.values()) == 1
    assert {p: found[p][0] for p in want} == pytest.approx(want, abs=1e-9)


def test_one_class_nulls_extra_columns_and_bad_input(spark):
    one = spark.createDataFrame([(0.0, i % 2, Vectors.dense([float(i)]), "x") for i in range(8)], ["label", "fold", "scfeatures", "features"])
    model = LogisticSearch({"regParam": [0.0, 0.1]}).fit(one)
    assert model.avgMetrics == [1.0, 1.0] and {r["prediction"] for r in model.transform(one).collect()} == {0.0}
    rows = _rows(spark, 60)
    dirty = rows.unionByName(rows.limit(3).withColumn("label", F.lit(None).cast("double"))).unionByName(rows.limit(2).withColumn("fold", F.lit(None).cast("long")))
    assert LogisticSearch({"regParam": [0.1]}).fit(dirty).avgMetrics == pytest.approx(LogisticSearch({"regParam": [0.1]}).fit(rows).avgMetrics)
    with pytest.raises(ValueError, match="no rows"):
        LogisticSearch({"regParam": [0.1]}).fit(rows.limit(0))
    with pytest.raises(ValueError, match="labels"):
        LogisticSearch({"regParam": [0.1]}).fit(rows.withColumn("label", F.col("label") + 1))
    with pytest.raises(ValueError, match="grid"):
        LogisticSearch({"maxIter": [1]})
