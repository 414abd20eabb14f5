import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tastecore.operators import metrics, ranking


def _ranked(spark, predicted, truth, k, k_ndcg=None):
    """predicted and truth: user -> list of items."""
    p = [(u, i + 1, x) for u, items in predicted.items() for i, x in enumerate(items)]
    t = [(u, x) for u, items in truth.items() for x in items]
    return ranking.ranking_metrics(
        spark.createDataFrame(p, "user int, position int, item int"),
        spark.createDataFrame(t, "user int, item int"),
        k,
        k_ndcg,
    ).head()


@pytest.mark.parametrize(
    "predicted, truth, k",
    [([1, 2, 3], [1, 2], 3), ([1, 2], [1, 2], 3), ([1, 2], [1, 2, 3], 2), ([1, 2, 3], [1, 2, 3], 2)],
)
def test_ndcg_with_surplus_or_missing_predictions(spark, predicted, truth, k):
    assert _ranked(spark, {1: predicted}, {1: truth}, k)["ndcg_at_k"] == 1.0


def test_one_prediction_of_three(spark):
    row = _ranked(spark, {1: [1]}, {1: [1, 2, 3]}, 5)
    assert tuple(row) == pytest.approx((0.2, 0.46927872602275644, 1 / 3))


def test_published_three_users(spark):
    predicted = {1: [50, 51, 1, *range(52, 59)], 2: list(range(10)), 3: list(range(10))}
    truth = {1: [1, 2, 3, 4], 2: list(range(100, 121)), 3: list(range(100, 109))}
    row = _ranked(spark, predicted, truth, 5, 10)
    assert tuple(row) == pytest.approx((0.06666666666666667, 0.06506334166535027, 0.027777777777777776))


def test_user_without_truth_counts_as_zero(spark):
    assert tuple(_ranked(spark, {1: [90, 91], 2: [1, 2]}, {2: [1]}, 2)) == pytest.approx((0.25, 0.5, 0.5))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranking_against_brute_force(spark, seed):
    draw = random.Random(seed)
    predicted = {u: draw.sample(range(40), draw.randrange(1, 12)) for u in range(30)}
    truth = {u: draw.sample(range(40), draw.randrange(0, 15)) for u in range(30)}
    k, sums = 6, [0.0, 0.0, 0.0]
    for u, items in predicted.items():
        hits, ap, dcg = 0, 0.0, 0.0
        for i, item in enumerate(items):
            if item in truth[u]:
                hits += 1
                ap += hits / (i + 1)
                dcg += 1 / math.log2(i + 2) if i < k else 0
        ideal = sum(1 / math.log2(i + 2) for i in range(min(len(truth[u]), k)))
        sums[0] += sum(x in truth[u] for x in items[:k]) / k
        sums[1] += dcg / ideal if ideal else 0
        sums[2] += ap / len(truth[u]) if truth[u] else 0
    assert tuple(_ranked(spark, predicted, truth, k)) == pytest.approx([s / 30 for s in sums])


def _counted(spark, tp, fp, tn, fn):
    rows = spark.createDataFrame([(tp, fp, tn, fn)], "tp long, fp long, tn long, fn long")
    row = metrics.precision_recall_f1(rows).head()
    return tuple(round(row[c], 3) for c in ("precision", "recall", "f1"))


def test_published_confusion_rows(spark):
    assert _counted(spark, 0, 0, 113850, 12186) == (0, 0, 0)
    assert _counted(spark, 8366, 27506, 86344, 3820) == (0.233, 0.687, 0.348)


@pytest.fixture(scope="module")
def scored(spark):
    """Half of the scores are distinct, a third of the rows share one score."""
    draw = random.Random(5)
    rows = []
    for i in range(3000):
        label = float(draw.random() < 0.3)
        score = 0.5 if i % 3 == 0 else round(draw.random() + 0.2 * label, 6)
        rows.append((label, float(score > 0.6), score))
    return spark.createDataFrame(rows, "label double, prediction double, score double").cache()


def test_confusion_counts(scored):
    rows = [tuple(r) for r in scored.select("label", "prediction").collect()]
    want = tuple(rows.count(p) for p in ((1.0, 1.0), (0.0, 1.0), (0.0, 0.0), (1.0, 0.0)))
    assert tuple(metrics.confusion_counts(scored).head()) == want


def test_auc_and_curve(scored, many_chunks):
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scored)
    assert metrics.roc_auc(scored).head()["auc"] == pytest.approx(exact)
    points = metrics.roc_curve(scored).orderBy(F.desc("threshold")).collect()
    area, x, y = 0.0, 0.0, 0.0
    for p in points:
        assert p["fpr"] >= x and p["tpr"] >= y
        area += (p["fpr"] - x) * (p["tpr"] + y) / 2
        x, y = p["fpr"], p["tpr"]
    assert (x, y) == (1.0, 1.0) and area == pytest.approx(exact)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.3)], "label double, score double")
    assert metrics.roc_auc(df).head()["auc"] is None


def test_multiclass_metrics_equal_spark(spark):
    draw = random.Random(6)
    rows = [(float(draw.choice([0, 0, 0, 1, 2])), float(draw.randrange(4))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "label double, prediction double").cache()
    row = metrics.multiclass_metrics(df).head()
    for ours, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))


def test_rmse_skips_unusable_predictions(spark):
    df = spark.createDataFrame([(1, 2.0), (4, 2.0), (9, float("nan")), (9, None)], "rating int, prediction float")
    assert metrics.rmse(df).head()["rmse"] == pytest.approx(math.sqrt(2.5))
