import math

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tastecore.operators import features, sampling


@pytest.fixture(scope="module")
def classes(spark):
    """5,000 rows, a third of them in one class, one rare class."""
    label = F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 100 == 1, "rare").otherwise("other")
    return spark.range(5000).withColumn("label", label)


def test_split_is_disjoint_whole_and_stable(classes):
    kept, rest = sampling.hash_split(classes, ["id"], 0.7)
    a, b = ({r["id"] for r in df.collect()} for df in (kept, rest))
    assert not a & b and len(a | b) == 5000
    assert abs(len(a) - 3500) < 4 * math.sqrt(5000 * 0.21)
    again, _ = sampling.hash_split(classes.repartition(7), ["id"], 0.7)
    assert {r["id"] for r in again.collect()} == a
    salted, _ = sampling.hash_split(classes, ["id"], 0.7, salt="x")
    assert {r["id"] for r in salted.collect()} != a


def test_balance_brings_classes_to_the_smallest(classes):
    sizes = {r["label"]: r["count"] for r in classes.groupBy("label").count().collect()}
    smallest = min(sizes.values())
    got = {r["label"]: r["count"] for r in sampling.balance(classes, "label", ["id"]).groupBy("label").count().collect()}
    assert got["rare"] == smallest
    for n in got.values():
        assert abs(n - smallest) <= 4 * math.sqrt(smallest)


def test_cap_uses_fractions_of_the_whole_table(classes):
    training, _ = sampling.hash_split(classes, ["id"], 0.7)
    capped = sampling.cap_classes(training, "label", 300, ["id"], fractions_from=classes)
    got = {r["label"]: r["count"] for r in capped.groupBy("label").count().collect()}
    assert got["rare"] == training.filter("label = 'rare'").count()
    for label in ("big", "other"):
        assert abs(got[label] - 0.7 * 300) <= 4 * math.sqrt(210)


def test_class_without_fraction_is_dropped(spark, classes):
    shares = spark.createDataFrame([("big", 1.0)], "label string, fraction double")
    out = sampling.sample_by(classes, shares, "label", ["id"])
    assert {r["label"] for r in out.select("label").distinct().collect()} == {"big"}


def test_user_holdout(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("user"), F.col("id").alias("item")
    )
    training, test = sampling.user_holdout(df)
    assert training.intersect(test).isEmpty()
    assert training.count() + test.count() == 4000
    assert abs(test.count() - 1200) < 4 * math.sqrt(4000 * 0.21)


def test_folds_cover_all_rows(classes):
    rows = sampling.with_folds(classes, ["id"], 5).groupBy("fold").count().collect()
    assert {r["fold"] for r in rows} == {0, 1, 2, 3, 4}
    assert all(abs(r["count"] - 1000) < 150 for r in rows)


def test_scale_divides_by_stddev_without_centring(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "m_a double, m_b double")
    rows = features.prepare(df, "m_").orderBy("m_a").select(vector_to_array("scfeatures").alias("v")).collect()
    assert [list(r["v"]) for r in rows] == [[1.0, 0.0], [2.0, 0.0], [3.0, 0.0]]


def test_null_feature_is_an_error(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "m double")
    with pytest.raises(Exception, match="(?i)null"):
        features.assemble(df, ["m"]).collect()


def test_string_codes_equal_string_indexer(spark, many_chunks):
    values = list("bbaac") + ["z"] * 3 + ["y"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    codes = {r["v"]: int(r["c"]) for r in features.index_strings(df, "v", "c").distinct().collect()}
    assert codes == {"z": 0, "a": 1, "b": 2, "c": 3, "y": 4}
    labels = StringIndexer(inputCol="v", outputCol="c").fit(df).labels
    assert [v for v, _ in sorted(codes.items(), key=lambda x: x[1])] == list(labels)


def test_value_without_code_is_an_error(spark):
    codes = spark.createDataFrame([("a", 0)], "v string, c long")
    df = spark.createDataFrame([("a",), ("q",)], "v string")
    with pytest.raises(Exception, match="v has no code: q"):
        features.index_strings(df, "v", "c", codes).collect()


def test_index_triplets(spark):
    df = spark.createDataFrame(
        [("u1", "s1", 3), ("u1", "s2", 1), ("u2", "s1", 2)], "user_id string, song_id string, playcount int"
    )
    out = features.index_triplets(df)
    assert out.dtypes == [("user", "int"), ("item", "int"), ("rating", "int")]
    assert sorted(map(tuple, out.collect())) == [(0, 0, 3), (0, 1, 1), (1, 0, 2)]
