import math
import random

import pytest
from pyspark.sql import functions as F

from tastecore.functions import project_items, safe_ratio, unit_hash
from tastecore.operators import aggregates, joins, quantiles, relational


def test_anti_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, 5), (None, 6), (2, 7)], "song_id int, playcount int")
    right = spark.createDataFrame([(1, "t"), (None, "u")], "song_id int, track_id string")
    assert {r["song_id"] for r in joins.remove_mismatches(left, right).collect()} == {None, 2}


def test_accepted_songs_stay(spark):
    left = spark.createDataFrame([(1, 5), (2, 7)], "song_id int, playcount int")
    right = spark.createDataFrame([(1,), (2,)], "song_id int")
    kept = joins.remove_mismatches(left, right, accepted=spark.createDataFrame([(2,)], "song_id int"))
    assert [r["song_id"] for r in kept.collect()] == [2]


@pytest.mark.parametrize("seed", [1, 2])
def test_active_triplets_against_brute_force(spark, seed):
    draw = random.Random(seed)
    rows = {(draw.randrange(40), 0 if draw.random() < 0.33 else draw.randrange(60)) for _ in range(600)}
    rows = [(u, s, draw.randrange(1, 20)) for u, s in sorted(rows)]
    plays, songs = {}, {}
    for u, s, n in rows:
        plays[s] = plays.get(s, 0) + n
        songs[u] = songs.get(u, 0) + 1

    def quantile(values):
        values = sorted(values)
        return values[max(0, math.ceil(0.25 * len(values)) - 1)]

    low_p, low_s = quantile(plays.values()), quantile(songs.values())
    want = sorted(r for r in rows if plays[r[1]] >= low_p and songs[r[0]] >= low_s)
    df = spark.createDataFrame(rows, "user_id int, song_id int, playcount int")
    got = joins.active_triplets(df).select("user_id", "song_id", "playcount").collect()
    assert sorted(map(tuple, got)) == want


def test_attach_label_multiplies_rows_and_plans_inner(spark):
    features = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "track_id string, x double")
    labels = spark.createDataFrame([("a", "Pop"), ("a", "Rap"), ("b", None)], "track_id string, genre string")
    out = joins.attach_label(features, labels, "track_id", "genre")
    assert sorted(r["genre"] for r in out.collect()) == ["Pop", "Rap"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan


def test_top_k_is_not_a_full_sort(spark):
    out = relational.top_k(spark.range(100).withColumn("v", F.col("id") % 7), "v", 3, ["id"])
    assert [tuple(r) for r in out.collect()] == [(6, 6), (13, 6), (20, 6)]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_top_rows_limit_each_group_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50))
    lists = aggregates.ordered_lists(df, "g", "id", [F.desc("id")], 2)
    got = {r["g"]: list(r["items"]) for r in lists.collect()}
    assert got[0] == [999, 996] and all(len(v) <= 2 for v in got.values())
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan


def test_filters(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k int, p double")
    assert [r["k"] for r in relational.drop_nan(df, "p").collect()] == [1]
    assert [r["k"] for r in relational.filter_not_null(df, ["p"]).orderBy("k").collect()] == [1, 2]
    wanted = spark.createDataFrame([(2,), (9,)], "x int")
    assert [r["k"] for r in relational.filter_in(df, "k", wanted).collect()] == [2]
    assert relational.filter_below_quantile(df, "k", 0.5).count() == 1
    assert relational.filter_below_quantile(df, "k", 0.5, strict=False).count() == 2


def test_distinct_count_counts_null(spark):
    df = spark.createDataFrame([(1,), (None,), (2,), (1,), (None,), (2,)], "k int")
    assert aggregates.distinct_count(df, ["k"]).head()["k"] == 3
    assert aggregates.distinct_count(df, ["k"], approx=True).head()["k"] == 3


def test_most_active_and_songs(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 9)], "user_id string, song_id int, playcount int")
    top = aggregates.most_active(df)
    assert tuple(top.head()) == ("a", 10, 2)
    assert {r["song_id"] for r in aggregates.songs_of(df, top).collect()} == {1, 2}


def test_describe_wide_equals_narrow(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 4), (2.0, None), (4.0, 6)], "a double, b int")
    narrow = {r["column"]: tuple(r) for r in aggregates.describe_columns(df, ["a", "b"]).collect()}
    monkeypatch.setattr(aggregates, "COLUMNS_AT_ONCE", 1)
    wide = {r["column"]: tuple(r) for r in aggregates.describe_columns(df, ["a", "b"]).collect()}
    assert narrow == wide and narrow["b"][1:] == (2, 5.0, pytest.approx(math.sqrt(2)), 4.0, 6.0)


def test_correlation_of_constant_column_is_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    out = {(r["i"], r["j"]): r["corr"] for r in aggregates.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert out["a", "b"] == 0.99 and math.isnan(out["a", "c"]) and out["a", "a"] == 1.0


@pytest.mark.parametrize("n, want", [(7, [1, 2, 4, 6, 7]), (10, [1, 3, 5, 8, 10]), (11, [1, 3, 6, 9, 11])])
def test_discrete_quantiles(spark, n, want):
    df = spark.range(1, n + 1).withColumnRenamed("id", "v")
    assert [r["value"] for r in quantiles.quantiles(df, "v").orderBy("prob").collect()] == want
    assert df.approxQuantile("v", [0.0, 0.25, 0.5, 0.75, 1.0], 0.0) == want


@pytest.mark.parametrize("n, want", [(7, (1, 2.5, 4, 5.5, 7)), (10, (1, 3.25, 5.5, 7.75, 10))])
def test_interpolated_quartiles(spark, n, want):
    row = quantiles.summary_quartiles(spark.range(1, n + 1), ["id"]).head()
    assert (row["min"], row["q1"], row["median"], row["q3"], row["max"]) == want
    assert row["mean"] == (n + 1) / 2


def _skewed(spark):
    """40,000 rows: a third equals 5.0, the others are spread out, a few are null."""
    value = F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 40009) / 400.0)
    return spark.range(40_000).select(F.when(F.col("id") % 997 != 0, value).alias("v"))


@pytest.mark.parametrize("probs", [(0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0), (0.05,), (0.0, 1.0)])
def test_bracketed_quantiles_are_exact(spark, many_chunks, probs):
    df = _skewed(spark)
    want = [r["value"] for r in quantiles.quantiles(df, "v", probs).orderBy("prob").collect()]
    values = sorted(r["v"] for r in df.dropna().collect())
    assert want == [values[max(0, math.ceil(p * len(values)) - 1)] for p in probs]


def test_missed_marks_cost_a_round_only(spark, monkeypatch):
    df = _skewed(spark)
    want = quantiles.summary_quartiles(df, ["v"]).head()
    read, turns = quantiles._read_sketches, []

    def wrong(spark, asked):
        """Marks far below, then far above all wanted ranks, in the first two rounds."""
        turns.append(len(asked))
        found = read(spark, asked)
        return [[0.1, q[1], 0.2] if len(turns) == 1 else [99.0, q[1], 99.5] for q in found] if len(turns) < 3 else found

    monkeypatch.setattr(quantiles, "_read_sketches", wrong)
    assert quantiles.summary_quartiles(df, ["v"]).head() == want and len(turns) > 3


@pytest.mark.parametrize("size", [16, 64])
def test_many_rounds_with_small_sketches(spark, monkeypatch, size):
    """Sketches that err a lot, equal values at the marks, infinities, NaN, and two values only."""
    monkeypatch.setattr(quantiles, "SKETCH_SIZE", size)
    monkeypatch.setattr(quantiles, "REACH", 0.05)
    probs = [i / 20 for i in range(21)]
    noise = F.when(F.col("id") % 50 == 0, float("inf")).when(F.col("id") % 50 == 1, float("nan")).when(F.col("id") % 50 == 2, float("-inf"))
    for value in (noise.otherwise(F.col("id") * 7919 % 5003), (F.col("id") % 3 == 0).cast("int"), F.col("id") * 7919 % 5003):
        df = spark.range(5_000).select(value.alias("v")).repartition(5)
        values = sorted((r["v"] for r in df.collect()), key=lambda v: (v != v, v))
        found = [r["value"] for r in quantiles.quantiles(df, "v", probs).orderBy("prob").collect()]
        want = [values[max(0, math.ceil(p * len(values)) - 1)] for p in probs]
        assert [repr(v) for v in found] == [repr(v) for v in want]


def test_a_sketch_holds_all_values_of_its_size(spark):
    df = spark.range(quantiles.SKETCH_SIZE).select((F.col("id") * 7919 % 10007).cast("double").alias("v")).repartition(9)
    sketch = quantiles._sketched(df, {"s": F.col("v")}, quantiles.SKETCH_SIZE).head()["s"]
    n = quantiles.SKETCH_SIZE
    found = quantiles._read_sketches(spark, [(sketch, [(i + 0.5) / n for i in range(n)])])[0]
    assert found == sorted(r["v"] for r in df.collect())


def test_quantiles_of_tables_in_the_same_rounds(spark):
    few, many = spark.range(1, 8).withColumnRenamed("id", "a"), _skewed(spark)
    a, b = quantiles.quantile_values([(few, "a"), (many, "v")], 0.25)
    row = spark.range(1).select(a.alias("a"), b.alias("b")).head()
    assert (row["a"], row["b"]) == (2, quantiles.quantiles(many, "v", [0.25]).head()["value"])


def test_quantiles_of_words_and_dates(spark):
    df = spark.createDataFrame([(w, f"2020-01-0{i + 1}") for i, w in enumerate("edcba")], "w string, d string").select("w", F.to_date("d").alias("d"))
    assert [r["value"] for r in quantiles.quantiles(df, "w", [0.0, 0.5, 1.0]).orderBy("prob").collect()] == ["a", "c", "e"]
    assert str(quantiles.quantiles(df, "d", [0.5]).head()["value"]) == "2020-01-03"


def test_bracketed_quartiles_interpolate(spark):
    df = _skewed(spark)
    want = quantiles.summary_quartiles(df, ["v"]).head()
    assert df.agg(F.percentile("v", 0.75)).head()[0] == pytest.approx(want["q3"])
    assert (want["min"], want["max"]) == tuple(df.agg(F.min("v"), F.max("v")).head())
    assert want["mean"] == pytest.approx(df.agg(F.avg("v")).head()[0])


def test_quartiles_are_the_same_whatever_the_partitions(spark):
    df = _skewed(spark)
    assert len({tuple(quantiles.summary_quartiles(df.repartition(n), ["v"]).drop("mean").head()) for n in (1, 7, 40)}) == 1


def test_last_task_reads_as_many_sketches_for_any_input(spark, many_chunks):
    for parts in (100, 300):
        plan = quantiles._sketched(_skewed(spark).repartition(parts), {"s": F.col("v")}, 200)
        inner = plan.select(F.kll_sketch_get_n_double("s")).head()[0]
        groups = _skewed(spark).repartition(parts).select((F.spark_partition_id() % quantiles.MERGED_GROUPS).alias("g")).distinct().count()
        assert inner == _skewed(spark).dropna().count() and groups <= quantiles.MERGED_GROUPS


def test_approximate_quantile(spark):
    found = quantiles.quantiles(_skewed(spark), "v", [0.5], error=0.01).head()["value"]
    values = sorted(r["v"] for r in _skewed(spark).dropna().collect())
    low, high = (values[int(len(values) * p)] for p in (0.48, 0.52))
    assert low <= found <= high


def test_describe_an_empty_table(spark):
    for width in (3, 120):
        empty = spark.range(0).select(*[F.col("id").alias(f"c{i}") for i in range(width)])
        rows = aggregates.describe_columns(empty, empty.columns).collect()
        assert len(rows) == width and all(tuple(r)[1:] == (0, None, None, None, None) for r in rows)


def test_matched_popularity_equals_summing_what_is_left(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("b", 1, 2), ("a", 2, 7), ("a", None, 3)], "user_id string, song_id int, playcount int")
    bad = spark.createDataFrame([(2,), (2,), (None,)], "song_id int")
    left = {tuple(r) for r in aggregates.matched_popularity(rows, bad).collect()}
    assert left == {tuple(r) for r in aggregates.song_popularity(joins.remove_mismatches(rows, bad)).collect()}
    for broadcast in ("-1",):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        plan = aggregates.matched_popularity(rows, bad)._jdf.queryExecution().optimizedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.index("Join") < plan.index("Aggregate")  # the aggregate lies below the join


def test_quantiles_of_long_values_keep_every_digit(spark):
    df = spark.range(5).select((F.col("id") + 2**60).alias("v"))
    assert [r["value"] - 2**60 for r in quantiles.quantiles(df, "v").orderBy("prob").collect()] == [0, 1, 2, 3, 4]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v int")
    assert {r["value"] for r in quantiles.quantiles(empty, "v").collect()} <= {None}
    assert relational.filter_below_quantile(empty, "v", 0.25).count() == 0


def test_column_helpers(spark):
    row = spark.range(1).select(
        safe_ratio(F.lit(1), F.lit(0)).alias("a"),
        project_items(F.array(F.struct(F.lit(7).alias("item"), F.lit(0.5).alias("rating")))).alias("b"),
        unit_hash([F.lit(None), F.lit("x")]).alias("c"),
    ).head()
    assert row["a"] == 0.0 and list(row["b"]) == [7] and 0 <= row["c"] < 1
