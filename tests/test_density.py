import numpy as np
import pytest
from pyspark.sql import functions as F

from tastecore.operators import density


def _exact(values, points, h):
    grid = np.linspace(values.min(), values.max(), points)
    z = (grid[:, None] - values[None, :]) / h
    return grid, np.exp(-0.5 * z * z).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))


def _curve(df):
    rows = df.orderBy("i").collect()
    return np.array([r["x"] for r in rows]), np.array([r["density"] for r in rows])


def test_known_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "v double")
    x, y = _curve(density.kde(df, "v", points=3, bandwidth=0.5))
    assert list(x) == [1.0, 2.0, 3.0]
    assert y[:2] == pytest.approx([0.302044718093590, 0.337949475618539])


@pytest.mark.parametrize("collapse", [True, False])
def test_scott_against_direct_sum(spark, collapse):
    draw = np.random.default_rng(1)
    values = np.concatenate([np.full(300, 2.0), draw.normal(0, 1, 600)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    x, y = _curve(density.kde(df, "v", points=200, collapse=collapse))
    grid, want = _exact(values, 200, values.std(ddof=1) * len(values) ** -0.2)
    assert x == pytest.approx(grid) and y == pytest.approx(want, rel=1e-9)


def test_narrow_kernels_leave_zeros_between(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (100.0,)], "v double")
    x, y = _curve(density.kde(df, "v", points=101, bandwidth=0.1))
    assert len(y) == 101 and y[50] == 0.0 and y[0] > 0 and y[100] > 0


def test_nrd0_against_direct_sum(spark):
    values = np.random.default_rng(2).integers(1, 200, 500).astype(float)
    df = spark.createDataFrame([(int(v),) for v in values], "v int")
    q1, q3 = np.percentile(values, [25, 75])
    h = 0.9 * min(values.std(ddof=1), (q3 - q1) / 1.34) * 500**-0.2
    x, y = _curve(density.kde(df, "v", points=64, bandwidth="nrd0"))
    grid, want = _exact(values, 64, h)
    assert x == pytest.approx(grid) and y == pytest.approx(want, rel=1e-9)


def test_by_class(spark):
    draw = np.random.default_rng(3)
    rows = [("a", float(v)) for v in draw.normal(0, 1, 100)] + [("b", float(v)) for v in draw.normal(5, 2, 50)]
    out = density.kde(spark.createDataFrame(rows, "c string, v double"), "v", by="c", points=50)
    for c in "ab":
        values = np.array([v for k, v in rows if k == c])
        _, y = _curve(out.filter(F.col("c") == c))
        assert y == pytest.approx(_exact(values, 50, values.std(ddof=1) * len(values) ** -0.2)[1], rel=1e-9)


def test_mesh_equals_arange(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.31, 2.0)], "x double, y double")
    mesh = density.mesh_grid(df, "x", "y", h=0.25, pad=1)
    xs, ys = np.arange(-1, 1.31, 0.25), np.arange(0, 3, 0.25)
    got = {(round(r["x"], 9), round(r["y"], 9)) for r in mesh.collect()}
    assert got == {(round(a, 9), round(b, 9)) for a in xs for b in ys}


def test_pair_bins_equal_histograms(spark):
    draw = np.random.default_rng(4)
    a, b = draw.normal(size=400), draw.uniform(size=400)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    rows = density.pair_bins(df, ["a", "b"], 8).collect()
    want, _, _ = np.histogram2d(a, b, bins=8)
    got = np.zeros((8, 8))
    for r in rows:
        if (r["x_col"], r["y_col"]) == ("a", "b"):
            got[r["x_bin"], r["y_bin"]] = r["count"]
    assert (got == want).all()
    assert {(r["x_col"], r["y_col"]) for r in rows} == {("a", "a"), ("a", "b"), ("b", "b")}


def test_constant_column_has_one_bin(spark):
    rows = density.pair_bins(spark.range(5).withColumn("c", F.lit(3.0)), ["c"], 4).collect()
    assert [(r["x_bin"], r["count"]) for r in rows] == [(0, 5)]


def test_play_counts_without_a_quartile_range(spark):
    """Eighty ones and twenty other values: the bandwidth falls back to the standard deviation."""
    values = np.array([1.0] * 80 + [float(v) for v in range(2, 22)])
    x, y = _curve(density.kde(spark.createDataFrame([(v,) for v in values.tolist()], "v double"), "v", points=100, bandwidth="nrd0"))
    _, want = _exact(values, 100, 0.9 * values.std(ddof=1) * len(values) ** -0.2)
    assert y == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("value,width", [(3.0, 3.0), (0.0, 1.0), (-2.0, 2.0)])
def test_constant_column_under_nrd0(spark, value, width):
    df = spark.createDataFrame([(value,)] * 5, "v double")
    x, y = _curve(density.kde(df, "v", points=4, bandwidth="nrd0"))
    assert list(x) == [value] * 4
    assert y == pytest.approx(1 / (0.9 * width * 5**-0.2 * np.sqrt(2 * np.pi)))


def test_undefined_curves_are_null(spark):
    df = spark.createDataFrame([("one", 1.0), ("same", 2.0), ("same", 2.0), ("well", 0.0), ("well", 4.0)], "k string, v double")
    rows = density.kde(df, "v", by="k", points=5).collect()
    assert {r["k"] for r in rows if r["density"] is None} == {"one", "same"} and len(rows) == 15
    assert all(r["density"] > 0 for r in rows if r["k"] == "well")
    assert {r["density"] for r in density.kde(df, "v", points=3, bandwidth=0.0).collect()} == {None}


@pytest.mark.parametrize("h", [0.003, 0.2, 5.0])
def test_transform_is_within_its_error_bound_also_in_the_tails(spark, h):
    """Relative error against the direct sum, where the sum is any number above the smallest ones."""
    draw = np.random.default_rng(8)
    values = np.concatenate([draw.normal(0, 1, 300), draw.normal(9, 0.1, 50), [-30.0, 41.7]])
    _, y = _curve(density.kde(spark.createDataFrame([(v,) for v in values.tolist()], "v double"), "v", points=300, bandwidth=h))
    _, want = _exact(values, 300, h)
    counts = want > 1e-290
    assert counts.sum() > 5 and np.abs(y[counts] / want[counts] - 1).max() < 1e-9
    near = want > 1e-6
    assert np.abs(y[near] / want[near] - 1).max() < 1e-12
    assert (y[~counts] < 1e-280).all() and (y >= 0).all()


def test_rows_sent_to_points_do_not_grow_with_the_values(spark):
    """Ten times the values in the same cells give the same number of moments."""
    sizes = []
    for n in (2_000, 20_000):
        df = spark.range(n).select(((F.col("id") * 7919) % n / n).alias("_v"), F.lit(1.0).alias("_w"), F.lit(0.0).alias("_lo"), F.lit(0.01).alias("_h"))
        sizes.append(density._moments(df, ["_cell", "_lo", "_h"]).count())
    assert sizes == [1600, 1600]


def test_far_tails_stay_positive(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (30.0,)], "v double")
    _, y = _curve(density.kde(df, "v", points=31, bandwidth=1.0))
    assert 0 < y[15] < 1e-40
