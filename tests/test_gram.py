"""Correlations and joint histograms against numpy."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastecore.operators import aggregates, density, gram


@pytest.mark.parametrize("tile", [3, 128])
def test_correlations_equal_numpy(spark, tile):
    draw = np.random.default_rng(1)
    x = draw.normal(0, 1, (200, 10)) @ draw.normal(0, 1, (10, 10)) + 1e6
    x[:, 4] = 7.0
    names = [f"c{i}" for i in range(10)]
    table = spark.createDataFrame(x.tolist(), ", ".join(f"{n} double" for n in names)).repartition(7)
    found = np.full((10, 10), np.inf)
    for r in gram.correlations(table, names, tile).collect():
        assert found[r["i"], r["j"]] == np.inf
        found[r["i"], r["j"]] = r["corr"]
    with np.errstate(invalid="ignore"):
        want = np.corrcoef(x.T)
    want[4, 4] = 1.0
    assert np.allclose(found, want, atol=1e-9, equal_nan=True)


def test_correlations_of_many_columns(spark):
    names = [f"c{i}" for i in range(1441)]
    table = spark.range(40, numPartitions=2).select(*[(F.sin(F.col("id") * (i + 1))).alias(n) for i, n in enumerate(names)])
    found = aggregates.correlation_matrix(table, names)
    assert found.count() == 1441**2
    x = np.sin(np.arange(40)[:, None] * np.arange(1, 1442))
    near = {(r["i"], r["j"]): r["corr"] for r in found.filter("i in ('c3', 'c1440') and j in ('c0', 'c700', 'c3')").collect()}
    for (i, j), corr in near.items():
        assert corr == pytest.approx(np.corrcoef(x[:, int(i[1:])], x[:, int(j[1:])])[0, 1], abs=0.0051)
    assert len(near) == 6


def test_correlations_edge_cases(spark):
    table = spark.createDataFrame([(1.0, 2.0, None), (2.0, 3.0, 1.0), (4.0, 1.0, 5.0)], "a double, b double, c double")
    found = {(r["i"], r["j"]): r["corr"] for r in aggregates.correlation_matrix(table, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == round(float(np.corrcoef([1, 2, 4], [2, 3, 1])[0, 1]), 2) and np.isnan(found["a", "c"])
    assert aggregates.correlation_matrix(table.limit(0), ["a", "b"]).count() == 0


def test_pair_bins_equal_counts(spark, monkeypatch):
    draw = np.random.default_rng(2)
    x = draw.integers(0, 40, (300, 6)).astype(float)
    labels = [[None, "a", "b"][i % 3] for i in range(300)]
    names = [f"c{i}" for i in range(6)]
    rows = [(g, *v) for g, v in zip(labels, x.tolist())]
    table = spark.createDataFrame(rows, "g string, " + ", ".join(f"{n} double" for n in names)).repartition(4)
    found = {tuple(r)[:-1]: r["count"] for r in density.pair_bins(table, names, 5, "g").collect()}
    low, high = x.min(0), x.max(0)
    cells = np.minimum(np.floor((x - low) / ((high - low) / 5)), 4).astype(int)
    want = Counter((g, f"c{a}", f"c{b}", int(c[a]), int(c[b])) for g, c in zip(labels, cells) for a in range(6) for b in range(a, 6))
    assert found == want
    assert density.pair_bins(table.limit(0), names, 5).count() == 0
