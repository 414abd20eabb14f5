"""Hard negatives against all products."""

import math
import random

import numpy as np
import pytest

from tastecore.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def odd_rows(n, dims, seed):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        label = rng.randrange(4)
        rows.append((i, [c + rng.choice([0.0, 0.1, rng.gauss(0, 0.2)]) for c in centers[label]], rng.choice([label, label, rng.randrange(4)])))
    rows += [(n + i, list(rows[3][1]), i % 2) for i in range(60)]  # copies under two labels
    rows += [(None, rows[0][1], 0), (5000, None, 0), (5010, [None] * dims, 0), (5020, [math.nan] * dims, 0), (5030, rows[0][1], None)]
    rows += [(5040, [0.0] * dims, 1), (5050, [1.0], 0), (5060, [], 0), (5070, rows[1][1], 77), rows[10], rows[10]]
    rows += [(10, rows[20][1], 3)]  # another row of an anchor's id
    return rows


def expected(rows, dims, every, positives=5, negatives=10):
    good = [(i, int(y), np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, y in rows
            if i is not None and y is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor in sorted({i for i, _, _ in good if i % every == 0}):
        label, vector = min((y, v.tolist()) for i, y, v in good if i == anchor)
        scored = [(-int(np.array(vector) @ v), i, y) for i, y, v in good if i != anchor]
        for p, positive, y in sorted(s for s in scored if s[2] == label)[:positives]:
            own = sorted((s, i) for s, i, y in scored if y != label and 30 * -p <= 100 * -s <= 90 * -p)[:negatives]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(own, 1)]
    return sorted(out)


@pytest.mark.parametrize("dims,n", [(20, 400), (3, 200), (1, 60)])
def test_equals_all_products(spark, dims, n):
    rows = odd_rows(n, dims, dims)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as node", "2 as _label").repartition(6)
    found = hard_negatives.hard_negatives(table, table.filter("vec_id % 10 = 0")).collect()
    assert sorted(tuple(r) for r in found) == expected(rows, dims, 10)


def test_many_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 7)
    monkeypatch.setattr(hard_negatives, "SHARD_PAGES", 1)
    rows = odd_rows(900, 12, 5)
    table = spark.createDataFrame(rows, SCHEMA).repartition(11)
    found = hard_negatives.hard_negatives(table, table.filter("vec_id % 10 = 0")).collect()
    assert sorted(tuple(r) for r in found) == expected(rows, 12, 10)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 0)], [(0, None, 0)], [(0, [1.0], 0), (1, [1.0], 1)], [(0, [1.0], 0), (1, [-1.0], 0), (2, [-0.5], 1)]])
def test_few_rows(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    assert hard_negatives.hard_negatives(table, table).collect() == []


def test_bounds_hold_and_exclude_pairs_of_smooth_vectors():
    """Slow waves of several amplitudes: segments are almost constant, so their summaries decide most pairs."""
    rng = np.random.default_rng(0)
    steps = np.linspace(0, 1, 64)
    waves = [a * np.sin(2 * np.pi * (f * steps + p)) for a, f, p in zip(rng.uniform(0.1, 2, 3000), rng.uniform(0.2, 2, 3000), rng.uniform(0, 1, 3000))]
    vectors = np.floor(256 * np.array(waves)).astype(np.int64)
    products = vectors[:50] @ vectors.T
    for (mean, deviation) in hard_negatives.summaries(vectors):
        middle, reach = mean[:50] @ mean.T, deviation[:50] @ deviation.T
        assert (np.abs(products - middle) <= reach * (1 + 1e-9) + 1e-3).all()
    labels = np.arange(3000) % 10
    counters = hard_negatives.Counters()
    best = hard_negatives.Best(np.full((50, 1), -np.inf), np.full((50, 1), np.inf), 11)
    for start in range(0, 3000, 500):
        part = slice(start, start + 500)
        page = {"nodes": np.arange(3000)[part], "firsts": np.arange(3000)[part], "labels": labels[part], "vectors": vectors[part], "summary": hard_negatives.summaries(vectors[part])}
        hard_negatives.search_page(best, vectors[:50], labels[:50], hard_negatives.summaries(vectors[:50]), page, False, counters)
    cell, score, _, node = best.held
    for a in range(50):
        own = sorted((-int(products[a, i]), i) for i in range(3000) if labels[i] != labels[a])[:11]
        assert [(-int(s), int(i)) for s, i in zip(score[cell == a], node[cell == a])] == own
    assert counters.left[0] >= counters.left[1] >= counters.left[2] == counters.exact
    assert counters.exact < 0.2 * counters.pairs


def test_products_beyond_doubles():
    a = np.array([[2**40, 3], [2**62, 2**62]])
    assert hard_negatives.exact(a, a).tolist() == [2**63 - 1, 2**63 - 1]
