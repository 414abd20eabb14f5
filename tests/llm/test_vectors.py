"""M-tree and NN-descent against all distances."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tastecore.llm import mtree, nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int"


def odd_rows(n, dims, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.3, rng.gauss(0, 0.3)]) for _ in range(dims)], 0) for i in range(n)]
    rows += [(n + i, list(rows[3][1]), 0) for i in range(20)]  # copies
    rows += [(None, rows[0][1], 0), (900, None, 0), (901, [None] * dims, 0), (902, [math.nan] * dims, 0), (903, [math.inf] * dims, 0)]
    rows += [(904, [0.0] * dims, 0), (905, [1.0], 0), (906, [], 0)]
    return rows


def usable(rows, dims, zero):
    return {i: np.array(v, np.float32).astype(float) for i, v, _ in rows
            if i is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))}


@pytest.mark.parametrize("dims,k", [(4, 5), (16, 3)])
def test_mtree_equals_all_products(spark, monkeypatch, dims, k):
    monkeypatch.setattr(mtree, "LEAF_ROWS", 20)
    monkeypatch.setattr(mtree, "PAGE_ROWS", 16)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 8)
    rows = odd_rows(300, dims, dims)
    table = spark.createDataFrame(rows, SCHEMA)
    found = mtree.top_products(table, table.filter("vec_id % 10 = 0"), k).collect()
    vectors = {i: np.floor(256 * v).astype(int) for i, v in usable(rows, dims, True).items()}
    want = set()
    for q, v in vectors.items():
        if q % 10 == 0:
            best = sorted((-int(v @ x), i) for i, x in vectors.items() if i != q)[:k]
            want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_products_beyond_doubles():
    a = np.array([[2**40, 3], [2**62, 2**62]])
    assert mtree.products(a, a).tolist() == [[2**63 - 1, 2**63 - 1], [2**63 - 1, 2**63 - 1]]
    b = np.array([[2**31 + 1, 7]])
    assert mtree.products(b, b).tolist() == [[(2**31 + 1) ** 2 + 49]]


def test_empty_and_single(spark):
    for rows in ([], [(0, [1.0, 2.0], 0)], [(0, None, 0)]):
        table = spark.createDataFrame(rows, SCHEMA)
        assert mtree.top_products(table, table, 5).collect() == []
        assert nn_descent.nearest_rows(table, table, 5).collect() == []


def nearest(vectors, q, k):
    return sorted((math.sqrt(float(((vectors[q] - x) ** 2).sum())), i) for i, x in vectors.items() if i != q)[:k]


def test_nn_descent_recall(spark):
    rows = odd_rows(1500, 12, 7)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = nn_descent.nearest_rows(table, table.filter("vec_id % 25 = 0"), 10).collect()
    vectors = usable(rows, 12, False)
    queries = [i for i in vectors if i % 25 == 0]
    hits = 0
    for q in queries:
        own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        assert all(abs(s - math.sqrt(((vectors[q] - vectors[i]) ** 2).sum())) < 1e-12 for _, i, s in own)
        hits += len({i for _, i in nearest(vectors, q, 10)} & {i for _, i, _ in own})
    assert hits >= 0.9 * 10 * len(queries)


@pytest.mark.parametrize("schema", [SCHEMA, SCHEMA.replace("float", "double")])
def test_nn_descent_recall_with_an_outlier_and_near_copies(spark, schema):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.3, (1500, 12))
    vectors[200:1200] = vectors[200] + rng.normal(0, 1e-5, (1000, 12))
    vectors[1499, 0] = 1e6
    vectors = vectors.astype(np.float32).astype(float) if schema == SCHEMA else vectors
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], schema).repartition(5)
    found = nn_descent.nearest_rows(table, table.filter("vec_id % 25 = 0"), 10).collect()
    by_id = dict(enumerate(vectors))
    for queries in (range(0, 200, 25), range(200, 1200, 25), range(1200, 1500, 25)):
        hits = [i in {r.vec_id for r in found if r.query_id == q} for q in queries for _, i in nearest(by_id, q, 10)]
        assert sum(hits) >= 0.95 * len(hits)


def test_rounds_go_on_until_the_graph_settles(spark, monkeypatch):
    """Starting blocks that compare a node with 62 of 4,000 others: rounds have to find the rest."""
    monkeypatch.setattr(nn_descent, "BLOCK", 32)
    monkeypatch.setattr(nn_descent, "STARTS", 2)
    staged, graphs = nn_descent.stage, []

    def counted(df, label="stage", *rest):
        out = staged(df, label, *rest)
        if label == "graph":
            graphs.append((out.count(), out.filter("not known").count()))
        return out

    monkeypatch.setattr(nn_descent, "stage", counted)
    vectors = np.random.default_rng(5).normal(0, 0.3, (4000, 12))
    codes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(vectors)], "node long, code binary").repartition(4)
    found = nn_descent.build_graph(codes, 4000, "f8").filter("node % 50 = 0").collect()
    assert len(graphs) > 3 and graphs[-1][1] <= nn_descent.SETTLED * graphs[-1][0] < graphs[-2][1]
    by_id = dict(enumerate(vectors))
    hits = [i in {r.other for r in found if r.node == q} for q in range(0, 4000, 50) for _, i in nearest(by_id, q, 10)]
    assert sum(hits) >= 0.9 * len(hits)


@pytest.fixture()
def many_partitions(spark):
    held = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for key, value in held.items():
        spark.conf.set(key, value)


def test_blocks_stay_long_over_many_partitions(spark, monkeypatch, many_partitions):
    """2,048 nodes in 64 partitions: dealt start by start, blocks would hold 32 of them, and together some 250."""
    staged, graphs = nn_descent.stage, []

    def first(df, label="stage", *rest):
        graphs.append((df, staged(df, label, *rest)))
        raise InterruptedError

    monkeypatch.setattr(nn_descent, "stage", first)
    vectors = np.random.default_rng(5).normal(0, 0.3, (2048, 12))
    codes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(vectors)], "node long, code binary").repartition(4)
    with pytest.raises(InterruptedError):
        nn_descent.build_graph(codes, 2048, "f8")
    by_id = dict(enumerate(vectors))
    found = graphs[0][1].filter("node % 16 = 0").collect()
    hits = [i in {r.other for r in found if r.node == q} for q in range(0, 2048, 16) for _, i in nearest(by_id, q, 10)]
    assert sum(hits) >= 0.7 * len(hits)


def test_around_counts_a_repeated_node_once():
    code = [np.array([x, 0.0]).tobytes() for x in (1.0, 2.0, 4.0)]
    rows = [(7, 1, code[0]), (7, 2, code[1]), (7, 1, code[0]), (8, 3, code[2]), (8, 2, code[1])]
    batch = pa.RecordBatch.from_pydict({"center": [r[0] for r in rows], "node": [r[1] for r in rows], "code": [r[2] for r in rows], "farthest": [math.inf] * 5})
    found = [tuple(r.values()) for b in nn_descent._around(iter([batch.slice(0, 2), batch.slice(2)]), "f8") for r in b.to_pylist()]
    assert sorted(found) == [(1, 2, 1.0), (2, 1, 1.0), (2, 3, 4.0), (3, 2, 4.0)]


def test_a_repeated_id_is_one_row_with_its_smallest_vector(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(1, 30)] + [(5, [-40.0, 1.0], 0), (1, [1.0, 1.0], 0)]
    for parts in (1, 7):
        table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        found = nn_descent.nearest_rows(table, table.filter("vec_id = 5"), 2).orderBy("rank").collect()
        assert [(r.vec_id, r.score) for r in found] == [(1, 41.0), (2, 42.0)]


def test_nn_descent_returns_all_of_few(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(7)] + [(7, [3.0, 1.0], 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = nn_descent.nearest_rows(table, table.filter("vec_id in (0, 3)"), 10).collect()
    vectors = usable(rows, 2, False)
    want = {(q, n, i, s) for q in (0, 3) for n, (s, i) in enumerate(nearest(vectors, q, 10), 1)}
    assert {tuple(r) for r in found} == want
