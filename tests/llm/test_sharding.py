"""Rendezvous hashing against its definition in plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tastecore.llm import sharding

ROWS = [(i, f"text {i % 7} é" * (i % 5)) for i in range(600)] + [(None, "x"), (None, None), (3, "again"), (3, "again"), (3, None), (4, "")]
ROWS += [(99, "one key")] * 300


def best(key, weights):
    text = "\0" if key is None else str(key)

    def score(shard):
        number = int(hashlib.md5(f"shard|{shard}|{text}".encode()).hexdigest()[:13], 16)
        return -weights[shard] / math.log((number + 0.5) / 16**13), -shard

    return max(weights, key=score)


def documents(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'a' as shard", "1 as slot", "'k' as law")


@pytest.mark.parametrize("partitions", [1, 7])
def test_documents_equal_the_definition(spark, many_chunks, partitions):
    weights, grown = sharding.equal_shards(5), sharding.equal_shards(6)
    found = sharding.shard_documents(documents(spark).repartition(partitions), weights, grown).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), best(i, weights), best(i, grown)) for i, t in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in found) == want
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32))
    for own in slots.values():
        own.sort()
        assert [s[0] for s in own] == list(range(len(own)))
        assert [s[1:] for s in own] == sorted(s[1:] for s in own)
    assert {r.law for r in found} == {"key"}
    assert all(r.grown_shard in (r.shard, 5) for r in found)


def test_shares_follow_weights_and_few_records_move(spark):
    keys = spark.range(40_000).withColumnRenamed("id", "key")
    weights = {0: 1.0, 1: 2.0, 7: 5.0}
    placed = sharding.with_shards(keys, "key", weights, {**weights, 1: 3.0}).groupBy("shard", "grown_shard").count().collect()
    share = Counter()
    for r in placed:
        share[r["shard"]] += r["count"] / 40_000
        assert r["grown_shard"] in (r["shard"], 1)  # only the shard that grew takes records
    assert all(abs(share[s] - w / 8) < 0.01 for s, w in weights.items())
    moved = sum(r["count"] for r in placed if r["grown_shard"] != r["shard"]) / 40_000
    assert abs(moved - (3 / 9 - 2 / 8)) < 0.01
    without = sharding.with_shards(keys, "key", weights, {0: 1.0, 7: 5.0}).filter("shard <> grown_shard").select("shard").distinct().collect()
    assert [r["shard"] for r in without] == [1]  # only the records of the shard that went


def test_equal_weights_are_even(spark):
    sizes = sharding.with_shards(spark.range(40_000).withColumnRenamed("id", "key"), "key", sharding.equal_shards(40)).groupBy("shard").count().collect()
    assert len(sizes) == 40 and all(abs(r["count"] - 1000) < 150 for r in sizes)


def test_no_rows_and_bad_weights(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(empty, sharding.equal_shards(3)).collect() == []
    one = sharding.shard_documents(spark.createDataFrame([(1, None)], "doc_id long, text string"), {4: 2.0}).collect()
    assert [tuple(r) for r in one] == [(1, 16, 0, "key", 4, 0, None)]
    for weights in ({}, {0: 0.0}, {0: 1.0, 1: -1.0}):
        with pytest.raises(ValueError):
            sharding.shard_of(F.lit(1), weights)


def test_native(spark):
    plan = sharding.shard_documents(documents(spark), sharding.equal_shards(5))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
