"""Running totals and ranks against brute force, with the sort in several chunks."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tastecore.plans.ordering import CHUNK, _sorted_chunks, number_rows, rank_within, running_totals
from tastecore.plans.staging import scratch_path, shared_folder, stage


def _rows(n=3000, seed=3):
    """A third of the rows belongs to one group, some groups have one row, one key is null."""
    draw = random.Random(seed)
    groups = [None] + [f"g{i}" for i in range(200)]
    return [
        ("hot" if i % 3 == 0 else draw.choice(groups), draw.randrange(50), i, draw.randrange(10))
        for i in range(n)
    ]


@pytest.fixture()
def frame(spark, many_chunks):
    return spark.createDataFrame(_rows(), "g string, v int, id int, w int").repartition(6)


def test_hot_group_spans_chunks(frame):
    chunks = _sorted_chunks(frame, ["g", "v", "id"]).filter("g = 'hot'").select(CHUNK).distinct().count()
    assert chunks > 1


def test_number_rows(frame):
    got = {r["id"]: r["n"] for r in number_rows(frame, [F.desc("v"), "id"], "n").collect()}
    want = {row[2]: i for i, row in enumerate(sorted(_rows(), key=lambda r: (-r[1], r[2])))}
    assert got == want


def test_running_totals_over_all_rows(frame):
    got = {r["id"]: r["t"] for r in running_totals(frame, ["v", "id"], {"t": F.col("w")}).collect()}
    total, want = 0, {}
    for row in sorted(_rows(), key=lambda r: (r[1], r[2])):
        total += row[3]
        want[row[2]] = total
    assert got == want


def test_running_totals_by_group_with_null_group(frame):
    out = running_totals(frame, [F.desc("v"), "id"], {"t": F.col("w"), "n": F.lit(1)}, by=["g"])
    got = {r["id"]: (r["t"], r["n"]) for r in out.collect()}
    state, want = {}, {}
    for g, v, i, w in sorted(_rows(), key=lambda r: (-r[1], r[2])):
        t, n = state.get(g, (0, 0))
        state[g] = want[i] = (t + w, n + 1)
    assert got == want


def test_rank_within_equals_window(frame):
    ranked = rank_within(frame, ["g"], [F.desc("v"), "id"])
    rows = ranked.groupBy("g").agg(F.min("position"), F.max("position"), F.count("*"), F.countDistinct("position"))
    for _, low, high, n, distinct in rows.collect():
        assert (low, high, distinct) == (1, n, n)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g string, v int")
    assert running_totals(empty, ["v"], {"t": F.col("v")}, ["g"]).count() == 0
    assert number_rows(empty, ["v"], "n").count() == 0


class _Session:
    """The few session attributes that the choice of a folder depends on."""

    def __init__(self, setting, checkpoint_dir, master):
        self.conf = SimpleNamespace(get=lambda key, default: setting)
        self.sparkContext = SimpleNamespace(
            master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoint_dir
        )


def test_shared_folder_prefers_the_setting():
    session = _Session("hdfs:///shared/", "hdfs:///other", "yarn")
    assert shared_folder(session) == "hdfs:///shared/"
    assert scratch_path(session, "x").startswith("hdfs:///shared/tastecore-app-1/x-")
    assert shared_folder(_Session(None, "hdfs:///other", "yarn")) == "hdfs:///other"


def test_no_temporary_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(None, None, "yarn"))


def test_stage_reads_back(spark):
    df = stage(spark.range(5).withColumn("n", F.lit(None).cast("int")))
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 3, 4]
    assert "tastecore-" + spark.sparkContext.applicationId in df.inputFiles()[0]
