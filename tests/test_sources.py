import gzip

import pytest
from pyspark.sql import functions as F

from tastecore import sources
from tastecore.sources import inventory


def test_schema_rules(spark):
    rows = [("MSD_TRACKID", "STRING"), ("A_1", "Real"), ("b", "NUMERIC")]
    schema = sources.schema_from_attributes(spark.createDataFrame(rows, "n string, t string").coalesce(1))
    assert schema.simpleString() == "struct<track_id:string,a_1:double,b:double>"
    assert all(f.nullable for f in schema)


@pytest.mark.parametrize("alias", ["msd_trackid", "Track_ID", "instanceName"])
def test_id_aliases(spark, alias):
    frame = spark.createDataFrame([(alias, "string")], "n string, t string")
    assert sources.schema_from_attributes(frame).names == ["track_id"]


def test_unknown_type_is_an_error(spark):
    with pytest.raises(ValueError, match="date"):
        sources.schema_from_attributes(spark.createDataFrame([("c", "date")], "n string, t string"))


def test_read_features_with_gzip_parts(spark, tmp_path):
    name = "set"
    (tmp_path / "audio/attributes").mkdir(parents=True)
    (tmp_path / f"audio/features/{name}.csv").mkdir(parents=True)
    (tmp_path / f"audio/attributes/{name}.attributes.csv").write_text("Method_1,real\nMSD_TRACKID,string\n")
    for part, lines in {"0": "1.5,'TRA'\n", "1": "0.25,'TRB'\n,TRC\n"}.items():
        with gzip.open(tmp_path / f"audio/features/{name}.csv/part-{part}.csv.gz", "wt") as out:
            out.write(lines)
    df = sources.read_features(spark, name, str(tmp_path), partitions=2)
    assert df.dtypes == [("method_1", "double"), ("track_id", "string")]
    assert sorted(map(tuple, df.collect()), key=lambda r: r[1]) == [(1.5, "TRA"), (0.25, "TRB"), (None, "TRC")]


def test_catalog_names(spark):
    names = spark.createDataFrame([(n,) for n in sources.FEATURE_SETS], "name string")
    rows = {r["name"]: r for r in sources.feature_catalog(names, "hdfs:///data/").collect()}
    assert len(rows) == 13
    row = rows["msd-mvd-v1.0"]
    assert row["attr_path"] == "hdfs:///data/audio/attributes/msd-mvd-v1.0.attributes.csv"
    assert row["data_glob"] == "hdfs:///data/audio/features/msd-mvd-v1.0.csv/*"


def test_fixed_width(spark):
    lines = spark.createDataFrame(
        [("ERROR: <SOUMNSI12AB0182807 TRMMGKQ128F9325E10> x",), ("ERROR: <short",)], "value string"
    )
    rows = sources.parse_fixed_width(lines, sources.MISMATCH_FIELDS).collect()
    assert tuple(rows[0]) == ("SOUMNSI12AB0182807", "TRMMGKQ128F9325E10")
    assert tuple(rows[1]) == ("short", "")


def test_tsv_and_header_csv(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("u1\ts1\t3\nu2\ts2\t4\n")
    triplets = sources.read_tsv(spark, str(tmp_path / "t.tsv"), sources.TRIPLET_SCHEMA)
    assert [tuple(r) for r in triplets.orderBy("user_id").collect()] == [("u1", "s1", 3), ("u2", "s2", 4)]
    with gzip.open(tmp_path / "m.csv.gz", "wt") as out:
        out.write('song_id,title\nSO1,"a, b"\nSO2,\n')
    metadata = sources.read_header_csv(spark, str(tmp_path / "m.csv.gz"))
    assert metadata.dtypes == [("song_id", "string"), ("title", "string")]
    assert [tuple(r) for r in metadata.orderBy("song_id").collect()] == [("SO1", "a, b"), ("SO2", None)]


@pytest.mark.parametrize("files", [None, 1])
def test_writers_round_trip(spark, tmp_path, files):
    df = spark.range(100, numPartitions=4).withColumn("name", F.concat(F.lit("n "), F.col("id")))
    path = str(tmp_path / "out")
    sources.write_gzip_csv(df, path, files=files)
    parts = list((tmp_path / "out").glob("part-*.csv.gz"))
    assert len(parts) == (files or 4)
    back = sources.read_parts(spark, path, df.schema, header=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_parquet_refuses_an_existing_path(spark, tmp_path):
    sources.write_parquet(spark.range(1), str(tmp_path / "p"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sources.write_parquet(spark.range(1), str(tmp_path / "p"))


def test_preview_json(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert sources.preview_json(df, ["k"]).head()["json"] == '{"k":1,"v":"a"}'


def test_inventory_usage_and_lines(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "top.txt").write_text("1\n2\n")
    (tmp_path / "a/x.txt").write_text("12345")
    with gzip.open(tmp_path / "a/b/z.txt.gz", "wt") as out:
        out.write("l\n" * 7)
    files = sources.file_inventory(spark, str(tmp_path))
    rows = {r["path"]: (r["directory"], r["depth"], r["length"]) for r in files.collect()}
    assert rows["top.txt"] == ("", 1, 4)
    assert rows["a/x.txt"] == ("a", 2, 5)
    zipped = (tmp_path / "a/b/z.txt.gz").stat().st_size
    assert rows["a/b/z.txt.gz"] == ("a/b", 3, zipped)
    usage = {r["directory"]: r["bytes"] for r in sources.directory_usage(files, 2).collect()}
    assert usage == {"a": 5 + zipped, "a/b": zipped}
    lines = {r["path"].rsplit("/", 1)[-1]: r["lines"] for r in sources.file_line_counts(spark, str(tmp_path)).collect()}
    assert lines == {"top.txt": 2, "x.txt": 1, "z.txt.gz": 7}


def test_empty_and_hidden_files_are_listed(spark, tmp_path):
    (tmp_path / "a/only empty").mkdir(parents=True)
    (tmp_path / "a/only empty/none.txt").touch()
    (tmp_path / "a/none.gz").touch()
    (tmp_path / "a/_SUCCESS").touch()
    (tmp_path / "a/.hidden").write_text("1\n2\n3")
    (tmp_path / "a/.x.txt.crc").write_text("kept by Hadoop")
    (tmp_path / "a/x+y %41.txt").write_text("1\n\n")
    (tmp_path / "no files").mkdir()
    files = sources.file_inventory(spark, str(tmp_path))
    assert {r["path"]: r["length"] for r in files.collect()} == {
        "a/only empty/none.txt": 0, "a/none.gz": 0, "a/_SUCCESS": 0, "a/.hidden": 5, "a/x+y %41.txt": 3,
    }
    usage = {r["directory"]: (r["bytes"], r["files"]) for r in sources.directory_usage(files, 2).collect()}
    assert usage == {"a": (8, 5), "a/only empty": (0, 1)}
    lines = {r["path"]: r["lines"] for r in sources.file_line_counts(spark, str(tmp_path)).collect()}
    assert lines == {
        f"file://{tmp_path}/a/{name}": n
        for name, n in {"only empty/none.txt": 0, "none.gz": 0, "_SUCCESS": 0, ".hidden": 3, "x+y %41.txt": 2}.items()
    }


def test_listing_by_pattern_and_of_missing_and_empty_folders(spark, tmp_path):
    (tmp_path / "one").mkdir()
    for name in ("one/f.txt", "g.txt", "g.csv"):
        (tmp_path / name).write_text("l\n")
    found = sources.file_line_counts(spark, str(tmp_path / "*.txt")).collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["lines"]) for r in found] == [("g.txt", 1)]
    (tmp_path / "two").mkdir()
    assert sources.file_inventory(spark, str(tmp_path / "two")).collect() == []
    with pytest.raises(FileNotFoundError):
        sources.file_inventory(spark, str(tmp_path / "three"))


@pytest.mark.parametrize("at_once", [0, 1, 3])
def test_a_tree_listed_in_many_rounds(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(inventory, "FOLDERS_AT_ONCE", at_once)
    monkeypatch.setattr(inventory, "NAMES_AT_ONCE", 2)
    want = {}
    for i in range(12):
        path = f"{'a/' * (i % 4)}{'b/' * (i % 3)}f{i}"
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("x" * i)
        want[path] = i
    found = sources.file_inventory(spark, str(tmp_path)).collect()
    assert len(found) == 12 and {r["path"]: r["length"] for r in found} == want


def test_lines_of_a_file_in_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inventory, "RANGE", 7)
    monkeypatch.setattr(inventory, "CHUNK", 3)
    texts = {"ends.txt": "abc\n" * 14, "open.txt": "\n" * 7 + "abcdefghij", "one.txt": "x" * 40, "edge.txt": "123456\n1"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    found = {r["path"].rsplit("/", 1)[-1]: r["lines"] for r in sources.file_line_counts(spark, str(tmp_path)).collect()}
    assert found == {name: len(text.splitlines()) for name, text in texts.items()}


def test_inventory_below_a_repeated_root(spark, tmp_path):
    root = tmp_path / "t/a"
    inside = root / str(root).lstrip("/") / "x"
    inside.mkdir(parents=True)
    (inside / "f.txt").write_text("1")
    found = sources.file_inventory(spark, str(root)).collect()
    assert [r["path"] for r in found] == [str(root).lstrip("/") + "/x/f.txt"]


def test_attributes_in_several_files_are_refused(spark, tmp_path):
    path = str(tmp_path) + "/audio/attributes/s.attributes.csv"
    spark.range(4).selectExpr("concat('a', id)", "'real'").repartition(2).write.csv(path)
    with pytest.raises(ValueError, match="one file"):
        sources.read_features(spark, "s", str(tmp_path))


def test_staging_scope_deletes_what_was_staged_inside(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from tastecore.plans.staging import stage, staging_scope

    before = stage(spark.range(3))
    with staging_scope(spark):
        inside = stage(spark.range(5))
        path = Path(urlparse(inside.inputFiles()[0]).path)
        assert path.exists() and inside.count() == 5
    assert not path.parent.exists() and before.count() == 3


def test_labelled(spark):
    df = spark.createDataFrame([(1, 2, "SETOSA")], "a int, b int, c string")
    out = sources.labelled(df, ["b", "a"], "c")
    assert out.dtypes == [("b", "double"), ("a", "double"), ("label", "string")]
    assert tuple(out.head()) == (2.0, 1.0, "Setosa")
