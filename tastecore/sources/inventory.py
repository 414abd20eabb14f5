"""What lies in a folder: every file, bytes per directory, lines per file.

Folders are listed in rounds of one job each: a task lists the folders given to it and goes on below them for a while;
what it has not reached is spread over all tasks of the next round, so that neither files nor folders pass through the driver. Empty files, hidden files and names starting with _ are listed like all others; Spark's own file sources leave
them out. Only the `.name.crc` files, which Hadoop keeps beside local files and never shows, are left out here too.

Tasks reach the files through Arrow's file systems: local and mounted folders, HDFS (with libhdfs on the executors),
S3 (`s3a` is read as `s3`), Google and Azure stores.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastecore.plans.staging import stage

NAMES_AT_ONCE = 10_000
FOLDERS_AT_ONCE = 256  # folders that a task lists below those given to it, before it hands on what is left
RANGE = 128 * 2**20  # bytes of an uncompressed file that one task counts
CHUNK = 4 * 2**20
PACKED = r"\.(gz|bz2|zst|lz4)$"


def _named(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    """(full address, bytes, whether it is a folder) of what a path or a pattern names."""
    wanted = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = wanted.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(wanted)
    places = [(s.getPath().toString(), s.getLen(), s.isDirectory()) for s in found or []]
    if not places:
        raise FileNotFoundError(path)
    return places


def _store(address: str) -> tuple[str, str]:
    """(what Arrow opens the file system with, path inside it)"""
    scheme, _, rest = address.partition(":")
    if scheme == "file":
        return "", "/" + rest.lstrip("/")
    host, _, path = rest.lstrip("/").partition("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    # In a store of buckets, paths start with the bucket.
    return f"{scheme}://{host}", f"/{path}" if scheme in ("hdfs", "viewfs") else f"{host}/{path}"


def _tree(spark: SparkSession, path: str) -> tuple[str, str, DataFrame]:
    """The store's address, the first place in it that `path` names, and all files there and below: (place, length)."""
    named = [(*_store(address), length, folder) for address, length, folder in _named(spark, path)]
    address, tasks = named[0][0], int(spark.conf.get("spark.sql.shuffle.partitions"))
    at_once, names_at_once = FOLDERS_AT_ONCE, NAMES_AT_ONCE

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store = fs.FileSystem.from_uri(address)[0] if address else fs.LocalFileSystem()

        def rows(found: list[tuple[str, int, bool]]) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(found), names_at_once):
                columns = zip(*found[start : start + names_at_once])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()))], names=["place", "length", "folder"])

        for batch in batches:
            waiting, listed = batch.column(0).to_pylist(), 0
            given = len(waiting)
            while waiting and listed < given + at_once:
                # A folder may go while the tree is read.
                found = store.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=True))
                listed += 1
                waiting += [f.path for f in found if f.type == fs.FileType.Directory]
                files = [f for f in found if f.type != fs.FileType.Directory]
                shown = [f for f in files if address or not (f.base_name.startswith(".") and f.base_name.endswith(".crc"))]
                yield from rows([(f.path, f.size or 0, False) for f in shown])
            yield from rows([(place, 0, True) for place in waiting])

    schema = "place string, length long, folder boolean"
    parts = [spark.createDataFrame([row[1:] for row in named], schema)]
    waiting = sum(folder for *_, folder in named)
    while waiting:
        folders = parts[-1].filter("folder").select("place").repartition(min(tasks, waiting), "place")
        parts.append(stage(folders.mapInArrow(entries, schema), "listing"))
        waiting = parts[-1].filter("folder").count()
    return address, named[0][1], reduce(DataFrame.unionAll, parts).filter(~F.col("folder")).select("place", "length")


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every file below the folder `root`: relative path, directory, depth, bytes (0 for empty files)."""
    _, base, files = _tree(spark, root)
    prefix = base.rstrip("/") + "/"
    below = files.select(F.substring("place", len(prefix) + 1, 2**31 - 1).alias("path"), "length")
    parts = F.split("path", "/")
    return below.select(
        "path",
        F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))
        .otherwise("")
        .alias("directory"),
        F.size(parts).alias("depth"),
        "length",
    )


def directory_usage(inventory: DataFrame, depth: int) -> DataFrame:
    """Bytes and files per directory, for the top `depth` levels; directories of empty files have 0 bytes."""
    parts = F.split("directory", "/")
    levels = F.sequence(F.lit(1), F.least(F.size(parts), F.lit(depth)))
    return (
        inventory.filter(F.col("directory") != "")
        .select("length", parts.alias("parts"), F.explode(levels).alias("level"))
        .select("length", "level", F.array_join(F.slice("parts", 1, F.col("level")), "/").alias("directory"))
        .groupBy("directory", "level")
        .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
    )


def file_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per file at or below a path or pattern: (path, lines), 0 for empty files.

    Lines end with a line feed; a last one without it counts. Files named .gz, .bz2, .zst or .lz4 are unpacked, each
    by one task; the others are counted in ranges of 128 MB.
    """
    address, _, files = _tree(spark, path)
    tasks, size, chunk = int(spark.conf.get("spark.sql.shuffle.partitions")), RANGE, CHUNK

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store = fs.FileSystem.from_uri(address)[0] if address else fs.LocalFileSystem()

        def lines(place: str, start: int | None, length: int) -> int:
            """Line ends, and 1 for the rest of the file's last line."""
            if start is None:
                stream, left = store.open_input_stream(place, compression="detect"), float("inf")
            else:
                stream, left = store.open_input_file(place), min(size, length - start)
                stream.seek(start)
            found, last = 0, b"\n"
            with stream:
                while left and (part := stream.read(min(chunk, left))):
                    found, last, left = found + part.count(b"\n"), part[-1:], left - len(part)
            return found + (last != b"\n" and (start is None or start + size >= length))

        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([lines(*r) for r in rows], pa.int64())], names=["place", "lines"]
            )

    zero = F.lit(0).cast("long")
    starts = F.sequence(zero, F.greatest(F.col("length") - 1, zero), F.lit(size).cast("long"))
    packed = F.col("place").rlike(PACKED) & (F.col("length") > 0)
    ranges = files.select("place", F.explode(F.when(packed, F.array(F.lit(None).cast("long"))).otherwise(starts)).alias("start"), "length")
    counts = ranges.repartition(tasks, "place", "start").mapInArrow(counted, "place string, lines long")
    prefix = address.partition(":")[0] + "://" if address and not address.startswith("hdfs") else address or "file://"
    return stage(counts, "lines").groupBy(F.concat(F.lit(prefix), "place").alias("path")).agg(F.sum("lines").alias("lines"))
