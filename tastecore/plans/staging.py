"""Intermediate tables in the folder all executors share.

A staged table cuts the lineage, survives the loss of executors, and carries
its real size, so Catalyst itself decides on a broadcast from the file size.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_own_folders: weakref.WeakKeyDictionary[SparkContext, str] = weakref.WeakKeyDictionary()
_open_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, or the checkpoint folder set by hand.

    Only a local session without either gets a temporary folder, for staged tables alone.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context not in _own_folders:
        _own_folders[context] = tempfile.mkdtemp(prefix="tastecore-")
    return _own_folders[context]


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables staged inside. Write or collect results before that."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nothing has written to yet, in the shared folder, under the application's id."""
    folder = shared_folder(spark).rstrip("/")
    path = f"{folder}/tastecore-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    for scope in _open_scopes:
        scope.append(path)
    return path


def stage(df: DataFrame, label: str = "stage", spread: Sequence[str] = ()) -> DataFrame:
    """Write once, then read back.

    `spread` names near-unique columns to hash the rows by first, which evens
    out the files of a table that is about to be read many times, as in training.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.repartition(*spread) if spread else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
