"""Shared helpers: Arrow batches in slices of bounded size, and code that executors can import."""

from __future__ import annotations

import ctypes
import io
import os
import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROWS_AT_ONCE = 256
BATCH_ROWS, BATCH_SETTING = 4 * ROWS_AT_ONCE, "spark.sql.execution.arrow.maxRecordsPerBatch"
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None  # glibc has it
_shipped: weakref.WeakSet = weakref.WeakSet()


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow, for functions of this package."""
    ship_package(df)
    return df.mapInArrow(lambda batches: _then_give_back(function(batches)), schema)


def small_batches(df: DataFrame) -> None:
    """Rows with whole texts go to Python some thousand at a time, unless the session itself says how many.

    The JVM and the worker each hold a batch, and the JVM's buffers for it double as it grows. Spark reads the setting when a
    query runs, so it stays set.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))


def give_back() -> None:
    """Return freed memory to the system: an idle worker lives on for a minute, beside what runs then."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _then_give_back(results: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from results
    give_back()


def given_back(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`function` for applyInArrow; what it held besides its result is given back after each group."""

    def run(group: pa.Table) -> pa.Table:
        result = function(group)
        give_back()
        return result

    return run


def ship_package(df: DataFrame) -> None:
    """Give the executors this package, as --py-files would; the file itself is only read by the driver."""
    context = df.sparkSession.sparkContext
    if context in _shipped:
        return
    root = Path(__file__).parents[1]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    handle, path = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
    with os.fdopen(handle, "wb") as file:
        file.write(buffer.getvalue())
    context.addPyFile(path)
    _shipped.add(context)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Small slices, so that what a function builds for a slice stays small for any batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_slices(
    df: DataFrame,
    columns: Sequence[str],
    function: Callable[..., dict[str, object]],
    schema: str,
) -> DataFrame:
    """Apply `function(list, list, ...) -> {column: values}` to slices of the named columns."""
    df = df.select(*columns)
    types = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = function(*[c.to_pylist() for c in part.columns])
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in types], schema=types)

    return map_arrow(df, run, schema)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))


def text_of(docs: DataFrame) -> DataFrame:
    """doc_id and text only: other columns, whatever their names, take no part."""
    small_batches(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
