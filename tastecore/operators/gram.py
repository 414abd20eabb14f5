"""Sums over pairs of columns, taken tile by tile inside the tasks: correlations and joint histograms of wide tables.

A task multiplies its rows with numpy and hands on one result per tile of columns, whatever its number of rows; tiles are
merged in two levels. No row per pair of columns is made, and nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

TILE = 128  # columns on a side
MERGED_GROUPS = 64
ROWS_AT_ONCE = 65_536
TILE_SCHEMA = "row int, col int, bucket int, n long, row_mean binary, col_mean binary, row_square binary, col_square binary, products binary"
VECTORS = ("row_mean", "col_mean", "row_square", "col_square", "products")

Part = tuple[int, list[np.ndarray]]  # rows; means, centred squares and products


def _merged(a: Part, b: Part) -> Part:
    """Two groups of rows as one, each centred at its own means."""
    n, m = a[0], b[0]
    if not n or not m:
        return b if not n else a
    row, col = b[1][0] - a[1][0], b[1][1] - a[1][1]
    share = n * m / (n + m)
    return n + m, [
        a[1][0] + row * m / (n + m), a[1][1] + col * m / (n + m), a[1][2] + b[1][2] + share * row**2,
        a[1][3] + b[1][3] + share * col**2, a[1][4] + b[1][4] + share * np.outer(row, col),
    ]


def _tiles(batches: Iterator[pa.RecordBatch], width: int, tile: int) -> Iterator[pa.RecordBatch]:
    whole: Part = (0, [])
    for batch in batches:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
        if len(x):
            mean = x.mean(0)
            centred = x - mean
            square = (centred**2).sum(0)
            whole = _merged(whole, (len(x), [mean, mean, square, square, centred.T @ centred]))
    n, parts = whole
    for i in range(0, width if n else 0, tile):
        for j in range(i, width, tile):
            rows, cols = slice(i, i + tile), slice(j, j + tile)
            values = (parts[0][rows], parts[1][cols], parts[2][rows], parts[3][cols], np.ascontiguousarray(parts[4][rows, cols]))
            columns = {"row": pa.array([i], pa.int32()), "col": pa.array([j], pa.int32()), "n": pa.array([n], pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(VECTORS, values)})


def _read(table: pa.Table) -> Part:
    part: Part = (0, [])
    for row in table.to_pylist():
        values = [np.frombuffer(row[k]) for k in VECTORS]
        values[4] = values[4].reshape(len(values[0]), len(values[1]))
        part = _merged(part, (row["n"], values))
    return part


def _summed(table: pa.Table) -> pa.Table:
    n, values = _read(table)
    columns = {k: pa.array([table.column(k)[0].as_py()], pa.int32()) for k in ("row", "col", "bucket")}
    return pa.table(columns | {"n": pa.array([n], pa.int64())} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(VECTORS, values)})


def _correlated(table: pa.Table) -> pa.Table:
    _, (_, _, row_square, col_square, products) = _read(table)
    i, j = table.column("row")[0].as_py(), table.column("col")[0].as_py()
    with np.errstate(divide="ignore", invalid="ignore"):
        found = np.clip(products / np.sqrt(np.outer(row_square, col_square)), -1.0, 1.0)
    rows, cols = (x.ravel() for x in np.indices(found.shape))
    rows, cols, found = rows + i, cols + j, found.ravel()
    if i != j:  # the tile on the other side of the diagonal
        rows, cols, found = np.append(rows, cols), np.append(cols, rows), np.append(found, found)
    found = np.where(rows == cols, 1.0, found)
    return pa.table({"i": pa.array(rows, pa.int32()), "j": pa.array(cols, pa.int32()), "corr": pa.array(found)})


def correlations(df: DataFrame, cols: Sequence[str], tile: int = TILE) -> DataFrame:
    """(i, j, corr) by column places, for all pairs both ways. A null or NaN makes its column's correlations NaN."""
    nan = F.lit(float("nan"))
    rows = df.select(F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in cols]).alias("x"))
    width = len(cols)
    schema = TILE_SCHEMA.replace("bucket int, ", "")
    tiles = rows.mapInArrow(lambda batches: _tiles(batches, width, tile), schema)
    dealt = tiles.select("row", "col", (F.spark_partition_id() % MERGED_GROUPS).alias("bucket"), "n", *VECTORS)
    summed = dealt.groupBy("row", "col", "bucket").applyInArrow(_summed, TILE_SCHEMA)
    return summed.groupBy("row", "col").applyInArrow(_correlated, "i int, j int, corr double")


def pair_counts(cells: DataFrame, cols: Sequence[str], bins: int, by: str | None = None) -> DataFrame:
    """(by, a, b, x_bin, y_bin, n): rows per cell of each pair of columns a <= b, given each column's cell from 0 to bins - 1."""
    width = len(cols)
    fields = StructType([cells.schema[by]] if by else [])
    for name, kind in (("a", "int"), ("b", "int"), ("x_bin", "int"), ("y_bin", "int"), ("n", "long")):
        fields.add(StructField(name, StructType.fromDDL(f"x {kind}")[0].dataType))
    kind = to_arrow_type(cells.schema[by].dataType) if by else None

    def counted(classes: list, keys: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        for number, value in enumerate(classes):
            own = x[keys == number]
            for a in range(width):
                found = [np.bincount(own[:, a] * bins + own[:, b], minlength=bins * bins) for b in range(a, width)]
                b, cell = np.nonzero(np.array(found))
                columns = (np.full(len(b), a), b + a, cell // bins, cell % bins)
                out = {by: pa.array([value] * len(b), kind)} if by else {}
                out |= {name: pa.array(c, pa.int32()) for name, c in zip(("a", "b", "x_bin", "y_bin"), columns)}
                yield pa.RecordBatch.from_pydict(out | {"n": pa.array(np.array(found)[b, cell], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict = {} if by else {None: 0}
        keys, x, held = [], [], 0
        for batch in batches:
            x.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width).astype(np.int64))
            names = batch.column(1).to_pylist() if by else [None] * batch.num_rows
            keys.append(np.array([classes.setdefault(v, len(classes)) for v in names], np.int64))
            held += batch.num_rows
            if held >= ROWS_AT_ONCE:
                yield from counted(list(classes), np.concatenate(keys), np.concatenate(x))
                keys, x, held = [], [], 0
        if held:
            yield from counted(list(classes), np.concatenate(keys), np.concatenate(x))

    rows = cells.select(F.array(*[F.col(c).cast("int") for c in cols]).alias("_cells"), *([by] if by else []))
    keys = [by] if by else []
    counts = rows.mapInArrow(run, fields).groupBy(*keys, "a", "b", "x_bin", "y_bin")
    return counts.agg(F.sum("n").alias("n"))
