"""Density curves, histogram pairs and evaluation grids."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.operators.gram import pair_counts
from tastecore.operators.quantiles import interquartile_range
from tastecore.plans.staging import stage

# exp(-z * z / 2) is 0.0 in a double from 38.61 bandwidths on: nothing that counts is left out.
REACH = 38.7
# Cells of 1/16 of a bandwidth: a value lies within 1/32 of its cell's centre, so the series of exp(z * d) is taken
# at |z * d| < 1.22, where 16 terms err by less than 1e-10 of the sum; within 8 bandwidths, by less than rounding.
CELLS = 16
TERMS = 16


def _bounds(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    x = F.col(col).cast("double")
    return df.filter(x.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.stddev_samp(x).alias("_sd"),
        F.min(x).alias("_lo"),
        F.max(x).alias("_hi"),
    )


def _grid(bounds: DataFrame, by: Sequence[str], points: int) -> DataFrame:
    step = (F.col("_hi") - F.col("_lo")) / F.lit(points - 1)
    places = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    return places.select(*by, "i", (F.col("_lo") + F.col("i") * step).alias("x"))


def class_grid(df: DataFrame, col: str, points: int, by: str | None = None) -> DataFrame:
    """`points` even steps from min to max, per class if `by` is given."""
    keys = [by] if by else []
    return _grid(_bounds(df, col, keys), keys, points)


def _centre():
    return F.col("_lo") + (F.col("_cell") + F.lit(0.5)) * (F.col("_h") / F.lit(CELLS))


def _moments(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per cell the sums of w * exp(-d^2 / 2) * d^k / k!, as _m0 to the last term."""
    placed = values.withColumn("_cell", F.floor((F.col("_v") - F.col("_lo")) / (F.col("_h") / F.lit(CELLS))))
    placed = placed.withColumn("_d1", (F.col("_v") - _centre()) / F.col("_h"))
    placed = placed.withColumn("_t", F.col("_w") * F.exp(-0.5 * F.col("_d1") * F.col("_d1")))
    bits = [1 << b for b in range((TERMS - 1).bit_length())]
    for low, high in zip(bits, bits[1:]):
        placed = placed.withColumn(f"_d{high}", F.col(f"_d{low}") * F.col(f"_d{low}"))

    def term(k: int):
        return reduce(lambda a, b: a * b, [F.col(f"_d{b}") for b in bits if k & b], F.col("_t"))

    return placed.groupBy(*keys).agg(*[(F.sum(term(k)) / F.lit(float(math.factorial(k)))).alias(f"_m{k}") for k in range(TERMS)])


def kde(
    df: DataFrame,
    col: str,
    by: str | None = None,
    points: int = 1000,
    bandwidth: str | float = "scott",
    collapse: bool = True,
) -> DataFrame:
    """Gaussian kernel density at even points from min to max: (by, i, x, density).

    A fast Gauss transform: values are summed to the moments of cells 1/16 of a bandwidth wide, and only a
    cell's moments are sent to the grid points which its kernels reach. With d the distance of a value to the cell's
    centre and z that of the point, in bandwidths, exp(-(z - d)^2 / 2) = exp(-z^2 / 2) * sum of z^k * (d^k / k!) * exp(-d^2 / 2).
    The cost is a constant per value plus a constant per point, whatever the bandwidth. `collapse` first merges
    equal values to one weighted value.

    Where the bandwidth is 0 or undefined (a class with one row or one value under
    "scott") there is no curve, and its densities are null.
    """
    keys = [by] if by else []
    bounds = _bounds(df, col, keys)
    n, sd = F.col("_n").cast("double"), F.col("_sd")
    if bandwidth == "scott":
        width = sd * F.pow(n, F.lit(-0.2))
    elif bandwidth == "nrd0" and by is None:
        spread = F.least(sd, interquartile_range(df, col) / 1.34)
        for instead in (sd, F.abs("_lo"), F.lit(1.0)):  # without a spread, as R does
            spread = F.when(spread > 0, spread).otherwise(instead)
        width = 0.9 * spread * F.pow(n, F.lit(-0.2))
    elif bandwidth == "nrd0":
        raise ValueError("nrd0 needs quartiles, which are per column: filter to one class first")
    else:
        width = F.lit(float(bandwidth))
    # One row per class: staged, so its real size decides how it is joined.
    bounds = stage(bounds.withColumn("_h", width), "bounds")

    values = df.select(*keys, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if collapse:
        values = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).cast("double").alias("_w"))
    else:
        values = values.withColumn("_w", F.lit(1.0))
    if by:
        spread = values.join(bounds, by)
    else:
        spread = values.select("*", bounds.select(F.struct("*")).scalar().alias("_b")).select("_v", "_w", "_b.*")
    lo, h = F.col("_lo"), F.col("_h")
    cells = _moments(spread.filter(h > 0), [*keys, "_cell", "_n", "_lo", "_hi", "_h"])
    step = (F.col("_hi") - lo) / F.lit(points - 1)
    reach = F.lit(REACH + 0.5 / CELLS) * h
    # With a single value all points are the same, and all are reached.
    first = F.when(step > 0, F.greatest(F.lit(0.0), F.ceil((_centre() - reach - lo) / step))).otherwise(0).cast("int")
    last = F.when(step > 0, F.least(F.lit(points - 1.0), F.floor((_centre() + reach - lo) / step))).otherwise(points - 1).cast("int")
    reached = (
        cells.withColumn("_first", first)
        .withColumn("_last", last)
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("i", F.explode(F.sequence("_first", "_last")))
        .withColumn("_z", (lo + F.col("i") * step - _centre()) / h)
    )
    z = F.col("_z")
    series = reduce(lambda found, k: found * z + F.col(f"_m{k}"), reversed(range(TERMS - 1)), F.col(f"_m{TERMS - 1}"))
    # Rounding may leave nothing of a far tail, but no less.
    term = F.greatest(F.lit(0.0), series) * F.exp(-0.5 * z * z) / (F.col("_n") * h * F.lit(math.sqrt(2 * math.pi)))
    sums = reached.groupBy(*keys, "i").agg(F.sum(term).alias("density"))
    curve = _grid(bounds, [*keys, "_h"], points).join(sums, [*keys, "i"], "left")
    density = F.when(F.col("_h") > 0, F.coalesce("density", F.lit(0.0))).alias("density")
    return curve.select(*keys, "i", "x", density)


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int, by: str | None = None) -> DataFrame:
    """Counts behind a scatter matrix: one row per column pair and occupied cell.

    A pair of a column with itself is its histogram. Tasks count the cells of all pairs in dense
    arrays, so what is shuffled depends on the cells, not on rows times pairs.
    """
    cols, keys = list(cols), [by] if by else []
    ends = df.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in cols],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols],
        )
    ).scalar()

    def cell(c: str):
        lo, hi = ends.getField(f"lo_{c}"), ends.getField(f"hi_{c}")
        place = F.floor((F.col(c) - lo) / ((hi - lo) / F.lit(bins)))
        return F.when(hi > lo, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")

    cells = df.select(*keys, *[cell(c).alias(f"_cell{i}") for i, c in enumerate(cols)])
    counts = pair_counts(cells, [f"_cell{i}" for i in range(len(cols))], bins, by)
    names = F.array(*[F.lit(c) for c in cols])
    return counts.select(*keys, F.get(names, F.col("a")).alias("x_col"), F.get(names, F.col("b")).alias("y_col"), "x_bin", "y_bin", F.col("n").alias("count"))


def mesh_grid(df: DataFrame, x: str, y: str, h: float = 0.02, pad: float = 1.0) -> DataFrame:
    """Regular grid over the padded range of two columns, upper end left out.

    The first axis is spread over tasks before the second one is added.
    """

    def axis(c: str):
        lo = F.min(c).cast("double") - F.lit(float(pad))
        hi = F.max(c).cast("double") + F.lit(float(pad))
        return lo, F.ceil((hi - lo) / F.lit(float(h)))

    (x_lo, x_n), (y_lo, y_n) = axis(x), axis(y)
    ends = df.agg(x_lo.alias("x_lo"), x_n.alias("x_n"), y_lo.alias("y_lo"), y_n.alias("y_n"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    columns = ends.select("*", F.explode(F.sequence(zero, F.col("x_n") - one)).alias("i")).repartition("i")
    points = columns.select("*", F.explode(F.sequence(zero, F.col("y_n") - one)).alias("j"))
    return points.select(
        (F.col("x_lo") + F.col("i") * F.lit(float(h))).alias(x),
        (F.col("y_lo") + F.col("j") * F.lit(float(h))).alias(y),
    )
