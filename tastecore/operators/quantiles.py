"""Exact quantiles that never gather, sort or shuffle the values.

Every round is one aggregate over the column. The first takes a KLL sketch of all values; of it come two
marks around each wanted rank. The next round counts the rows below the lower mark, at it, between
both and at the upper one, and sketches those between, whose marks are some hundred times closer, and so on. A rank is
found when its value is a mark, or when so few rows are left between the marks that their sketch
holds each of them. The counts are exact, so a sketch that errs by more than expected (its rank error is
bounded with high probability only) costs a round, not the answer. Sketches are merged in two levels, so that the
last task reads a fixed number of them whatever the number of input tasks; a few numbers and one
sketch per rank (some 100 kB) reach the driver. A million rows take two rounds, 10^12 take five; from the
third on the scan is filtered by the marks.

Values that a double cannot hold are counted one by one and range sorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastecore.plans.ordering import running_totals

# A sketch of this size errs by about 0.13 % in rank; the marks allow for more than twice that. It holds all of that many values.
SKETCH_SIZE = 4_096
REACH = 0.003
# Sketches that meet in the last task.
MERGED_GROUPS = 64

Ranks = Callable[[int], list[int]]


def _number(df: DataFrame, col: str) -> Column:
    """What is sketched: the value where it is a number, else nothing."""
    if not isinstance(df.schema[col].dataType, T.NumericType):
        return F.lit(None).cast("double")
    value = F.col(col).cast("double")
    return F.when(~F.isnan(value), value)


def _sketched(df: DataFrame, values: Mapping[str, Column], size: int, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: a sketch per name, the numbers of rows where each of `counts` holds, summed in two levels."""
    counts = counts or {}
    group = (F.spark_partition_id() % MERGED_GROUPS).alias("_group")
    first = [F.kll_sketch_agg_double(v, F.lit(size)).alias(n) for n, v in values.items()]
    first += [F.count(F.when(c, 1)).alias(n) for n, c in counts.items()]
    level = df.select(*df.columns, group).groupBy("_group").agg(*first)
    merged = [F.kll_merge_agg_double(n, F.lit(size)).alias(n) for n in values]
    return level.agg(*merged, *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts])


def _read_sketches(spark: SparkSession, asked: Sequence[tuple[bytes, Sequence[float]]]) -> list[list[float]]:
    """The values at the given shares of the rows, per sketch."""
    reads = [F.kll_sketch_get_quantile_double(F.lit(bytearray(s)), F.array(*[F.lit(float(p)) for p in shares])) for s, shares in asked]
    return [list(found) for found in spark.range(1).select(*[r.alias(f"q{i}") for i, r in enumerate(reads)]).head()] if reads else []


@dataclass
class _Wanted:
    """A rank, counted from 1, of a column; it lies between `low` and `high` (exclusive, None: no bound)."""

    col: str
    rank: int
    near: int  # the rank that the marks surround: the same for two ranks in a row
    below: int = 0  # rows up to and including `low`
    low: float | None = None
    high: float | None = None
    marks: tuple[float, float] | None = None
    value: float | None = None

    def inside(self, value: Column) -> Column:
        found = F.lit(True)
        if self.low is not None:
            found = found & (value > F.lit(self.low))
        if self.high is not None:
            found = found & (value < F.lit(self.high))
        return found

    def place(self) -> tuple:
        return self.col, self.low, self.high, self.marks

    def shares(self, n: int) -> list[float]:
        """The rank's place among the n rows inside, between those of the marks."""
        middle = (self.near - self.below - 0.5) / n
        return [min(1.0, max(0.0, middle - REACH)), (self.rank - self.below - 0.5) / n, min(1.0, max(0.0, middle + REACH))]

    def narrow(self, counts: Sequence[int]) -> int:
        """Take counts (below, at, between, at the upper mark) in; returns the rows that were sketched and still hold the rank, or 0."""
        under, at, between, above = counts
        start = self.below + under
        if self.marks is None:
            return between
        low, high = self.marks
        self.marks = None
        if self.rank <= start:
            self.high = low
        elif self.rank <= start + at:
            self.value = low
        elif self.rank <= start + at + between:
            self.below, self.low, self.high = start + at, low, high
            return between
        elif self.rank <= start + at + between + above:
            self.value = high
        else:
            self.below, self.low = start + at + between + above, high
        return 0


def _round(df: DataFrame, open_ranks: Sequence[_Wanted]) -> None:
    """One aggregate for all ranks that are not found yet."""
    number = {w.col: _number(df, w.col) for w in open_ranks}
    places = list(dict.fromkeys(w.place() for w in open_ranks))
    values, counts = {}, {}
    for i, place in enumerate(places):
        wanted = next(w for w in open_ranks if w.place() == place)
        value, inside = number[wanted.col], wanted.inside(number[wanted.col])
        below, at, above = (F.lit(False),) * 3
        between = inside
        if wanted.marks:
            low, high = (F.lit(m) for m in wanted.marks)
            below, at = inside & (value < low), value == low
            between, above = (value > low) & (value < high), (value == high) & (value > low)
        values[f"s{i}"] = F.when(between, value)
        counts |= {f"b{i}": below, f"a{i}": at, f"m{i}": between & value.isNotNull(), f"u{i}": above}
    rows = df.select(*dict.fromkeys(w.col for w in open_ranks))
    if all(w.low is not None or w.high is not None for w in open_ranks):
        rows = rows.filter(reduce(or_, [w.inside(F.col(w.col)) for w in open_ranks]))
    row = _sketched(rows, values, SKETCH_SIZE, counts).head()
    asked = []
    for wanted in open_ranks:
        i = places.index(wanted.place())
        n = wanted.narrow([row[f"{k}{i}"] for k in "bamu"])
        if n:
            asked.append((wanted, n, row[f"s{i}"]))
    _take_marks(df.sparkSession, asked)


def _take_marks(spark: SparkSession, asked: Sequence[tuple[_Wanted, int, bytes]]) -> None:
    found = _read_sketches(spark, [(sketch, wanted.shares(n)) for wanted, n, sketch in asked])
    for (wanted, n, _), (low, middle, high) in zip(asked, found):
        if n <= SKETCH_SIZE:
            wanted.value = middle
        else:
            wanted.marks = (low, high)


def _fits_double(low, high) -> bool:
    """A sketch holds doubles, which are exact up to 2^53."""
    return all(v is None or isinstance(v, float) or (isinstance(v, int) and abs(v) <= 2**53) for v in (low, high))


def _counted(df: DataFrame, col: str) -> DataFrame:
    """(value, rows, seen): seen counts the rows up to and including the value."""
    counts = df.select(F.col(col).alias("value")).filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    return running_totals(counts, ["value"], {"seen": F.col("rows")})


def at_ranks(df: DataFrame, cols: Sequence[str], ranks: Ranks) -> dict[str, dict]:
    """Per column its number of values `n`, `min`, `max`, `mean`, and `at`: the values at ranks(n), counted from 1; empty without values.

    NaN comes after all other numbers. Only these few numbers per column reach the driver.
    """
    numbers = {c: _number(df, c) for c in cols}
    rows = df.select(*cols)
    facts = rows.select("*", F.struct(*[numbers[c].alias(c) for c in cols]).alias("_numbers"))
    group = (F.spark_partition_id() % MERGED_GROUPS).alias("_group")
    first, last = [], []
    for i, c in enumerate(cols):
        number = F.col("_numbers")[c]
        first += [
            F.count(F.col(c)).alias(f"n{i}"), F.count(number).alias(f"k{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}"),
            F.max(number).alias(f"x{i}"), F.sum(F.col(c).cast("double") if isinstance(df.schema[c].dataType, T.NumericType) else F.lit(None).cast("double")).alias(f"t{i}"),
            F.kll_sketch_agg_double(number, F.lit(SKETCH_SIZE)).alias(f"s{i}"),
        ]
        last += [
            *[F.coalesce(F.sum(f"{k}{i}"), F.lit(0)).alias(f"{k}{i}") for k in "nk"], F.min(f"l{i}").alias(f"l{i}"), F.max(f"h{i}").alias(f"h{i}"),
            F.max(f"x{i}").alias(f"x{i}"), F.sum(f"t{i}").alias(f"t{i}"), F.kll_merge_agg_double(f"s{i}", F.lit(SKETCH_SIZE)).alias(f"s{i}"),
        ]
    row = facts.select("*", group).groupBy("_group").agg(*first).agg(*last).head()
    found: dict[str, dict] = {}
    wanted: list[_Wanted] = []
    asked = []
    for i, c in enumerate(cols):
        n, known, low, high = (row[f"{k}{i}"] for k in "nklh")
        places = ranks(n) if n else []
        mean = row[f"t{i}"] / n if n and row[f"t{i}"] is not None else None
        found[c] = {"n": n, "min": low, "max": high, "mean": mean}
        if n and (not _fits_double(low, high) or not isinstance(df.schema[c].dataType, T.NumericType)):
            seen = _counted(rows, c)
            found[c]["at"] = list(seen.agg(*[F.min(F.when(F.col("seen") >= F.lit(r), F.col("value"))).alias(f"r{j}") for j, r in enumerate(places)]).head())
            continue
        mine = [_Wanted(c, r, r - 1 if r - 1 in places else r) for r in places]
        for w in mine:
            if w.rank > known:
                w.value = float("nan")
            elif w.rank == 1 or w.rank == known:
                w.value = low if w.rank == 1 else row[f"x{i}"]
            else:
                asked.append((w, known, row[f"s{i}"]))
        wanted += mine
        found[c]["at"] = mine
    _take_marks(df.sparkSession, asked)
    while open_ranks := [w for w in wanted if w.value is None]:
        _round(rows, open_ranks)
    for fact in found.values():
        fact["at"] = [w.value if isinstance(w, _Wanted) else w for w in fact["at"]]
    return found


def _discrete(probs: Sequence[float]) -> Ranks:
    return lambda n: [min(n, max(1, math.ceil(p * n))) for p in probs]


def quantiles(
    df: DataFrame, col: str, probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), error: float = 0.0
) -> DataFrame:
    """Discrete quantiles as rows (prob, value).

    With error 0 they are exact values of the column; otherwise a sketch of a
    numeric column answers in a single pass, within that relative rank error
    with a probability of 99 %.
    """
    probs = [float(p) for p in probs]
    kind = df.schema[col].dataType
    if error > 0:
        size = min(65_535, max(8, round((2.296 / error) ** (1 / 0.9021))))
        sketch = _sketched(df.select(col), {"sketch": _number(df, col)}, size)
        marks = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in probs])))
        pairs = sketch.select(F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), marks.alias("value"))).alias("q"))
        return pairs.select("q.prob", F.col("q.value").cast(kind).alias("value"))
    at = at_ranks(df, [col], _discrete(probs))[col]["at"] or [None] * len(probs)
    return df.sparkSession.range(1).select(F.inline(F.array(*[F.struct(F.lit(p).alias("prob"), F.lit(v).cast(kind).alias("value")) for p, v in zip(probs, at)])))


def quantile_value(df: DataFrame, col: str, q: float) -> Column:
    """One exact discrete quantile as a literal; null without values."""
    return quantile_values([(df, col)], q)[0]


def quantile_values(columns: Sequence[tuple[DataFrame, str]], q: float) -> list[Column]:
    """The q-quantiles of columns of different tables as literals, all found in the same rounds."""
    names = [f"_c{i}" for i in range(len(columns))]
    kinds = [df.schema[col].dataType for df, col in columns]
    parts = [
        df.select(*[(F.col(col) if i == j else F.lit(None).cast(kind)).alias(name) for j, (name, kind) in enumerate(zip(names, kinds))])
        for i, (df, col) in enumerate(columns)
    ]
    found = at_ranks(reduce(DataFrame.unionAll, parts), names, _discrete([q]))
    return [F.lit(found[name]["at"][0] if found[name]["at"] else None).cast(kind) for name, kind in zip(names, kinds)]


QUARTILES = (0.25, 0.5, 0.75)
SUMMARY = "column string, min double, q1 double, median double, mean double, q3 double, max double"


def _quartile_ranks(n: int) -> list[int]:
    places = [p * (n - 1) for p in QUARTILES]
    return [side(place) + 1 for place in places for side in (math.floor, math.ceil)]


def _quartiles(df: DataFrame, cols: Sequence[str]) -> list[dict]:
    """min, mean, max and the interpolated quartiles q1, median, q3 per column; null for a column without values."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    rows = []
    for c, fact in at_ranks(numbers, cols, _quartile_ranks).items():
        row = {"column": c, "min": fact["min"], "mean": fact["mean"], "max": fact["max"], "q1": None, "median": None, "q3": None}
        for i, name in enumerate(("q1", "median", "q3")):
            if fact["at"]:
                low, high = fact["at"][2 * i : 2 * i + 2]
                place = QUARTILES[i] * (fact["n"] - 1)
                row[name] = low if low == high else low + (high - low) * (place - math.floor(place))
        rows.append(row)
    return rows


def summary_quartiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """min, Q1, median, mean, Q3, max per column; quartiles are interpolated."""
    names = ["column", "min", "q1", "median", "mean", "q3", "max"]
    return df.sparkSession.createDataFrame([tuple(row[n] for n in names) for row in _quartiles(df, cols)], SUMMARY)


def interquartile_range(df: DataFrame, col: str) -> Column:
    """Interpolated Q3 - Q1 as a literal; null without values."""
    row = _quartiles(df, [col])[0]
    return F.lit(None if row["q1"] is None else row["q3"] - row["q1"]).cast("double")
