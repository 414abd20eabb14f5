"""Grid search for binary logistic regression in which all grid points and folds are fitted in the same passes.

Every model (a pair of penalties, and the fold whose rows it doesn't see, or none) is a column of one matrix of coefficients. A
pass multiplies a task's rows by that matrix and by the residuals, and returns loss and gradient of all open
models; tasks' sums are merged in two levels. The driver keeps a limited-memory quasi-Newton state per model, with orthant
steps where coefficients are penalised by their absolute values. A last pass counts the held-out rows of each
model, so that the whole search takes as many passes as its slowest model, not as many as all of them together.

The objective is that of Spark's own logistic regression: the mean loss, plus penalties on the coefficients times the
standard deviations of the training rows; the intercept is free.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.operators.newton_svm import LinearModel
from tastecore.plans.staging import stage

REMEMBERED = 10  # steps of the quasi-Newton state
MERGED_GROUPS = 64


class LogisticSearchModel(Model):
    """Scores of all points, and the model of the best one fitted on all rows, which transforms."""

    def __init__(self, points: Sequence[dict], fold_metrics: np.ndarray, models: Sequence[LinearModel], passes: int, converged: bool) -> None:
        super().__init__()
        self.points, self.foldMetrics, self.models = list(points), fold_metrics, list(models)
        self.avgMetrics = [float(m) for m in fold_metrics.mean(1)]
        self.best = int(np.argmax(self.avgMetrics))
        self.bestModel, self.passes, self.converged = self.models[self.best], passes, converged

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.bestModel.transform(dataset)


class LogisticSearch(Estimator):
    """Cross validation by weighted F1 over a grid of `regParam` and `elasticNetParam`, folds given by a column.

    Labels are 0 and 1; rows with a null label, fold or vector take no part. A model stops when its gradient has
    shrunk by `tolerance`, or when rounding hides any gain; after `max_passes` those still open stay as they are,
    and the result says so (`converged`), as on separable classes without a penalty.
    """

    def __init__(
        self, grid: Mapping[str, Sequence[float]], features: str = "scfeatures", label: str = "label", fold_col: str = "fold",
        tolerance: float = 1e-7, max_passes: int = 300,
    ) -> None:
        super().__init__()
        if set(grid) - {"regParam", "elasticNetParam"}:
            raise ValueError("the grid names other parameters than regParam and elasticNetParam")
        self.grid, self.features, self.label, self.fold_col = dict(grid), features, label, fold_col
        self.tolerance, self.max_passes = tolerance, max_passes

    def getEstimatorParamMaps(self) -> list[dict]:
        points, base = ParamGridBuilder(), LogisticRegression()
        for name, values in self.grid.items():
            points = points.addGrid(base.getParam(name), list(values))
        return points.build()

    def _fit(self, dataset: DataFrame) -> LogisticSearchModel:
        points = self.getEstimatorParamMaps()
        named = [{p.name: float(v) for p, v in point.items()} for point in points]
        penalties = [(n.get("regParam", 0.0), n.get("elasticNetParam", 0.0)) for n in named]
        # (absolute, square): points that differ in name alone are fitted once.
        pairs = [(reg * mix, reg * (1 - mix)) for reg, mix in penalties]
        distinct = list(dict.fromkeys(pairs))

        rows = _known(dataset, self.features, self.label, self.fold_col)
        facts = _Facts(rows)
        held = [*range(len(facts.folds)), None]
        models = [_Fit(facts, absolute, square, fold, self.tolerance) for absolute, square in distinct for fold in held]
        passes = 1
        while passes < self.max_passes and (open_ := [m for m in models if not m.done]):
            for model, loss, gradient in zip(open_, *_evaluate(rows, facts, open_)):
                model.take(loss, gradient)
            passes += 1
        counts = _held_out(rows, facts, models)
        width = len(held)
        scores = np.array([[_weighted_f1(*counts[d * width + f]) for f in range(width - 1)] for d in range(len(distinct))])
        places = [distinct.index(p) for p in pairs]
        whole = [LinearModel([0.0, 1.0], facts.plain(models[d * width + width - 1].w)[None, :], self.features) for d in range(len(distinct))]
        return LogisticSearchModel(named, scores[places], [whole[p] for p in places], passes + 1, all(m.done for m in models))


def _known(df: DataFrame, features: str, label: str, fold_col: str) -> DataFrame:
    """(label, fold, x), staged: every pass reads it again."""
    named = df.select(F.col(label).cast("double").alias("label"), F.col(fold_col).cast("long").alias("fold"), F.col(features).alias("features"))
    known = named.filter(F.col("label").isNotNull() & F.col("fold").isNotNull() & F.col("features").isNotNull())
    return stage(known.select("label", "fold", vector_to_array("features").alias("x"), "features"), "rows")


class _Facts:
    """Rows, positive rows, means and deviations per fold: one row per fold, from one aggregate."""

    def __init__(self, rows: DataFrame) -> None:
        moments = Summarizer.metrics("mean", "variance").summary(F.col("features"))
        strange = F.count_if(~F.col("label").isin(0.0, 1.0))
        found = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"), strange.alias("strange"), moments.alias("m"))
        found = found.orderBy("fold").collect()
        if not found:
            raise ValueError("no rows to learn from")
        if any(r["strange"] for r in found):
            raise ValueError("labels other than 0 and 1")
        self.folds = [r["fold"] for r in found]
        self.n = np.array([r["n"] for r in found], dtype=float)
        self.ones = np.array([r["ones"] for r in found])
        self.means = np.array([r["m"]["mean"].toArray() for r in found])
        self.squares = np.array([r["m"]["variance"].toArray() * max(0, r["n"] - 1) for r in found])
        self.centre, deviation = self._moments(np.ones(len(found), dtype=bool))
        with np.errstate(divide="ignore"):
            self.scale = np.where(deviation > 0, 1 / deviation, 0.0)

    def _moments(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, means = self.n[chosen, None], self.means[chosen]
        total = n.sum()
        if total < 2:
            return np.zeros(means.shape[1]), np.zeros(means.shape[1])
        mean = (n * means).sum(0) / total
        squares = self.squares[chosen].sum(0) + (n * (means - mean) ** 2).sum(0)
        return mean, np.sqrt(squares / (total - 1))

    def training(self, fold: int | None) -> tuple[float, float, np.ndarray]:
        """Rows, positive rows, and each feature's deviation on the scale of all rows, without one fold."""
        chosen = np.arange(len(self.n)) != (-1 if fold is None else fold)
        return self.n[chosen].sum(), self.ones[chosen].sum(), self._moments(chosen)[1] * self.scale

    def plain(self, w: np.ndarray) -> np.ndarray:
        """Coefficients on the given columns, then the intercept."""
        w_plain = w[:-1] * self.scale
        return np.append(w_plain, w[-1] - self.centre @ w_plain)


class _Fit:
    """One model's state: where it is, what it tries next, and its memory of steps."""

    def __init__(self, facts: _Facts, absolute: float, square: float, fold: int | None, tolerance: float) -> None:
        self.fold, self.tolerance = fold, tolerance
        self.n, ones, spread = facts.training(fold)
        self.absolute = np.append(absolute * spread, 0.0)
        self.square = np.append(square * spread**2, 0.0)
        self.free = np.append(spread > 0, True)  # a constant column has no coefficient
        self.w = np.zeros(len(self.free))
        self.done = not 0 < ones < self.n
        # With one class, or no rows, the prediction is constant.
        self.w[-1] = np.log(ones / (self.n - ones)) if not self.done else np.inf if ones else -np.inf
        self.trial, self.value, self.steps = self.w, None, []

    def _smooth(self, loss: float, gradient: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
        value = loss / self.n + (self.square * w**2).sum() / 2 + (self.absolute * abs(w)).sum()
        return value, np.where(self.free, gradient / self.n + self.square * w, 0.0)

    def _steepest(self) -> np.ndarray:
        """The gradient, or at a kink the one-sided slope nearest to none."""
        up, down, g = self.gradient + self.absolute, self.gradient - self.absolute, self.gradient
        at_kink = np.where(down > 0, down, np.where(up < 0, up, 0.0))
        return np.where(self.absolute == 0, g, np.where(self.w > 0, up, np.where(self.w < 0, down, at_kink)))

    def take(self, loss: float, gradient: np.ndarray) -> None:
        """What the pass found at `trial`."""
        value, slope = self._smooth(loss, gradient, self.trial)
        if self.value is None:
            self.value, self.gradient = value, slope
            self.goal = self.tolerance * max(np.linalg.norm(self._steepest()), 1e-3)
        else:
            moved = self.trial - self.w
            hoped = 1e-4 * (self.slope @ moved)
            settled = abs(hoped) <= 1e-15 * max(1.0, abs(self.value))
            if value > self.value + hoped and not settled:
                self.length /= 2
                self._try()
                return
            if value > self.value:  # no more than rounding is left to gain
                self.done = True
                return
            change = slope - self.gradient
            if moved @ change > 1e-12 * (moved @ moved):
                self.steps = [*self.steps, (moved, change)][-REMEMBERED:]
            self.w, self.value, self.gradient = self.trial, value, slope
        self.slope = self._steepest()
        if np.linalg.norm(self.slope) <= self.goal:
            self.done = True
            return
        self.way, self.length = self._direction(), 1.0
        self._try()

    def _direction(self) -> np.ndarray:
        way, kept = -self.slope, []
        for s, y in reversed(self.steps):
            a = (s @ way) / (s @ y)
            way = way - a * y
            kept.append(a)
        if self.steps:
            s, y = self.steps[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), a in zip(self.steps, reversed(kept)):
            way = way + s * (a - (y @ way) / (s @ y))
        # Only downhill in every penalised coordinate.
        way = np.where((self.absolute > 0) & (way * self.slope >= 0), 0.0, way)
        return way if way @ self.slope < 0 else -self.slope

    def _try(self) -> None:
        side = np.where(self.w != 0, np.sign(self.w), -np.sign(self.slope))
        to = self.w + self.length * self.way
        self.trial = np.where((self.absolute > 0) & (to * side <= 0), 0.0, to)


def _evaluate(rows: DataFrame, facts: _Facts, fits: Sequence[_Fit]) -> tuple[np.ndarray, np.ndarray]:
    """Summed loss and gradient of each model at its trial, over the rows outside its fold."""
    coefficients = np.array([f.trial for f in fits]).T
    held = np.array([-1 if f.fold is None else facts.folds[f.fold] for f in fits])

    def part(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        margins = x @ coefficients
        seen = fold[:, None] != held[None, :]
        loss = np.where(seen, np.logaddexp(0.0, margins) - y[:, None] * margins, 0.0)
        rest = np.where(seen, 0.5 * (1 + np.tanh(margins / 2)) - y[:, None], 0.0)
        return np.vstack([loss.sum(0)[None, :], x.T @ rest])

    sums = _summed(rows, facts, part, (len(coefficients) + 1, len(fits)))
    return sums[0], sums[1:].T


def _held_out(rows: DataFrame, facts: _Facts, fits: Sequence[_Fit]) -> np.ndarray:
    """(true positives, false positives, false negatives, true negatives) per model over its held-out fold."""
    coefficients = np.array([f.w for f in fits]).T
    held = np.array([-1 if f.fold is None else facts.folds[f.fold] for f in fits])

    def part(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        mine, one = fold[:, None] == held[None, :], (y == 1)[:, None]
        said = x[:, :-1] @ coefficients[:-1] + coefficients[-1] > 0
        return np.array([(mine & a & b).sum(0) for a, b in ((said, one), (said, ~one), (~said, one), (~said, ~one))], dtype=float)

    return _summed(rows, facts, part, (4, len(fits))).T


def _summed(rows: DataFrame, facts: _Facts, part, shape: tuple[int, int]) -> np.ndarray:
    """Sum of `part` over all rows: one matrix per task, then one per group of tasks."""
    centre, scale = facts.centre, facts.scale

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                label, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(centre))
                x = np.hstack([(x - centre) * scale, np.ones((len(x), 1))])
                total += part(x, label, fold)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def in_group(table: pa.Table) -> pa.Table:
        total = np.zeros(shape)
        for value in table.column("sums"):
            total += np.frombuffer(value.as_py()).reshape(shape)
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    tasks = rows.select("label", "fold", "x").mapInArrow(in_task, "sums binary")
    grouped = tasks.withColumn("_group", F.spark_partition_id() % MERGED_GROUPS).groupBy("_group").applyInArrow(in_group, "sums binary")
    return sum((np.frombuffer(r["sums"]).reshape(shape) for r in grouped.collect()), np.zeros(shape))


def _weighted_f1(tp: float, fp: float, fn: float, tn: float) -> float:
    """F1 of both classes, weighted by their rows; 0 for a fold without rows."""
    ones, zeros = tp + fn, tn + fp
    first = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
    second = 2 * tn / (2 * tn + fp + fn) if tn else 0.0
    return (ones * first + zeros * second) / (ones + zeros) if ones + zeros else 0.0
