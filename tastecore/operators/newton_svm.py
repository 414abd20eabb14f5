"""Linear support vector machines with the squared hinge loss, by a trust-region Newton method.

Minimises |w|^2 / 2 + C * sum(max(0, 1 - y (w . x))^2) over all rows, where x ends with a constant 1, so that the intercept
is penalised like the other coefficients. Loss and gradient are sums over the rows: one aggregate per iteration for all
classes together. With few features that aggregate also takes the second derivatives; with more of them, each step
of the conjugate gradients inside takes one product of the Hessian with a vector, again sums over the rows. Only
numbers per class and feature reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.plans.staging import stage

EXPLICIT = 24  # features up to which the second derivatives are summed in the same aggregate
SUMS_AT_ONCE = 400
UNROLLED = 64


def _dot(x: Column, w: Sequence[float]) -> Column:
    if len(w) <= UNROLLED:
        return reduce(lambda a, b: a + b, [F.get(x, F.lit(j)) * F.lit(float(v)) for j, v in enumerate(w)])
    products = F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


class LinearModel(Model):
    """Scores w . x + b per class; the prediction is the class of the largest one, or of the sign for two classes."""

    def __init__(self, classes: Sequence[float], weights: np.ndarray, features: str, losses: Sequence[float] = ()) -> None:
        super().__init__()
        self.classes, self.features, self.losses = tuple(float(c) for c in classes), features, tuple(losses)
        self.coefficients, self.intercepts = weights[:, :-1], weights[:, -1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.features))
        scores = [_dot(F.col("_x"), w) + F.lit(float(b)) for w, b in zip(self.coefficients, self.intercepts)]
        if len(scores) == 1:  # of the last class against the first one
            scores = [-scores[0], scores[0]]
        scored = dataset.withColumn("_x", x).withColumn("_scores", F.array(*scores)).drop("_x")
        place = F.array_position("_scores", F.array_max("_scores")).cast("int")
        named = F.array(*[F.lit(c) for c in self.classes])
        return scored.withColumns({"rawPrediction": array_to_vector("_scores"), "prediction": F.get(named, place - 1)}).drop("_scores")


def _sums(rows: DataFrame, columns: list[Column]) -> np.ndarray:
    """Sums of many expressions, SUMS_AT_ONCE in one aggregate."""
    out: list[float] = []
    for start in range(0, len(columns), SUMS_AT_ONCE):
        part = columns[start : start + SUMS_AT_ONCE]
        out += [v or 0.0 for v in rows.agg(*[F.sum(c).alias(f"s{i}") for i, c in enumerate(part)]).head()]
    return np.array(out)


class _Objective:
    """Value, gradient and curvature for the weights of several classes, each against the rest."""

    def __init__(self, rows: DataFrame, classes: Sequence[float], size: int, c: float) -> None:
        self.rows, self.classes, self.size, self.c = rows, classes, size, c
        self.passes = 0

    def _sign(self, cls: float) -> Column:
        return F.when(F.col("label") == F.lit(cls), 1.0).otherwise(-1.0)

    def _slack(self, cls: float, w: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - self._sign(cls) * _dot(F.col("x"), w))

    def at(self, chosen: Sequence[int], weights: np.ndarray) -> list[tuple[float, np.ndarray, Callable]]:
        """For the `chosen` classes at their `weights`: value, gradient, and a function v -> Hessian . v."""
        self.passes += 1
        d, explicit = self.size, self.size <= EXPLICIT
        rows = self.rows.select("label", "x", *[self._slack(self.classes[k], weights[k]).alias(f"r{k}") for k in chosen])
        x = [F.get("x", F.lit(j)) for j in range(d)]
        columns = []
        for k in chosen:
            r, y = F.col(f"r{k}"), self._sign(self.classes[k])
            columns += [r * r, *[y * r * x[j] for j in range(d)]]
            if explicit:
                columns += [F.when(r > 0, x[i] * x[j]).otherwise(0.0) for i in range(d) for j in range(i, d)]
        sums, out, at = _sums(rows, columns), [], 0
        for k in chosen:
            w = weights[k]
            value, gradient = w @ w / 2 + self.c * sums[at], w - 2 * self.c * sums[at + 1 : at + 1 + d]
            at += 1 + d
            if explicit:
                upper = np.zeros((d, d))
                upper[np.triu_indices(d)] = sums[at : at + d * (d + 1) // 2]
                at += d * (d + 1) // 2
                hessian = np.eye(d) + 2 * self.c * (upper + np.triu(upper, 1).T)
                out.append((float(value), gradient, hessian.__matmul__))
            else:
                out.append((float(value), gradient, self._product(k, w.copy())))
        return out

    def _product(self, k: int, w: np.ndarray) -> Callable:
        def times(v: np.ndarray) -> np.ndarray:
            self.passes += 1
            active = self.rows.filter(self._slack(self.classes[k], w) > 0).select("x", _dot(F.col("x"), v).alias("p"))
            return v + 2 * self.c * _sums(active, [F.col("p") * F.get("x", F.lit(j)) for j in range(self.size)])

        return times


def _step(gradient: np.ndarray, times: Callable, radius: float, forcing: float) -> tuple[np.ndarray, float]:
    """Conjugate gradients for the Newton step, up to the border of the trust region; and the decrease it promises."""
    step, rest = np.zeros_like(gradient), -gradient
    way, size = rest.copy(), rest @ rest
    for _ in range(2 * len(gradient)):
        if np.sqrt(size) <= forcing * np.linalg.norm(gradient):
            break
        bent = times(way)
        length, border = size / (way @ bent), False
        if np.linalg.norm(step + length * way) >= radius:
            a, b, c = way @ way, 2 * step @ way, step @ step - radius**2
            length, border = (-b + np.sqrt(max(0.0, b * b - 4 * a * c))) / (2 * a), True
        step, rest = step + length * way, rest - length * bent
        if border:
            break
        size, before = rest @ rest, size
        way = rest + size / before * way
    return step, float(-(gradient @ step) / 2 + rest @ step / 2)  # rest = -gradient - Hessian . step


def squared_hinge_svm(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    c: float = 1.0,
    multiclass: bool = False,
    tolerance: float = 1e-9,
    max_iterations: int = 100,
) -> LinearModel:
    """Binary (labels 0 and 1), or one model per class against the rest; all classes share the passes over the rows.

    Stops when the gradient has shrunk by `tolerance`. Rows with a null label or vector take no part.
    """
    known = df.filter(F.col(label).isNotNull() & F.col(features).isNotNull())
    rows = stage(known.select(F.col(label).cast("double").alias("label"), F.concat(vector_to_array(F.col(features)), F.array(F.lit(1.0))).alias("x")), "rows")
    found = rows.groupBy("label").agg(F.max(F.size("x")).alias("n")).collect()  # one row per class
    if not found:
        raise ValueError("no rows to learn from")
    size = max(r["n"] for r in found)
    classes = sorted(r["label"] for r in found) if multiclass else [0.0, 1.0]
    objective = _Objective(rows, classes if multiclass else [1.0], size, c)
    models = len(objective.classes)
    weights = np.zeros((models, size))
    state = dict(enumerate(objective.at(range(models), weights)))
    radius = {k: float(np.linalg.norm(s[1])) for k, s in state.items()}
    goal = {k: max(tolerance * r, 1e-300) for k, r in radius.items()}
    open_ = [k for k in range(models) if radius[k] > goal[k]]
    for _ in range(max_iterations):
        if not open_:
            break
        steps = {k: _step(state[k][1], state[k][2], radius[k], min(0.1, np.sqrt(np.linalg.norm(state[k][1]) * tolerance / goal[k]))) for k in open_}
        trial = weights.copy()
        for k, (s, _) in steps.items():
            trial[k] += s
        tried = dict(zip(open_, objective.at(open_, trial)))
        left = []
        for k in open_:
            value, (s, hoped) = state[k][0], steps[k]
            gained = value - tried[k][0]
            ratio = gained / hoped if hoped > 0 else 0.0
            length = float(np.linalg.norm(s))
            radius[k] = max(radius[k], 2 * length) if ratio > 0.75 else radius[k] if ratio > 0.25 else length / 4
            settled = hoped <= 1e-15 * max(1.0, abs(value))  # rounding decides from here on
            if ratio > 1e-4 or settled and gained >= 0:
                weights[k], state[k] = trial[k], tried[k]
            if np.linalg.norm(state[k][1]) > goal[k] and not settled:
                left.append(k)
        open_ = left
    return LinearModel(classes, weights, features, [state[k][0] for k in range(models)])
