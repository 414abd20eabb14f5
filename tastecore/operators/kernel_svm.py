"""Support vector machines with a Gaussian kernel, one against one, over distributed rows.

Rows are projected on landmarks (Nystroem): phi(x) = R k(x), where k holds the kernel values to the landmarks and R' R inverts
their kernel matrix, so phi(x) . phi(z) approaches the kernel from below and equals it at landmarks. Landmarks are refined:
each round reads all rows and adds those that are worst represented, 1 - |phi(x)|^2 being the error at a row, until no
row errs by more than `tolerance` or there are `most_landmarks`. The model states the largest error that is left.

For each pair of classes, |w|^2 / 2 + C * sum(hinge(y (w . phi(x) + b))) is minimised in the primal by Newton steps, with the
kink of the hinge rounded off over a width that shrinks to `width`; the optimum is within C * rows * width / 4 of the hinge's.
An iteration is one reading of the rows for all pairs: tasks sum gradients and second derivatives of their rows with numpy,
and the sums are merged in two levels. Equal rows are merged to one weighted row before. Only landmarks, and sums per
pair of classes and landmark, reach the driver.

A row's class has the most votes of the pairs, the first class at a tie.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.plans.staging import stage

FIRST_LANDMARKS = 32
MERGED_GROUPS = 64
ROWS_AT_ONCE = 4_096
WIDTHS = (4.0, 1.0, 0.2, 0.05, 0.01)  # from one that holds every row at weights of 0


def kernel(x: np.ndarray, z: np.ndarray, gamma: float) -> np.ndarray:
    apart = (x * x).sum(1)[:, None] + (z * z).sum(1) - 2 * x @ z.T
    return np.exp(-gamma * np.maximum(apart, 0.0))


def _root(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """R with R' R = inverse of the landmarks' kernel matrix, directions without weight left out; one column per direction."""
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks, gamma))
    kept = values > 1e-10 * values[-1]
    return vectors[:, kept] / np.sqrt(values[kept])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(class, weight, values) of some rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            values = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield part.column("label").to_numpy(), part.column("n").to_numpy().astype(float), values


def _worst(rows: DataFrame, landmarks: np.ndarray, gamma: float, most: int) -> list:
    """The rows that the landmarks represent worst, each task's worst at first: [(error, values), ...]."""
    root = _root(landmarks, gamma) if len(landmarks) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, x in _blocks(batches):
            error = np.ones(len(x)) if root is None else 1 - ((kernel(x, landmarks, gamma) @ root) ** 2).sum(1)
            top = np.argsort(-error, kind="stable")[:most]
            yield pa.RecordBatch.from_pydict({"error": pa.array(error[top]), "x": pa.array(x[top].tolist(), pa.list_(pa.float64()))})

    found = rows.select("label", "n", "x").mapInArrow(run, "error double, x array<double>")
    # The same values may stand in several classes.
    return found.distinct().orderBy(F.desc("error"), "x").limit(most).collect()


def choose_landmarks(rows: DataFrame, gamma: float, most: int, tolerance: float) -> tuple[np.ndarray, float]:
    """Landmarks, and the largest error of any row. Each round adds rows that also err beside those already added."""
    draw = F.xxhash64("x")
    first = rows.select("x").distinct().orderBy(draw, "x").limit(min(FIRST_LANDMARKS, most)).collect()
    landmarks = np.array([r["x"] for r in first], float)
    while True:
        room = max(1, min(most - len(landmarks), len(landmarks)))
        worst = _worst(rows, landmarks, gamma, 4 * room)
        error = max(0.0, worst[0]["error"])
        if error <= tolerance or len(landmarks) >= most:
            return landmarks, error
        landmarks = np.vstack([landmarks, _apart(np.array([r["x"] for r in worst]), landmarks, gamma, room, max(tolerance, error / 8))])


def _apart(candidates: np.ndarray, landmarks: np.ndarray, gamma: float, most: int, least: float) -> np.ndarray:
    """Those of the candidates that err by more than `least` beside the ones before: most err near each other."""
    phi = kernel(candidates, landmarks, gamma) @ _root(landmarks, gamma)
    left, chosen = kernel(candidates, candidates, gamma) - phi @ phi.T, []
    while len(chosen) < most:
        worst = int(left.diagonal().argmax())
        if chosen and left[worst, worst] <= least:
            break
        chosen.append(worst)
        left = left - np.outer(left[worst], left[worst]) / max(left[worst, worst], 1e-12)
    return candidates[chosen]


def _rounded_hinge(margin: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value, first and second derivative of the hinge, a parabola within `width` of its kink."""
    over = 1 - margin
    inside = np.abs(over) < width
    value = np.where(inside, (over + width) ** 2 / (4 * width), np.maximum(over, 0.0))
    slope = np.where(inside, -(over + width) / (2 * width), np.where(over > 0, -1.0, 0.0))
    return value, slope, np.where(inside, 1 / (2 * width), 0.0)


SUMS = "pair int, bucket int, sums binary"


def _added(table: pa.Table, bucket: str) -> pa.Table:
    total = np.sum([np.frombuffer(v) for v in table.column("sums").to_pylist()], axis=0)
    kept = table.column(bucket)[0].as_py()
    return pa.table({"pair": pa.array([table.column("pair")[0].as_py()], pa.int32()), "bucket": pa.array([kept], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


class _Pairs:
    """Sums over the rows for all pairs of classes at given weights."""

    def __init__(self, rows: DataFrame, classes: Sequence[float], landmarks: np.ndarray, gamma: float, c: float) -> None:
        self.rows, self.classes, self.landmarks, self.gamma, self.c = rows, classes, landmarks, gamma, c
        self.root = _root(landmarks, gamma)
        self.pairs = list(itertools.combinations(range(len(classes)), 2))
        self.size = self.root.shape[1] + 1

    def at(self, chosen: Sequence[int], weights: np.ndarray, width: float) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
        """Value, gradient and Hessian of the chosen pairs."""
        landmarks, gamma, root, size = self.landmarks, self.gamma, self.root, self.size
        ends = {p: (self.classes[self.pairs[p][0]], self.classes[self.pairs[p][1]], weights[p].copy()) for p in chosen}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {p: [0.0, np.zeros(size), np.zeros((size, size))] for p in ends}
            for label, n, x in _blocks(batches):
                phi = np.hstack([kernel(x, landmarks, gamma) @ root, np.ones((len(x), 1))])
                for p, (first, second, w) in ends.items():
                    own = (label == first) | (label == second)
                    y, z, k = np.where(label[own] == first, 1.0, -1.0), phi[own], n[own]
                    value, slope, bend = _rounded_hinge(y * (z @ w), width)
                    sums[p][0] += float(k @ value)
                    sums[p][1] += z.T @ (k * y * slope)
                    sums[p][2] += (z * (k * bend)[:, None]).T @ z
            packed = [np.concatenate(([v], g, h.ravel())).tobytes() for v, g, h in sums.values()]
            yield pa.RecordBatch.from_pydict({"pair": pa.array(list(sums), pa.int32()), "sums": pa.array(packed, pa.binary())})

        parts = self.rows.select("label", "n", "x").mapInArrow(run, "pair int, sums binary")
        dealt = parts.select("pair", (F.spark_partition_id() % MERGED_GROUPS).alias("bucket"), "sums")
        merged = dealt.groupBy("pair", "bucket").applyInArrow(lambda t: _added(t, "bucket"), SUMS)
        out = {}
        for r in merged.groupBy("pair").applyInArrow(lambda t: _added(t, "bucket"), SUMS).collect():  # one row per pair
            sums, w = np.frombuffer(r["sums"]), weights[r["pair"]].copy()
            w[-1] = 0.0  # the intercept is not penalised
            hessian = np.diag(np.append(np.ones(size - 1), 0.0)) + self.c * sums[1 + size :].reshape(size, size)
            hessian[-1, -1] += 1e-2 * self.c  # no row may be near the kink: keeps the intercept's step short
            out[r["pair"]] = (float(w @ w / 2 + self.c * sums[0]), w + self.c * sums[1 : 1 + size], hessian)
        return out


class KernelModel(Model):
    """Votes of the pairs. `error`: the largest 1 - |phi(x)|^2 of a training row; `losses`: the minimum found for each pair."""

    def __init__(self, cols, classes, landmarks, gamma, alphas, intercepts, error, losses) -> None:
        super().__init__()
        self.cols, self.classes, self.landmarks, self.gamma = list(cols), list(classes), landmarks, gamma
        self.alphas, self.intercepts, self.error, self.losses = alphas, intercepts, error, losses

    def predicted(self, x: np.ndarray) -> np.ndarray:
        votes = np.zeros((len(x), len(self.classes)), int)
        for start in range(0, len(x), ROWS_AT_ONCE):
            part = slice(start, start + ROWS_AT_ONCE)
            scores = kernel(x[part], self.landmarks, self.gamma) @ self.alphas.T + self.intercepts
            for p, (a, b) in enumerate(itertools.combinations(range(len(self.classes)), 2)):
                votes[part, a] += scores[:, p] >= 0
                votes[part, b] += scores[:, p] < 0
        return np.array(self.classes)[votes.argmax(1)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        predicted = self.predicted

        @F.pandas_udf("double")
        def prediction(values: pd.DataFrame) -> pd.Series:
            return pd.Series(predicted(values.to_numpy(float)))

        return dataset.withColumn("prediction", prediction(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.cols)])))


def kernel_svm(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "label",
    gamma: float = 0.7,
    c: float = 1.0,
    most_landmarks: int = 512,
    tolerance: float = 1e-4,
    width: float = WIDTHS[-1],
    steps_at_width: int = 30,
) -> KernelModel:
    """Gaussian kernel exp(-gamma |x - z|^2), one model per pair of classes. Rows with a null, NaN or infinite value take no part."""
    values = F.array(*[F.col(x).cast("double") for x in cols])
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    known = df.select(F.col(label).cast("double").alias("label"), values.alias("x")).filter(F.col("label").isNotNull() & finite)
    rows = stage(known.groupBy("label", "x").agg(F.count(F.lit(1)).alias("n")), "merged")
    classes = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if not classes:
        raise ValueError("no rows to learn from")
    landmarks, error = choose_landmarks(rows, gamma, most_landmarks, tolerance)
    problem = _Pairs(rows, classes, landmarks, gamma, c)
    weights = np.zeros((len(problem.pairs), problem.size))
    losses = [0.0] * len(problem.pairs)
    for rounded in [w for w in WIDTHS if w > width] + [width]:
        state = problem.at(range(len(weights)), weights, rounded) if len(weights) else {}
        size = dict.fromkeys(state, 1.0)
        open_ = list(state)
        for _ in range(steps_at_width):
            if not open_:
                break
            steps = {k: -np.linalg.solve(state[k][2], state[k][1]) for k in open_}
            trial = weights.copy()
            for k in open_:
                trial[k] += size[k] * steps[k]
            tried, left = problem.at(open_, trial, rounded), []
            for k in open_:
                falls = -float(state[k][1] @ steps[k])
                if tried[k][0] <= state[k][0] - 1e-4 * size[k] * falls:
                    weights[k], state[k] = trial[k], tried[k]
                    done = size[k] == 1.0 and falls <= 1e-7 * (1 + abs(tried[k][0]))
                    size[k] = min(1.0, 4 * size[k])
                else:
                    done = falls <= 1e-9 * (1 + abs(state[k][0])) or size[k] < 1e-6
                    size[k] /= 4
                if not done:
                    left.append(k)
            open_ = left
        losses = [state[k][0] for k in sorted(state)]
    alphas = weights[:, :-1] @ problem.root.T
    return KernelModel(cols, classes, landmarks, gamma, alphas, weights[:, -1], error, losses)
