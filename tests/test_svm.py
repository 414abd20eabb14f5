"""Support vector machines against dense solutions in numpy."""

import numpy as np
import pytest

from tastecore.operators import features, kernel_svm, newton_svm


def _table(spark, x, y):
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = [(*map(float, v), float(c)) for v, c in zip(x, y)]
    return features.assemble(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "label"])).repartition(4), names, "features")


def dense(x, y, c):
    """Newton steps with a line search on the squared hinge loss; the constant is penalised."""
    x = np.hstack([x, np.ones((len(x), 1))])

    def value(w):
        return w @ w / 2 + c * (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    w = np.zeros(x.shape[1])
    for _ in range(500):
        r = np.maximum(0, 1 - y * (x @ w))
        gradient, active = w - 2 * c * x.T @ (y * r), x[r > 0]
        step = -np.linalg.solve(np.eye(len(w)) + 2 * c * active.T @ active, gradient)
        size = 1.0
        while value(w + size * step) > value(w) and size > 1e-12:
            size /= 2
        w = w + size * step
    return w, value(w)


@pytest.mark.parametrize("dims,c,explicit", [(2, 1.0, 24), (2, 0.01, 0), (8, 0.5, 24)])
def test_squared_hinge_reaches_the_dense_optimum(spark, monkeypatch, dims, c, explicit):
    monkeypatch.setattr(newton_svm, "EXPLICIT", explicit)
    draw = np.random.default_rng(dims)
    y = draw.integers(0, 2, 150)
    x = draw.normal(0, 1, (150, dims)) * np.linspace(0.2, 4, dims) + 0.7 * y[:, None]
    model = newton_svm.squared_hinge_svm(_table(spark, x, y), c=c)
    want, value = dense(x, 2 * y - 1.0, c)
    assert model.losses[0] == pytest.approx(value, rel=1e-9)
    assert np.abs(np.append(model.coefficients[0], model.intercepts[0]) - want).max() < 1e-6


def test_squared_hinge_of_three_classes(spark):
    draw = np.random.default_rng(5)
    y = np.repeat([0, 1, 4], [80, 50, 30])
    x = draw.normal(0, 1, (160, 2)) + np.array([(0, 0), (3, 0), (0, 3)])[np.repeat([0, 1, 2], [80, 50, 30])]
    table = _table(spark, x, y)
    model = newton_svm.squared_hinge_svm(table, multiclass=True)
    scores = []
    for k, cls in enumerate((0, 1, 4)):
        want, value = dense(x, np.where(y == cls, 1.0, -1.0), 1.0)
        assert model.losses[k] == pytest.approx(value, rel=1e-9)
        scores.append(np.hstack([x, np.ones((160, 1))]) @ want)
    plan = model.transform(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    found = {(r["x0"], r["x1"]): r["prediction"] for r in model.transform(table).collect()}
    best = np.array([0, 1, 4])[np.argmax(scores, 0)]
    assert [found[tuple(v)] for v in x.tolist()] == best.tolist()


def test_squared_hinge_edge_cases(spark):
    one = _table(spark, np.array([[1.0], [2.0]]), [1, 1])
    model = newton_svm.squared_hinge_svm(one)
    assert [r["prediction"] for r in model.transform(one).collect()] == [1.0, 1.0]
    with pytest.raises(ValueError):
        newton_svm.squared_hinge_svm(one.limit(0))
    nulls = one.unionByName(one.selectExpr("x0", "CAST(NULL AS double) AS label", "features"))
    assert newton_svm.squared_hinge_svm(nulls).losses == pytest.approx(model.losses)


def dual(x, y, gamma, c):
    """The kernel machine's dual, by pairwise steps on the most violating rows (no landmarks, no rounding)."""
    k = kernel_svm.kernel(x, x, gamma)
    alpha, slope = np.zeros(len(x)), -np.ones(len(x))
    for _ in range(100_000):
        up = ((y > 0) & (alpha < c)) | ((y < 0) & (alpha > 0))
        low = ((y < 0) & (alpha < c)) | ((y > 0) & (alpha > 0))
        score = -y * slope
        i, j = np.where(up, score, -np.inf).argmax(), np.where(low, score, np.inf).argmin()
        if score[i] - score[j] < 1e-8:
            break
        most = [c - alpha[i] if y[i] > 0 else alpha[i], alpha[j] if y[j] > 0 else c - alpha[j]]
        step = min((score[i] - score[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12), *most)
        alpha[i] += y[i] * step
        alpha[j] -= y[j] * step
        slope += y * step * (k[:, i] - k[:, j])
    free = (alpha > 1e-9) & (alpha < c - 1e-9)
    b = (-y * slope)[free].mean() if free.any() else (score[i] + score[j]) / 2
    return alpha * y, b, float(alpha.sum() - (alpha * y) @ k @ (alpha * y) / 2)


@pytest.fixture(scope="module")
def spirals():
    draw = np.random.default_rng(8)
    turn = draw.uniform(0.5, 3, 240)
    cls = np.arange(240) % 3
    angle = turn * 2 + cls * 2 * np.pi / 3
    return np.c_[turn * np.cos(angle), turn * np.sin(angle)] + draw.normal(0, 0.15, (240, 2)), cls


@pytest.mark.parametrize("most,share", [(512, 0.995), (60, 0.97)])
def test_kernel_svm_agrees_with_the_dual_solution(spark, spirals, most, share):
    x, cls = spirals
    names = ["x0", "x1"]
    rows = [(*map(float, v), float(c)) for v, c in zip(x, cls)]
    table = spark.createDataFrame([*rows, *rows[:40], (None, 1.0, 0.0), (float("nan"), 1.0, 1.0)], "x0 double, x1 double, label double").repartition(5)
    model = kernel_svm.kernel_svm(table, names, most_landmarks=most)
    doubled = np.vstack([x, x[:40]]), np.concatenate([cls, cls[:40]])
    mesh = np.array([(a, b) for a in np.arange(-3.5, 3.5, 0.1) for b in np.arange(-3.5, 3.5, 0.1)])
    votes = np.zeros((len(mesh), 3), int)
    for p, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        own = (doubled[1] == a) | (doubled[1] == b)
        points, y = doubled[0][own], np.where(doubled[1][own] == a, 1.0, -1.0)
        weights, shift, value = dual(points, y, 0.7, 1.0)
        score = kernel_svm.kernel(mesh, points, 0.7) @ weights + shift
        votes[:, a] += score >= 0
        votes[:, b] += score < 0
        assert model.losses[p] == pytest.approx(value, rel=0.01 if most == 512 else 0.1)
    assert (model.predicted(mesh) == votes.argmax(1)).mean() >= share
    assert (model.error <= 1e-4) == (most == 512)
    scored = model.transform(table.filter("x0 is not null")).limit(20).collect()
    assert [r["prediction"] for r in scored] == model.predicted(np.array([[r["x0"], r["x1"]] for r in scored])).tolist()


def test_kernel_svm_edge_cases(spark):
    schema = "x0 double, x1 double, label double"
    one = kernel_svm.kernel_svm(spark.createDataFrame([(1.0, 2.0, 7.0)], schema), ["x0", "x1"])
    assert one.predicted(np.array([[0.0, 0.0]])).tolist() == [7.0]
    both = kernel_svm.kernel_svm(spark.createDataFrame([(1.0, 2.0, 7.0), (-1.0, 2.0, 3.0)] * 3, schema), ["x0", "x1"])
    assert both.predicted(np.array([[1.0, 2.0], [-1.0, 2.0]])).tolist() == [7.0, 3.0]
    with pytest.raises(ValueError):
        kernel_svm.kernel_svm(spark.createDataFrame([], schema), ["x0", "x1"])
