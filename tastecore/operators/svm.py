"""Support vector machines: linear, and an RBF kernel by random Fourier features."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.operators.classify import one_vs_rest


def _linear(rows: int, features: str, label: str, c: float, **params) -> LinearSVC:
    """Spark weighs the mean loss, so C per row becomes regParam = 1 / (C * rows), on coefficients of the raw columns."""
    return LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (c * rows), standardization=False, **params)


def linear_svm(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    c: float = 1.0,
    multiclass: bool = False,
    **params,
) -> Model:
    """Binary linear SVM, or one per class against the rest."""
    svc = _linear(df.count(), features, label, c, **params)
    if multiclass:
        return one_vs_rest(svc, features, label).fit(df)
    return svc.fit(df)


def fourier_weights(dims: int, gamma: float, n_features: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and phases whose cosines average to exp(-gamma |x - y|^2)."""
    draw = np.random.default_rng(seed)
    return (
        draw.normal(0.0, math.sqrt(2 * gamma), (n_features, dims)),
        draw.uniform(0.0, 2 * math.pi, n_features),
    )


def fourier_terms(cols: Sequence[str], gamma: float, n_features: int, seed: int = 0) -> list[str]:
    """The feature map sqrt(2/D) cos(w.x + b) as SQL expressions named rff_0, rff_1, ..."""
    directions, phases = fourier_weights(len(cols), gamma, n_features, seed)
    size = math.sqrt(2.0 / n_features)
    return [
        f"{size!r}D * cos({float(b)!r}D + " + " + ".join(f"`{c}` * {float(x)!r}D" for c, x in zip(cols, w)) + f") AS rff_{i}"
        for i, (w, b) in enumerate(zip(directions, phases))
    ]


def fourier_columns(cols: Sequence[str], gamma: float, n_features: int, seed: int = 0) -> list[Column]:
    """The same map as columns."""
    return [F.expr(term) for term in fourier_terms(cols, gamma, n_features, seed)]


def rbf_svm(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "label",
    gamma: float = 0.7,
    c: float = 1.0,
    n_features: int = 200,
    seed: int = 0,
    **params,
) -> Model:
    """One-vs-rest linear SVM on random Fourier features (Rahimi and Recht 2007).

    The fitted model takes the raw columns, so it can score any table that has
    them. Spark has no kernel SVM; the error falls with 1 / sqrt(n_features).
    """
    names = [f"rff_{i}" for i in range(n_features)]
    svc = _linear(df.count(), "rff", label, c, **params)
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join(fourier_terms(cols, gamma, n_features, seed))} FROM __THIS__"),
            VectorAssembler(inputCols=names, outputCol="rff"),
            one_vs_rest(svc, "rff", label),
        ]
    ).fit(df)
