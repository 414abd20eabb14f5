"""Classifiers, parameter grids and cross validation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastecore.operators.features import assemble
from tastecore.plans.staging import stage

KINDS = {
    "logistic": LogisticRegression,
    "forest": RandomForestClassifier,
    "tree": DecisionTreeClassifier,
}

# The published search grids.
LOGISTIC_GRID = {"elasticNetParam": [0.0, 0.5, 1.0], "regParam": [0.0, 0.25, 0.5]}
TREE_GRID = {"maxBins": [16, 32, 64], "maxDepth": [1, 5, 10], "impurity": ["gini", "entropy"]}
FOREST_GRID = {"featureSubsetStrategy": ["auto", "all", "onethird", "sqrt"], **TREE_GRID}


def classifier(kind: str, features: str = "scfeatures", label: str = "label", **params) -> Estimator:
    return KINDS[kind](featuresCol=features, labelCol=label, **params)


PART_BYTES = 128 << 20  # of vectors in a partition that a search trains on
MOST_AT_ONCE = 32


def _side_by_side(session: SparkSession, function: Callable[[int], object], count: int, at_once: int) -> list:
    """[function(0), function(1), ...] in threads, each call with local properties of its own.

    Spark's own searches give one properties object to all their threads: a query that ends in one thread then
    clears the execution id that a query starting in another one is about to read ("Cannot parse null string").
    """
    calls = [inheritable_thread_target(session)(partial(function, i)) for i in range(count)]
    with ThreadPool(max(1, min(at_once, count))) as pool:
        return pool.map(lambda call: call(), calls, chunksize=1)


class GridSearch(CrossValidator):
    """Spark's cross validation, its fits side by side on as few partitions as the size of the rows asks for.

    In every pass each partition sends the statistics of all open tree nodes, however few rows it holds. So rows are
    put together to partitions of PART_BYTES, and cores are filled by fits instead: at least `parallelism` of them at a time.
    The rows are staged, not cached: a cached partition would draw all fits to the executor that holds it.
    """

    def _partitions(self, dataset: DataFrame) -> int:
        estimator = self.getEstimator()
        if not estimator.hasParam("featuresCol"):
            return dataset.rdd.getNumPartitions()
        width = F.max(F.size(vector_to_array(estimator.getOrDefault("featuresCol"))))
        rows, values = dataset.agg(F.count(F.lit(1)), width).head()
        return max(1, -(-rows * (values or 0) * 8 // PART_BYTES))

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        estimator, points, evaluator = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        session, kept = dataset.sparkSession, self.getCollectSubModels()
        parts = self._partitions(dataset)
        at_once = max(self.getParallelism(), min(MOST_AT_ONCE, session.sparkContext.defaultParallelism // parts))
        scores, models = [], []
        for folds in self._kFold(stage(dataset.coalesce(parts), "search")):
            train, validation = (rows.coalesce(parts) for rows in folds)

            def fitted(i: int) -> tuple[float, Model | None]:
                model = estimator.fit(train, points[i])
                return evaluator.evaluate(model.transform(validation, points[i])), model if kept else None

            found = _side_by_side(session, fitted, len(points), at_once)
            scores.append([score for score, _ in found])
            models.append([model for _, model in found])
        means = np.mean(scores, axis=0)
        best = int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))
        chosen = estimator.fit(dataset, points[best])
        return self._copyValues(CrossValidatorModel(chosen, means.tolist(), models if kept else None, np.std(scores, axis=0).tolist()))


class ClassesAgainstRest(OneVsRest):
    """Spark's one-vs-rest, its fits in threads with local properties of their own."""

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        base, label, features = self.getClassifier(), self.getLabelCol(), self.getFeaturesCol()
        classes = int(dataset.agg(F.max(label)).head()[0]) + 1
        weight = self.getWeightCol() if self.isDefined(self.weightCol) and base.hasParam("weightCol") else None
        rows = dataset.select(label, features, *([weight] if weight else []))
        own_cache = dataset.storageLevel == StorageLevel(False, False, False, False)

        def fitted(i: int) -> Model:
            binary = f"mc2b${i}"
            params = {base.labelCol: binary, base.featuresCol: features, base.predictionCol: self.getPredictionCol()}
            if weight:
                params[base.weightCol] = weight
            return base.fit(rows.withColumn(binary, F.when(F.col(label) == float(i), 1.0).otherwise(0.0)), params)

        if own_cache:
            rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            models = _side_by_side(dataset.sparkSession, fitted, classes, self.getParallelism())
        finally:
            if own_cache:
                rows.unpersist()
        return self._copyValues(OneVsRestModel(models=models))


def cross_validate(
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    folds: int = 5,
    metric: str = "f1",
    fold_col: str | None = None,
    seed: int = 1,
    parallelism: int = 4,
) -> GridSearch:
    """Grid search over parameters of `estimator` itself.

    With `fold_col` (see sampling.with_folds) the folds do not depend on how
    the rows are partitioned. At least `parallelism` fits run at the same time.
    """
    points = ParamGridBuilder()
    for name, values in grid.items():
        points = points.addGrid(estimator.getParam(name), list(values))
    evaluator = MulticlassClassificationEvaluator(
        metricName=metric, labelCol=estimator.getLabelCol(), predictionCol=estimator.getPredictionCol()
    )
    search = GridSearch(
        estimator=estimator,
        estimatorParamMaps=points.build(),
        evaluator=evaluator,
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    return search.setFoldCol(fold_col) if fold_col else search


def one_vs_rest(
    base: Estimator, features: str = "scfeatures", label: str = "label", parallelism: int = 4
) -> OneVsRest:
    """One binary model per class on the same feature column as `base`."""
    return ClassesAgainstRest(classifier=base, featuresCol=features, labelCol=label, parallelism=parallelism)


def decision_surface(model: Model, mesh: DataFrame, features: Sequence[str], vector: str = "features") -> DataFrame:
    """Predicted class on every mesh point."""
    points = assemble(mesh, features, vector)
    return model.transform(points).select(*features, "prediction")
