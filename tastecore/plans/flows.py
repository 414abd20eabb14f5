"""The analyses end to end: genre table, genre classification, recommendation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.functions import binary_label
from tastecore.operators.aggregates import count_by
from tastecore.operators.classify import one_vs_rest
from tastecore.operators.features import index_strings, index_triplets, prepare
from tastecore.operators.joins import active_triplets, attach_label
from tastecore.operators.logistic_grid import LogisticSearch
from tastecore.operators.metrics import binary_metrics, multiclass_metrics, rmse, roc_auc
from tastecore.operators.ranking import ranking_metrics
from tastecore.operators.recommend import predict_ratings, recommend_rows, train_als
from tastecore.operators.relational import top_users
from tastecore.operators.sampling import balance, cap_classes, hash_split, user_holdout, with_folds
from tastecore.plans.staging import stage

# (name, estimator, grid search or None)
Algorithms = Sequence[tuple[str, Estimator, CrossValidator | LogisticSearch | None]]
FOLD = "fold"


def genre_dataset(features: DataFrame, genres: DataFrame, prefix: str, genre: str = "genre") -> DataFrame:
    """Feature rows that have a genre, with the columns named by `prefix` scaled as the vector `scfeatures`.

    `features` (track_id and feature columns) comes from `sources.read_features`, `genres` has track_id and genre.
    """
    return prepare(attach_label(features, genres, "track_id", genre), prefix)


def genre_report(genres: DataFrame, col: str = "genre") -> DataFrame:
    """Rows per genre, largest first."""
    return count_by(genres, col)


def _split_for_training(
    df: DataFrame, keys: Sequence[str], features: str, fraction: float, folds: int
) -> tuple[DataFrame, DataFrame]:
    """Staged training (with fold numbers) and test rows; every fit reads them again."""
    rows = with_folds(df, keys, folds).select(*dict.fromkeys([*keys, "label", features, FOLD]))
    training, test = hash_split(rows, keys, fraction, "split")
    return stage(training, "training", spread=keys), stage(test, "test")


def _tagged(metrics: DataFrame, name: str, variant: str) -> DataFrame:
    return metrics.select("*", F.lit(name).alias("algorithm"), F.lit(variant).alias("variant"))


def _binary_row(model: Model, test: DataFrame) -> DataFrame:
    score = vector_to_array("rawPrediction").getItem(1).alias("score")
    scored = stage(model.transform(test).select("label", "prediction", score), "scored")
    return binary_metrics(scored).withColumn("auc", roc_auc(scored).scalar())


def binary_experiment(
    df: DataFrame,
    algorithms: Algorithms,
    positive,
    keys: Sequence[str],
    target: str = "genre",
    features: str = "scfeatures",
    fraction: float = 0.7,
    folds: int = 5,
) -> DataFrame:
    """One class against the rest: every algorithm on all and on balanced training
    rows, and its grid search on balanced rows, scored on one untouched test set.
    """
    labels = df.withColumn("label", binary_label(target, positive))
    training, test = _split_for_training(labels, keys, features, fraction, folds)
    balanced = stage(balance(training, "label", keys), "balanced", spread=keys)
    rows = []
    for name, estimator, search in algorithms:
        runs = [("normal", estimator, training), ("balance", estimator, balanced)]
        if search is not None:
            runs.append(("cv", search, balanced))
        rows += [_tagged(_binary_row(e.fit(data), test), name, variant) for variant, e, data in runs]
    return reduce(DataFrame.unionByName, rows)


def multiclass_experiment(
    df: DataFrame,
    algorithms: Algorithms,
    keys: Sequence[str],
    target: str = "genre",
    features: str = "scfeatures",
    cap: int = 5000,
    fraction: float = 0.7,
    folds: int = 5,
) -> DataFrame:
    """All classes: every algorithm on all training rows, on rows capped per class,
    as one-vs-rest, and its grid search, the last two on all training rows.

    The cap fractions come from the whole table, so a capped class holds about
    `fraction` x `cap` training rows.
    """
    labels = index_strings(df.drop("label"), target, "label")
    training, test = _split_for_training(labels, keys, features, fraction, folds)
    capped = stage(cap_classes(training, "label", cap, keys, fractions_from=labels), "capped", spread=keys)
    rows = []
    for name, estimator, search in algorithms:
        runs = [
            ("normal", estimator, training),
            ("balance", estimator, capped),
            ("one-vs-rest", one_vs_rest(estimator, features), training),
        ]
        if search is not None:
            runs.append(("cv", search, training))
        for variant, e, data in runs:
            scored = e.fit(data).transform(test).select("label", "prediction")
            rows.append(_tagged(multiclass_metrics(scored), name, variant))
    return reduce(DataFrame.unionByName, rows)


def recommendation_experiment(
    triplets: DataFrame,
    mismatches: DataFrame,
    q: float = 0.25,
    fraction: float = 0.3,
    users: int = 10,
    k: int = 10,
    k_precision: int = 5,
    **als,
) -> DataFrame:
    """Clean, cut to active triplets, index, hold out, train ALS, and measure.

    `users` is the number of top test rows whose users are evaluated. Pass a
    stored table of triplets: it is read by several steps, each time through a
    filter by the mismatch list. The indexed table is staged.
    """
    dataset = stage(index_triplets(active_triplets(triplets, q, mismatches)), "dataset")
    training, test = user_holdout(dataset, fraction)
    model = train_als(training, **als)
    chosen = stage(top_users(test, users), "users")
    truth = test.join(chosen, "user", "left_semi").select("user", "item")
    recommended = stage(recommend_rows(model, chosen, k), "recommended")
    error = rmse(predict_ratings(model, test)).scalar()
    return ranking_metrics(recommended, truth, k_precision, k).withColumn("rmse", error)
