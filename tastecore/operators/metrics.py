"""Classification and regression metrics as DataFrame aggregates, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.functions import safe_ratio
from tastecore.operators.relational import drop_nan
from tastecore.plans.ordering import running_totals
from tastecore.plans.staging import stage


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """tp, fp, tn, fn for positive class 1.0."""
    yes, said = F.col(label) == 1.0, F.col(prediction) == 1.0
    no, denied = F.col(label) == 0.0, F.col(prediction) == 0.0
    return df.agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(no & said).alias("fp"),
        F.count_if(no & denied).alias("tn"),
        F.count_if(yes & denied).alias("fn"),
    )


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    """Add precision, recall and f1; each is 0 where its denominator is 0."""
    precision, recall = F.col("precision"), F.col("recall")
    return (
        counts.withColumn("precision", safe_ratio("tp", F.col("tp") + F.col("fp")))
        .withColumn("recall", safe_ratio("tp", F.col("tp") + F.col("fn")))
        .withColumn("f1", safe_ratio(2 * precision * recall, precision + recall))
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return precision_recall_f1(confusion_counts(df, label, prediction))


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.col(label) == 1.0
    return df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, tied scores counted half.

    Sum over scores of positives x (negatives below + half the ties), in
    doubles because the product of two counts can pass 64 bits.
    """
    seen = running_totals(_score_counts(df, label, score), ["threshold"], {"neg_seen": F.col("neg")})
    wins = F.sum(F.col("pos") * (F.col("neg_seen") - F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return seen.agg(F.when(pairs > 0, wins / pairs).alias("auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, from the highest one down."""
    counts = stage(_score_counts(df, label, score), "counts")
    seen = running_totals(counts, [F.desc("threshold")], {"pos_seen": F.col("pos"), "neg_seen": F.col("neg")})
    positives = counts.agg(F.sum("pos")).scalar()
    negatives = counts.agg(F.sum("neg")).scalar()
    return seen.select(
        "threshold",
        safe_ratio("neg_seen", negatives).alias("fpr"),
        safe_ratio("pos_seen", positives).alias("tpr"),
    )


def multiclass_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1.

    The rows collapse to one count per (label, prediction) first; each count
    then adds to the support of its label and to the predictions of its class.
    """
    pairs = df.groupBy(F.col(label).alias("_l"), F.col(prediction).alias("_p")).count()

    def share(cls: str, support: Column, predicted: Column, hit: Column) -> Column:
        return F.struct(
            F.col(cls).alias("cls"), support.alias("support"), predicted.alias("predicted"), hit.alias("hit")
        )

    none, n = F.lit(0).cast("long"), F.col("count")
    hit = F.when(F.col("_l") == F.col("_p"), n).otherwise(none)
    per_class = (
        pairs.select(F.explode(F.array(share("_l", n, none, hit), share("_p", none, n, none))).alias("s"))
        .groupBy("s.cls")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "predicted", "hit")])
        .withColumn("p", safe_ratio("hit", "predicted"))
        .withColumn("r", safe_ratio("hit", "support"))
        .withColumn("f", safe_ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    )

    def weighted(c: str) -> Column:
        return F.sum(F.col("support") * F.col(c)) / F.sum("support")

    return per_class.agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"),
        weighted("p").alias("precision"),
        weighted("r").alias("recall"),
        weighted("f").alias("f1"),
    )


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error over rows with a usable prediction."""
    error = F.col(prediction).cast("double") - F.col(label)
    return drop_nan(df, prediction).agg(F.sqrt(F.avg(error * error)).alias("rmse"))
