"""Ranking metrics on long rows: predicted (user, position, item), truth (user, item).

Only the recommendation lists are ranked per user, and those have a fixed
length; the truth side is never gathered into lists.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastecore.functions import safe_ratio
from tastecore.operators.joins import pair_rows


def user_ranking(predicted: DataFrame, truth: DataFrame, k: int, k_ndcg: int | None = None) -> DataFrame:
    """precision@k, NDCG@k_ndcg and average precision per predicted user.

    Relevance is binary. Precision divides by k even if fewer items were
    predicted; the ideal DCG stops at the smaller of truth size and k_ndcg;
    a user without truth scores 0 everywhere.
    """
    k_ndcg = k if k_ndcg is None else k_ndcg
    gains = [1 / math.log2(place + 1) for place in range(1, k_ndcg + 1)]
    ideals = F.array(*[F.lit(sum(gains[:n])) for n in range(1, k_ndcg + 1)])
    hit, position = F.col("hit"), F.col("position")
    # A recommendation list per partition, so as long as the list at most.
    so_far = (
        Window.partitionBy("user").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    paired = pair_rows(predicted, truth).withColumn("_hits", F.count_if(hit).over(so_far))
    gain = F.when(hit & (position <= k_ndcg), 1 / F.log2(position + 1)).otherwise(0.0)
    scored = paired.groupBy("user").agg(
        F.count_if(hit & (position <= k)).alias("_top"),
        F.sum(gain).alias("_dcg"),
        F.sum(F.when(hit, F.col("_hits") / position).otherwise(0.0)).alias("_precisions"),
    )
    sizes = truth.select("user", "item").distinct().groupBy("user").agg(F.count(F.lit(1)).alias("_truth"))
    size = F.coalesce(F.col("_truth"), F.lit(0))
    ideal = F.when(size > 0, F.element_at(ideals, F.least(size, F.lit(k_ndcg)).cast("int"))).otherwise(0.0)
    return scored.join(sizes, "user", "left").select(
        "user",
        (F.col("_top") / F.lit(float(k))).alias("precision_at_k"),
        safe_ratio("_dcg", ideal).alias("ndcg_at_k"),
        safe_ratio("_precisions", size).alias("average_precision"),
    )


def ranking_metrics(predicted: DataFrame, truth: DataFrame, k: int, k_ndcg: int | None = None) -> DataFrame:
    """Means over the predicted users: precision_at_k, ndcg_at_k, map."""
    return user_ranking(predicted, truth, k, k_ndcg).agg(
        F.avg("precision_at_k").alias("precision_at_k"),
        F.avg("ndcg_at_k").alias("ndcg_at_k"),
        F.avg("average_precision").alias("map"),
    )
