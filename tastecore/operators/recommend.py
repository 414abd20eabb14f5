"""ALS on (user, item, rating)."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.functions import project_items
from tastecore.operators.aggregates import top_rows
from tastecore.plans.staging import stage

FIRST_ITEMS = 4_096


def train_als(training: DataFrame, seed: int = 1, blocks: int = 10, **params) -> ALSModel:
    """Explicit ratings. Train on rows read from a (staged) table, so that a lost task rereads the same rows.

    Users and items are cut into `blocks` each. The model depends on their number, so it
    is an argument, not taken from the cluster; raise it with the data.
    """
    als = ALS(userCol="user", itemCol="item", ratingCol="rating", seed=seed, **params)
    return als.setNumBlocks(blocks).fit(training)


def _dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def best_products(users: DataFrame, items: DataFrame, k: int, first_items: int = FIRST_ITEMS) -> DataFrame:
    """(user, position, item, score): the k largest inner products for each of a bounded set of users, exact.

    `users` and `items` hold (id, features). By Cauchy and Schwarz an item scores norm x norm at most. The
    `first_items` of the largest norms are scored first, which gives every user a score to beat; of the others
    only those are read, and only for the users, whose bound reaches it. Ties go to the smaller item.

    The users travel as one array to the tasks that read the items, so no product of the two tables is made; take
    more users than fit there (some thousands) in several calls.
    """
    norms = {"norm": F.sqrt(_dot("features", "features"))}
    asked = stage(users.withColumns(norms), "users")
    ranked = stage(items.withColumns(norms), "items")

    def scored(block: DataFrame, beat: DataFrame) -> DataFrame:
        known = asked.join(beat, asked.id == beat.user, "left").select("id", "features", "norm", "score")
        listed = known.agg(F.collect_list(F.struct("*"))).scalar()
        # Slightly more than the bound, for rounding.
        may_beat = F.filter("asked", lambda u: u.score.isNull() | (u.norm * F.col("norm") * F.lit(1 + 1e-9) >= u.score))
        pairs = block.withColumn("asked", listed).select("id", "features", F.explode(may_beat).alias("u"))
        products = pairs.select(F.col("u.id").alias("user"), F.col("id").alias("item"), _dot("u.features", "features").alias("score"))
        return top_rows(products, "user", [F.desc("score"), "item"], k)

    order = [F.desc("norm"), F.asc("id")]
    largest = stage(ranked.orderBy(*order).limit(first_items), "largest")
    found = stage(scored(largest, asked.select(F.col("id").alias("user"), F.lit(None).cast("double").alias("score"))), "first")
    beat = stage(found.filter(F.col("position") == k).select("user", "score"), "beat")
    last = largest.orderBy(F.asc("norm"), F.desc("id")).select(F.struct((-F.col("norm")).alias("norm"), "id")).limit(1).scalar()
    rest = ranked.filter(F.struct((-F.col("norm")).alias("norm"), "id") > last)
    # The least norm that any user still asks for reaches the scan as a plain filter; null: everything.
    asking = asked.join(beat, asked.id == beat.user, "left").select(F.when(F.col("score") > 0, F.col("score") / F.col("norm")).otherwise(0.0).alias("least"))
    rest = rest.filter(F.col("norm") * F.lit(1 + 1e-9) >= F.coalesce(asking.agg(F.min("least")).scalar(), F.lit(0.0)))
    both = found.drop("position").unionByName(scored(rest, beat).drop("position"))
    return top_rows(both, "user", [F.desc("score"), "item"], k).select("user", "position", "item", "score")


def recommend_rows(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """(user, position, item, score): the k best items of a bounded set of users; training items are not excluded."""
    asked = model.userFactors.join(users.select(F.col("user").alias("id")).distinct(), "id", "left_semi")
    return best_products(asked, model.itemFactors, k)


def recommend(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """(user, recommends): the same as one array of items per user."""
    listed = F.sort_array(F.collect_list(F.struct("position", "item")))
    return recommend_rows(model, users, k).groupBy("user").agg(project_items(listed).alias("recommends"))


def predict_ratings(model: ALSModel, test: DataFrame) -> DataFrame:
    """Scores for known pairs; a user or item unseen in training gets NaN."""
    return model.transform(test)
