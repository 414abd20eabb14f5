"""Joins on triplets and labels.

None of them carries a broadcast hint: Catalyst broadcasts a side whose file
or staged size is small, otherwise both sides are shuffled and adaptive
execution splits the partitions of hot keys (left anti, semi, left and inner
joins all allow the left side to be split).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.operators.aggregates import matched_popularity, song_popularity, user_activity
from tastecore.operators.quantiles import quantile_values
from tastecore.plans.staging import stage


def remove_mismatches(
    triplets: DataFrame, mismatches: DataFrame, accepted: DataFrame | None = None
) -> DataFrame:
    """Drop triplets of mismatched songs; `accepted` songs are kept all the same.

    A null song_id stays, as in NOT EXISTS.
    """
    bad = mismatches.select("song_id")
    if accepted is not None:
        bad = bad.join(accepted.select("song_id"), "song_id", "left_anti")
    return triplets.join(bad, "song_id", "left_anti")


def active_triplets(triplets: DataFrame, q: float = 0.25, mismatches: DataFrame | None = None) -> DataFrame:
    """Drop songs with few plays and users with few songs; triplets of `mismatches` first, if given.

    Both thresholds are the q-quantile of the triplets without mismatches: one round.
    Hot songs and users are above the thresholds by definition, so the two
    lists hold rare keys only. Per-song sums are taken before the mismatches go, so a hot song
    is combined map-side. Per-song and per-user totals are staged because threshold and list
    both need them; the triplets are read three times, so pass a stored table or a filter over one.
    """
    songs = song_popularity(triplets) if mismatches is None else matched_popularity(triplets, mismatches)
    rows = triplets if mismatches is None else remove_mismatches(triplets, mismatches)
    songs = stage(songs, "songs")
    users = stage(user_activity(rows), "users")
    plays, known = quantile_values([(songs, "playcount"), (users, "songcount")], q)
    quiet_songs = songs.filter(F.col("playcount") < plays)
    quiet_users = users.filter(F.col("songcount") < known)
    return rows.join(quiet_songs.select("song_id"), "song_id", "left_anti").join(
        quiet_users.select("user_id"), "user_id", "left_anti"
    )


def complement(df: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose keys are not in test."""
    return df.join(test.select(*keys), list(keys), "left_anti")


def attach_label(features: DataFrame, labels: DataFrame, on: str, label: str) -> DataFrame:
    """Left join and keep labelled rows; Catalyst turns it into an inner join.

    A track with several labels gives several rows.
    """
    return features.join(labels.select(on, label), on, "left").filter(F.col(label).isNotNull())


def pair_rows(predicted: DataFrame, truth: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """Every predicted row with a flag: is the item in the user's truth?

    The list-valued pairing of the analysis in long form: a user without truth
    keeps its rows with hit = false, and no list of a user's items is built.
    """
    known = truth.select(user, item).distinct().withColumn("_hit", F.lit(True))
    return predicted.join(known, [user, item], "left").withColumn("hit", F.col("_hit").isNotNull()).drop("_hit")
