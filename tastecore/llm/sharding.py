"""Weighted rendezvous hashing of stable record keys, with DataFrame operations only.

Every shard scores every key with a hash of both, u in (0, 1), as -weight / ln(u); the highest score has the
record. A shard that is added or removed, or whose weight changes, changes no other shard's scores: records
move only into a shard that grew and only out of one that shrank. Shares of the keys follow the weights.

The hash is the first 13 hexadecimal digits of md5('salt|shard|key'), so any engine finds the same shards.

Slots number a shard's rows without gaps, in order of the key, then of the columns in `order`, whatever the
partitioning. No shard passes through one task: rows are range sorted by shard and key, and each sorted
chunk is shifted by the rows that the shard has in the chunks before.

Edge cases: all null keys are one key; a repeated key has one shard and as many slots as rows; a shard without
rows has no row in the result; weights have to be above 0; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastecore.plans.ordering import CHUNK, POSITION, sorted_chunks
from tastecore.plans.staging import stage

DIGITS = 13


def scores(key: Column, weights: Mapping[int, float], salt: str = "shard") -> Column:
    """An array of (score, shard), one for each shard."""
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("every shard needs a weight above 0")
    shards = F.array(*[F.struct(F.lit(int(s)).alias("shard"), F.lit(float(w)).alias("weight")) for s, w in sorted(weights.items())])
    text = F.coalesce(key.cast("string"), F.lit("\u0000"))

    def score(own: Column) -> Column:
        digest = F.md5(F.concat_ws("|", F.lit(salt), own.getField("shard").cast("string"), text))
        number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
        u = (number + F.lit(0.5)) / F.lit(float(16**DIGITS))
        # Equal scores: the smaller shard.
        return F.struct((-own.getField("weight") / F.ln(u)).alias("score"), (-own.getField("shard")).alias("other"))

    return F.transform(shards, score)


def shard_of(key: Column, weights: Mapping[int, float], salt: str = "shard") -> Column:
    """The shard with the highest score."""
    return (-F.array_max(scores(key, weights, salt)).getField("other")).cast("int")


def equal_shards(count: int) -> dict[int, float]:
    return {s: 1.0 for s in range(count)}


def with_shards(df: DataFrame, key: str, weights: Mapping[int, float], grown: Mapping[int, float] | None = None, salt: str = "shard") -> DataFrame:
    """`df` with `shard`, and `grown_shard`: the one under the weights `grown`, if given, else null."""
    later = F.lit(None).cast("int") if grown is None else shard_of(F.col(key), grown, salt)
    return df.withColumns({"shard": shard_of(F.col(key), weights, salt), "grown_shard": later})


def with_slots(sharded: DataFrame, order: Sequence[str]) -> DataFrame:
    """`sharded` with `slot`: rows of a shard from 0 without gaps, by the columns in `order`."""
    # Equal rows are spread by their place in the input; which of them gets which slot makes no difference.
    spread = sharded.withColumn("_spread", F.monotonically_increasing_id())
    chunks = sorted_chunks(spread, ["shard", *[F.col(c).asc_nulls_first() for c in order], "_spread"])
    own = chunks.groupBy("shard", CHUNK).agg(F.min(POSITION).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # One row per shard and sorted chunk that holds it: as many as chunks and shards together.
    before = Window.partitionBy("shard").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    shifts = own.select("shard", CHUNK, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = chunks.join(shifts, ["shard", CHUNK])
    return placed.select(*sharded.columns, (F.col(POSITION) + F.col("_shift")).alias("slot"))


def shard_documents(docs: DataFrame, weights: Mapping[int, float], grown: Mapping[int, float] | None = None, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: bytes of the text (none if null) and `overhead`. law: `key`, as doc_id and the shards alone decide.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    # Stored, as the range sort reads them twice: the texts are read and the keys scored once.
    sharded = stage(with_shards(rows, "doc_id", weights, grown), "sharded")
    placed = with_slots(sharded, ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
