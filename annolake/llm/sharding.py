"""Rendezvous hashing of record keys over weighted shards.

Every (key, shard) pair gets a score ``-weight / ln(u)``, where ``u`` in (0, 1) comes from the
hash of the key and the shard number; the shard with the highest score takes the row.  Scores
of the old shards do not change when a shard is added, so rows move only into the new shard,
about ``weight / total weight`` of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import table, text_or_empty
from annolake.operators.ordered import with_rank

SHARDS = 16
_UNIT = 2**53


def _score(key: Column, shard: int, weight: float) -> Column:
    bits = F.xxhash64(F.concat(key, F.lit(f":{shard}"))).bitwiseAND(F.lit(_UNIT - 1))
    unit = (bits.cast("double") + F.lit(0.5)) / F.lit(float(_UNIT))
    return F.lit(-float(weight)) / F.log(unit)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0-based) that takes ``key``; a null key counts as the empty string.

    A shard of weight 0 takes nothing.  Equal scores go to the larger shard number.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [
        F.struct(_score(text, shard, weight).alias("score"), F.lit(shard).alias("shard"))
        for shard, weight in enumerate(weights)
        if weight > 0
    ]
    if not scores:
        raise ValueError("no shard has a weight above zero")
    return F.array_max(F.array(*scores))["shard"]


def assign_shards(
    df: DataFrame, key: str, weights: Sequence[float], added: Sequence[float] = (1.0,)
) -> DataFrame:
    """Add ``shard``, ``slot`` (gapless from 0 within the shard, in key order) and ``grown_shard``,
    the shard once shards of the weights in ``added`` exist too.

    Rows with a null key all meet in one shard; repeated rows share their shard and take a slot
    each.  Columns of these three names in the input are replaced.  An empty table gives an
    empty one.  Only hashes of the key decide, so a hot key is as large as its rows are; slots
    are ranked over range chunks, never by one task per shard.
    """
    plain = df.drop("shard", "slot", "grown_shard")
    placed = plain.select(
        "*",
        rendezvous_shard(F.col(key), weights).alias("shard"),
        rendezvous_shard(F.col(key), [*weights, *added]).alias("grown_shard"),
    )
    others = [F.xxhash64(*[F.col(c) for c in plain.columns])]
    ranked = with_rank(placed, ["shard"], [key, *others], "_rank")
    return ranked.withColumn("slot", F.col("_rank") - 1).drop("_rank")


def op2_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty()
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return assign_shards(rows, "doc_id", [1.0] * SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op2_rendezvous_sharding": op2_rendezvous_sharding}
ORACLES: dict[str, str] = {}
