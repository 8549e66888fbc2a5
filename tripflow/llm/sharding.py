"""Sharding by rendezvous hashing: a record goes to the shard that scores highest for its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, unit_interval
from .ranks import gapless_rank

SHARDS = 40


def shard_scores(key: Column, weights: Sequence[float]) -> Column:
    """One (score, -shard) per shard. The score ``-weight / ln(u)``, with ``u`` drawn by hashing key and
    shard, is largest for a shard with a probability in proportion to its weight."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    shards = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])
    return F.transform(
        shards,
        lambda s: F.struct(
            (-s["weight"] / F.ln(unit_interval(F.xxhash64(key, s["id"])))).alias("score"), (-s["id"]).alias("shard")
        ),
    )


def best_shard(scores: Column, shards: int) -> Column:
    """The best of the first ``shards`` shards; of equal scores, the lowest shard."""
    return (-F.array_max(F.slice(scores, 1, shards))["shard"]).cast("int")


def assign_shards(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, key: str = "doc_id", name: str = "shard"
) -> DataFrame:
    """``docs`` with the shard of each row, an expression of the scan: no shuffle.

    Only the key, the shard's number and its weight decide. One more shard takes rows only into itself;
    a heavier weight takes rows only into that shard. Rows with equal keys share a shard, rows without a
    key too. An existing column called ``name`` is replaced; texts are not looked at.
    """
    return docs.withColumn(name, best_shard(shard_scores(F.xxhash64(F.col(key)), weights), len(weights)))


def op8_sharding(spark, sf_dir):
    """Every document's shard of 40, its place in the shard, and its shard if there were 41.

    A null text has size 16 and checksum 0. Places follow doc_id within a shard; equal rows get
    distinct places.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    scored = docs.withColumn("scores", shard_scores(F.xxhash64("doc_id"), [1.0] * (SHARDS + 1)))
    placed = scored.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        best_shard(F.col("scores"), SHARDS).alias("shard"),
        best_shard(F.col("scores"), SHARDS + 1).alias("grown_shard"),
    )
    return gapless_rank(placed, "shard", ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
