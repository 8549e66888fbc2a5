"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows stored in the shared checkpoint folder: computed once, safe from lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have yet, made from ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def unit_interval(hashed: Column) -> Column:
    """A 64-bit hash as a double strictly between 0 and 1."""
    return (F.shiftrightunsigned(hashed, 11) + F.lit(0.5)) * F.lit(2.0**-53)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """True where labels may be learned from: a row without an id is neither held out nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


def bounded_sample(df: DataFrame, key: list[str], most: int) -> DataFrame:
    """At most ``most`` rows, those whose ``key`` has the lowest hashes, the same ones at every run.

    Rows are counted and thinned by hash first, so that what is sorted is bounded too. Give it stored rows.
    """
    (draw,) = fresh(df, "draw")
    n = df.count()
    thinned = df.withColumn(draw, F.xxhash64(*key)).where(unit_interval(F.col(draw)) * max(n, 1) < 3.0 * most)
    return thinned.orderBy(draw, *key).limit(most).drop(draw)
