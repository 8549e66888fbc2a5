"""Exact, reproducible uniform samples."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import key_text
from ..session import ensure_checkpoint_dir
from ..sources.trips import ORIGIN, read_any

log = logging.getLogger(__name__)

SEED = 42
_DIGITS = 3  # hex digits resolved per counting pass: at most 4,096 groups
_HASH_DIGITS = 32
_SMALL = 100_000


def sample_hash(key_cols: Sequence[str], seed: int = SEED) -> Column:
    """Text that orders rows at random: md5 of the row key and the seed."""
    return F.md5(F.concat(key_text(*key_cols), F.lit(f"@{seed}")))


def sample_exact(
    df: DataFrame, n: int, key_cols: Sequence[str], seed: int = SEED, small: int = _SMALL
) -> DataFrame:
    """Exactly ``n`` rows (all rows when there are fewer): those with the smallest sample hash.

    ``key_cols`` tell rows apart. The result does not depend on partitioning. The cut-off hash
    is found by counting, so the sample itself is a filter over the scan: no sort, no shuffle of rows,
    and a sample of any size stays distributed. The rows are counted first, which a Parquet scan answers
    without its columns; that tells where the cut-off of a uniform hash must lie, and one scan counts the
    hashes below and lists those in that narrow band. Only keys that repeat very often put it elsewhere;
    then hash prefixes are counted instead. Rows that share their whole
    key with the row at the cut-off are told apart by position after a checkpoint.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df.limit(0)
    total = df.count()
    if total <= n:
        if total < n:
            log.warning("only %d rows, %d requested: using all rows", total, n)
        return df
    hashed = df.select(sample_hash(key_cols, seed).alias("h"))
    found = _cutoff_in_band(hashed, n, total, small) or _cutoff(hashed, n, small)
    cutoff, at_cutoff, wanted_at_cutoff = found
    h = sample_hash(key_cols, seed)
    if at_cutoff == wanted_at_cutoff:
        return df.filter(h <= cutoff)
    ensure_checkpoint_dir(df.sparkSession)
    ties = df.filter(h == cutoff).withColumn("__position", F.monotonically_increasing_id()).checkpoint()
    picked = sample_exact(ties, wanted_at_cutoff, ["__position"], seed, small).drop("__position")
    return df.filter(h < cutoff).unionByName(picked)


def _cutoff_in_band(hashed: DataFrame, n: int, total: int, small: int) -> tuple[str, int, int] | None:
    """As ``_cutoff``, by one scan of a band of the hash range that is expected to hold the cut-off.

    None when the band would hold more than ``small`` hashes or doesn't hold the cut-off after all.
    """
    share = n / total
    margin = 8 * math.sqrt(share * (1 - share) / total) + 8 / total
    if 2 * margin * total > small:
        return None
    bounds = [f"{min(max(int(x * 2**60), 0), 2**60 - 1):015x}" for x in (share - margin, share + margin)]
    low, high = (F.lit(b) for b in bounds)
    band = F.when(F.col("h") >= low, F.col("h")).otherwise(F.lit(""))
    counts = hashed.where(F.col("h") <= high).groupBy(band.alias("h")).agg(F.count(F.lit(1)).alias("c"))
    if (rows := counts.limit(4 * small + 2).collect()) and len(rows) > 4 * small + 1:
        return None
    wanted = n
    for h, c in sorted((row.h, row.c) for row in rows):
        if c >= wanted:
            return (h, c, wanted) if h else None
        wanted -= c
    return None


def _cutoff(hashed: DataFrame, n: int, small: int) -> tuple[str, int, int]:
    """The n-th smallest hash, the rows that carry it, and how many of those are wanted.

    Each pass counts the rows per next few hex digits below the prefix found so far, which
    narrows the range 4,096-fold, until few enough rows are left to count them by whole hash.
    The driver receives counts only, at most ``max(4096, small)``. There are more than ``n`` rows.
    """
    prefix, wanted, end = "", n, _DIGITS
    while True:
        inside = hashed.filter(F.col("h").startswith(prefix)) if prefix else hashed
        counts = inside.groupBy(F.substring("h", 1, end).alias("p")).agg(F.count(F.lit(1)).alias("c"))
        pairs = sorted((row.p, row.c) for row in counts.collect())
        for prefix, c in pairs:
            if c >= wanted:
                break
            wanted -= c
        if end == _HASH_DIGITS:
            return prefix, c, wanted
        end = _HASH_DIGITS if c <= small else min(end + _DIGITS, _HASH_DIGITS)


def sample_parquet(spark: SparkSession, source: str, target: str, n: int, seed: int = SEED) -> None:
    """Write a uniform sample of exactly ``n`` rows of a Parquet source with the same schema.

    Rows are told apart by file and position, so copies of a row are separate candidates.
    A missing or empty source is an error.
    """
    if n < 1:
        raise ValueError("n must be positive")
    rows = read_any(spark, source, with_origin=True)
    sample_exact(rows, n, ORIGIN, seed).drop(*ORIGIN).write.parquet(target)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
