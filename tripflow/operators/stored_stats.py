"""Attribute statistics that are kept: sketches of each append are stored, and united when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files

# log2 of the HLL sketch's buckets, and the sizes of the quantile sketch.
HLL_BITS = 12
KLL_SIZE = 200
# Three standard errors of a distinct count with that many buckets.
DISTINCT_BOUND = 3 * 1.04 / (1 << HLL_BITS) ** 0.5
_PLAIN = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _number(column: str, dtype: T.DataType):
    if isinstance(dtype, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.lit(None).cast("double")


def batch_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per attribute: rows, non-null values, bounds, a sketch of different values and one of quantiles.

    Everything comes from one scan with partial aggregation; sketches have a bounded size. Bounds and quantiles are
    numbers, of datetimes their microseconds; text has none.
    """
    packed = []
    for name in columns:
        dtype = df.schema[name].dataType
        number = _number(name, dtype)
        value = F.col(name) if isinstance(dtype, _PLAIN) else F.col(name).cast("string")
        packed.append(
            F.struct(
                F.lit(name).alias("attribute"),
                F.count(F.lit(1)).alias("rows"),
                F.count(name).alias("non_null"),
                F.min(number).alias("low"),
                F.max(number).alias("high"),
                F.hll_sketch_agg(value, F.lit(HLL_BITS)).alias("different"),
                F.kll_sketch_agg_double(number, F.lit(KLL_SIZE)).alias("quantiles"),
            )
        )
    return df.agg(F.array(*packed).alias("rows")).select(F.inline("rows"))


def store_stats(df: DataFrame, columns: Sequence[str], folder: str, batch_id: int | str) -> None:
    """Add the statistics of one append. The same ``batch_id`` again replaces its own, so a replay doesn't count twice."""
    batch_stats(df, columns).coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch_id}")


def read_stats(spark: SparkSession, folder: str, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """The statistics of all appends together: ``attribute, rows, non_null, low, high, distinct_values`` and one column
    per quantile. Only stored rows are read, a few per append, never the data."""
    if not files.exists(spark, folder):
        raise FileNotFoundError(f"there is no {folder}")
    stored = spark.read.parquet(folder)
    merged = stored.groupBy("attribute").agg(
        F.sum("rows").alias("rows"),
        F.sum("non_null").alias("non_null"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("different")).alias("distinct_values"),
        F.kll_merge_agg_double("quantiles").alias("sketch"),
    )
    shown = [
        F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(f"q{round(q * 100)}")
        for q in quantiles
    ]
    return merged.select("attribute", "rows", "non_null", "low", "high", "distinct_values", *shown)


def compact_stats(spark: SparkSession, folder: str, into: str) -> None:
    """Write the appends' statistics as one row per attribute to another folder, with the same sketches."""
    stored = spark.read.parquet(folder)
    stored.groupBy("attribute").agg(
        F.sum("rows").alias("rows"),
        F.sum("non_null").alias("non_null"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("different").alias("different"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    ).write.parquet(f"{into.rstrip('/')}/batch=united")


def within_bound(estimate: str, exact: str):
    """Whether an estimated distinct count is within the sketch's bound of the exact one, one value at least."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), F.col(exact) * F.lit(DISTINCT_BOUND))
