"""Gapless numbering and running sums, without a task that sees a whole group or table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, fresh


def gapless_rank(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: the place of each row in its group, from 0, by ``order``.

    The rows are range-partitioned by group, order and physical position, so that neither a large
    group nor equal rows meet in one task. Each partition then adds the number of rows that earlier
    partitions hold of the group. ``group`` must not be null. Meant for narrow rows: they are stored
    twice. Equal rows get distinct places in no particular order.
    """
    tie, part, at, first, rows, before = fresh(df, "tie", "part", "at", "first", "rows", "before")
    keys = [group, *order, tie]
    laid = checkpointed(df).withColumn(tie, F.monotonically_increasing_id())
    laid = checkpointed(laid.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie))
    placed = laid.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id())
    starts = placed.groupBy(group, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(rows))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn(before, F.coalesce(F.sum(rows).over(earlier), F.lit(0)))
    return placed.join(starts, [group, part]).select(
        *df.columns, (F.col(before) + F.col(at) - F.col(first)).alias(name)
    )


def running_start(df: DataFrame, group: list[str], order: list[str], value: str, name: str, fan: int = 512) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before each row, by ``group`` and ``order``.

    Groups must be bounded (files): their rows are summed in one task each. Their totals are range-partitioned
    and summed by partition; one row per partition, at most ``fan``, is all that a single task sees. ``value``
    must not be null. Give it stored rows.
    """
    total, part, at, before, inside = fresh(df, "total", "part_no", "at", "before", "inside")
    totals = df.groupBy(*group).agg(F.sum(value).alias(total)).repartitionByRange(fan, *group).sortWithinPartitions(*group)
    totals = checkpointed(totals.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.groupBy(part).agg(F.sum(total).alias(before))
    parts = parts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    up_to = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.join(parts, part).withColumn(before, F.col(before) + F.coalesce(F.sum(total).over(up_to), F.lit(0)))
    in_group = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn(inside, F.coalesce(F.sum(value).over(in_group), F.lit(0)))
    return rows.join(starts.select(*group, before), group).select(*df.columns, (F.col(before) + F.col(inside)).alias(name))
