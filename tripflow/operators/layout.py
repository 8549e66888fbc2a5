"""Partition counts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, parts: int | None) -> DataFrame:
    """``df`` in ``parts`` partitions, or as it is when that is None.

    For work that costs far more per row than moving the row does, such as making and parsing documents,
    over a file of few row groups. Files of many row groups are better split by
    ``spark.sql.files.maxPartitionBytes``, without a shuffle.
    """
    return df if parts is None else df.repartition(parts)
