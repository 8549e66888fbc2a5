"""Joins against lookup tables whose size the library does not know in advance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``dim`` for broadcast only after counting that it has at most ``max_rows`` rows.

    The count stops at the bound. A larger table comes back unmarked: the join then shuffles
    both sides and AQE splits the partitions of hot keys, which a left join allows.
    """
    rows = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if rows <= max_rows else dim
