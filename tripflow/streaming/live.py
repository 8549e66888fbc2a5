"""Totals of running streams, from what Spark observes in each micro-batch."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.rules import is_valid
from ..schemas import TripKind, kind_of

TOTALS_SCHEMA = (
    "query_id string, kind string, batch_id long, trips long, valid_trips long, total_amount double, seconds double"
)


def observed(trips: DataFrame, kind: str | TripKind) -> DataFrame:
    """``trips`` with counts and sums taken along the way, by the tasks that pass the rows on: no job of their own."""
    kind = kind_of(kind)
    return trips.observe(
        f"trips-{kind.name}",
        F.count(F.lit(1)).alias("trips"),
        F.count(F.when(is_valid(kind), 1)).alias("valid_trips"),
        F.sum("total_amount").alias("total_amount"),
    )


class LiveTotals(StreamingQueryListener):
    """Gathers what ``observed`` counts, per stream, kind and micro-batch, while streams run.

    A micro-batch that is repeated replaces its numbers. The listener holds one row of numbers per micro-batch, and
    no more than ``most`` of them apart: older ones of a stream and kind are added up in one row.
    """

    def __init__(self, most: int = 10_000):
        self._lock = threading.Lock()
        self._rows: dict[tuple[str, str], dict[int, tuple]] = {}
        self._most = most

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if not name.startswith("trips-"):
                continue
            numbers = (row["trips"] or 0, row["valid_trips"] or 0, row["total_amount"] or 0.0, progress.batchDuration / 1000)
            with self._lock:
                kept = self._rows.setdefault((str(progress.id), name.removeprefix("trips-")), {})
                kept[progress.batchId] = numbers
                if len(kept) > self._most:
                    first, second = sorted(kept)[:2]
                    older = kept.pop(first)
                    kept[second] = tuple(a + b for a, b in zip(older, kept[second]))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        """The numbers so far: ``query_id, kind, batch_id, trips, valid_trips, total_amount, seconds``."""
        with self._lock:
            rows = [(*key, batch, *numbers) for key, kept in self._rows.items() for batch, numbers in kept.items()]
        return spark.createDataFrame(rows, TOTALS_SCHEMA)

    def totals(self, spark: SparkSession) -> DataFrame:
        """By kind: micro-batches, trips, valid trips, amount, and trips per second of processing."""
        return (
            self.frame(spark)
            .groupBy("kind")
            .agg(
                F.count(F.lit(1)).alias("batches"),
                F.sum("trips").alias("trips"),
                F.sum("valid_trips").alias("valid_trips"),
                F.sum("total_amount").alias("total_amount"),
                (F.sum("trips") / F.nullif(F.sum("seconds"), F.lit(0.0))).alias("trips_per_second"),
            )
        )
