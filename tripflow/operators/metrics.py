"""Counters, rates and timers as aggregates over the ingestion ledger and sink results.

The ledger has one row per ingested file (``schemas.LEDGER_SCHEMA``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import micros_between

PROCESSED = "processed"
TOTAL = "total"


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per named frame, in one job. Each frame is counted on its own, by its tasks, before one row of
    it is shuffled; a Parquet scan reads no column for that. An empty frame has a count of 0."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Files handled, processed and errored, and records loaded, by kind and in total."""
    kind = F.coalesce("kind", F.lit("unknown"))
    processed = F.col("status") == PROCESSED
    totals = ledger.select(kind.alias("kind"), "status", "records").rollup("kind")
    return totals.agg(
        F.grouping("kind").alias("__all"),
        F.count(F.lit(1)).alias("files"),
        F.count_if(processed).alias("files_processed"),
        F.count_if(~processed).alias("files_errored"),
        F.coalesce(F.sum(F.when(processed, F.col("records"))), F.lit(0)).alias("records"),
    ).select(
        F.when(F.col("__all") == 1, F.lit(TOTAL)).otherwise(F.col("kind")).alias("kind"),
        "files",
        "files_processed",
        "files_errored",
        "records",
    )


def status_totals(ledger: DataFrame) -> DataFrame:
    """Files and records by kind and status (the status of a quarantined file is its reason)."""
    return ledger.groupBy("kind", "status").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("records"), F.lit(0)).alias("records")
    )


def ledger_rates(ledger: DataFrame, window: str = "1 minute") -> DataFrame:
    """Records and records per second by kind in tumbling windows of the finish time."""
    windowed = ledger.groupBy(F.window("finished_at", window).alias("w"), "kind").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("records"), F.lit(0)).alias("records")
    )
    seconds = (F.col("w.end") - F.col("w.start")).cast("bigint")
    return windowed.select(
        F.col("w.start").alias("window_start"),
        "kind",
        "files",
        "records",
        (F.col("records") / seconds).alias("records_per_second"),
    )


def timer_stats(ledger: DataFrame) -> DataFrame:
    """Processing time by kind: count, total and longest, in seconds."""
    return (
        ledger.select("kind", micros_between("started_at", "finished_at").alias("us"))
        .groupBy("kind")
        .agg(
            F.count("us").alias("timed"),
            (F.sum("us") / F.lit(1e6)).alias("total_seconds"),
            (F.max("us") / F.lit(1e6)).alias("max_seconds"),
        )
    )


def sink_totals(results: DataFrame) -> DataFrame:
    """Sink requests by index: operations, successes, failures and documents accepted."""
    return results.groupBy("index").agg(
        F.count(F.lit(1)).alias("operations"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n_docs"))), F.lit(0)).alias("documents"),
    )
