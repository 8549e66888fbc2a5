"""Registered queries over stored state: mixed streams, replayed ingestion, indices and kept statistics."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.features import attribute_stats, with_zones
from ..operators.spacetime import Extent, box_files, key_ranges, read_box, write_clustered
from ..operators.stored_stats import read_stats, store_stats, within_bound
from ..schemas import GREEN, KINDS
from ..session import scratch_dir
from ..sinks.ingest_sinks import TripTables
from ..sources import files
from ..sources.skip_index import build_skip_index, candidate_files, pruned_scan
from ..streaming.live import LiveTotals, observed
from ..streaming.ingest import IngestConfig, run_once
from ..streaming.trips import expired_trips, stream_trips, unified_trips, unify_files
from .catalog import _kept, trips
from .oracle import _VALID
from .testbed import KEYS, SOURCE, raw_trips, table, trip_files, with_ctes, zones

EXTENT = Extent((-74.5, -73.25), (40.25, 41.25), (datetime(1992, 1, 1), datetime(1999, 1, 1)))
BOX = {"lon": (-74.25, -74.0), "lat": (40.5, 40.65625), "time": (datetime(1994, 3, 1), datetime(1995, 9, 30, 12))}
BOX_FILES = 64
ZONE, DAY = 74, (datetime(1995, 1, 1), datetime(1996, 12, 31))
STATS = "VendorID PULocationID DOLocationID trip_distance fare_amount total_amount".split()


def stream_mixed(spark, sf_dir):
    """A stream over files with and without a column and with its counts as bigint or double, stopped and restarted."""
    root = scratch_dir(spark, "mixed")
    keyed = raw_trips(spark, sf_dir, "green", keys=True)

    def drop_in(some: DataFrame) -> None:
        new, old = (some.where(F.col("o_orderkey") % 2 == odd).drop("o_orderkey") for odd in (1, 0))
        new.write.mode("append").parquet(f"{root}/in")
        old = old.drop("cbd_congestion_fee").withColumn("passenger_count", F.col("passenger_count").cast("double"))
        old.write.mode("append").parquet(f"{root}/in")

    for rest in (0, 1):  # the second run goes on from the first one's checkpoint
        drop_in(keyed.where(F.floor(F.col("o_orderkey") / 2) % 2 == rest))
        unify_files(spark, f"{root}/in", "green", f"{root}/table", f"{root}/checkpoint", available_now=True).awaitTermination()
    report = unified_trips(spark, f"{root}/table", "green").groupBy("VendorID").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        F.count("cbd_congestion_fee").alias("with_fee"),
        F.sum("fare_amount").alias("fare_amount"),
    )
    return _kept(report, root)


def stream_expired(spark, sf_dir):
    """Green trips as two streams emit them when they turn 30 days old: files come in by years, the oldest ones last."""
    root, clock = scratch_dir(spark, "expired"), "clock"
    keyed, at = raw_trips(spark, sf_dir, "green", keys=True), F.col(GREEN.pickup)
    year = F.coalesce(F.year(at), F.lit(0))
    for taken in (year == 1994, year > 1995, (year < 1994) | (year == 1995)):  # each run goes on from the one before
        keyed.where(taken).drop("o_orderkey").write.mode("append").parquet(f"{root}/in")
        unify_files(spark, f"{root}/in", GREEN, f"{root}/table", f"{root}/c1", available_now=True, clock_col=clock).awaitTermination()
        old = expired_trips(unified_trips(spark, f"{root}/table", GREEN, True, clock), GREEN.pickup, clock)
        query = old.writeStream.format("parquet").option("checkpointLocation", f"{root}/c2").outputMode("append")
        query.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    report = spark.read.schema(GREEN.trip_schema).parquet(f"{root}/out").groupBy("VendorID").agg(
        F.count(F.lit(1)).alias("trips"), F.max(GREEN.pickup).alias("latest"), F.sum("fare_amount").alias("fare_amount")
    )
    return _kept(report, root)


class Crash(RuntimeError):
    """What a test run raises in the middle of a micro-batch."""


def _crash_after(step: str) -> Callable[[str, int], None]:
    def after(done: str, number: int) -> None:
        if done == step:
            raise Crash(f"after {step} of micro-batch {number}")

    return after


def _stage_halves(spark: SparkSession, sf_dir: str, kind: str, folder: str) -> None:
    """The source rows of a kind as two tables, written by all tasks, ``folder/0`` and ``folder/1``."""
    rows, half = table(spark, sf_dir, SOURCE[kind]), F.pmod(F.xxhash64(KEYS[kind][0]), F.lit(2))
    for number in (0, 1):
        rows.where(half == number).write.option("compression", "zstd").parquet(f"{folder}/{number}/{SOURCE[kind]}.parquet")


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    files.make_dirs(spark, target)
    for file in files.list_files(spark, source):
        files.move_file(spark, file.path, f"{target}/{file.path.rsplit('/', 1)[-1]}")


def _two_files_each(spark: SparkSession, sf_dir: str, folder: str, inbox: str) -> None:
    """Two trip files per kind, each by one task, side by side. The tasks read columns of staged Parquet files: a
    fraction of what trips are when they are shuffled."""

    def write(half: tuple[str, int]) -> None:
        kind, number = half
        trip_files(spark, f"{folder}/{number}", kind).coalesce(1).write.parquet(f"{folder}/{kind}-{number}")

    halves = [(kind, number) for kind in KINDS for number in (0, 1)]
    for kind in KINDS:
        _stage_halves(spark, sf_dir, kind, folder)
    with ThreadPoolExecutor(len(halves)) as pool:
        list(pool.map(write, halves))
    for kind, number in halves:
        _move_files(spark, f"{folder}/{kind}-{number}", inbox)


def ingest_replay(spark, sf_dir):
    """The same folder ingested undisturbed, and with a crash after the sink and one after the ledger: ledger, tables
    and folders of both."""
    root = scratch_dir(spark, "replay")
    _two_files_each(spark, sf_dir, f"{root}/staged", f"{root}/calm/in")
    reports = []
    for run, crashes in (("calm", ()), ("disturbed", ("sink", "ledger"))):
        base = f"{root}/{run}"
        if run == "disturbed":  # the very files that the first run has archived
            _move_files(spark, f"{root}/calm/processed", f"{base}/in")
        tables = TripTables(f"{base}/tables")
        folders = [f"{base}/{name}" for name in ("in", "processed", "error", "ledger", "checkpoint")]
        cfg = IngestConfig(*folders, sink=tables, max_files_per_trigger=1000)
        ended = 0
        for step in crashes:
            try:
                run_once(spark, replace(cfg, after_step=_crash_after(step)))
            except StreamingQueryException:
                ended += 1
        book = metrics.status_totals(run_once(spark, cfg)).select("kind", "status", "files", "records")
        moved = files.listing_frame(spark, f"{base}/processed").count()
        left = files.listing_frame(spark, f"{base}/in").where(F.col("path").endswith(".parquet")).count()
        for kind in KINDS:
            loaded = tables.read(spark, kind).agg(F.count(F.lit(1)).alias("loaded"), F.sum("total_amount").alias("total_amount"))
            reports.append(
                book.where(F.col("kind") == kind)
                .crossJoin(loaded)  # one row each
                .select(F.lit(run).alias("run"), "*", *[F.lit(n).alias(c) for n, c in ((ended, "crashes"), (moved, "moved"), (left, "left_over"))])
            )
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return _kept(report, root)


def indexed_range(spark, sf_dir):
    """Trips picked up in a box of places and times, by the space-time index, and whether under a fifth of the files
    was enough."""
    path = f"{scratch_dir(spark, 'box')}/trips"
    placed = with_zones(trips(spark, sf_dir, "yellow"), zones(spark))
    where = ("pu_lon", "pu_lat", "tpep_pickup_datetime")
    index = write_clustered(placed, path, *where, EXTENT, BOX_FILES)
    used = box_files(index, key_ranges(BOX, EXTENT)).count()
    few = used * 5 < index.select("path").distinct().count()
    found = read_box(spark, path, *where, EXTENT, BOX).groupBy("VendorID").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fare_amount")
    )
    return _kept(found.withColumn("few_files", F.lit(few)), path.rsplit("/", 1)[0])


def skipped_files(spark, sf_dir):
    """Trips of one pickup zone and a range of days: rows by way of the skip index, and files that it left out."""
    path = f"{scratch_dir(spark, 'skip')}/trips"
    laid = trips(spark, sf_dir, "yellow").repartition(40, "PULocationID")
    laid.write.parquet(path)
    columns = ["PULocationID", "tpep_pickup_datetime"]
    index = build_skip_index(spark, path, columns, bloom=["PULocationID"])
    index.write.parquet(f"{path}-index")
    index = spark.read.parquet(f"{path}-index")
    criteria = {"PULocationID": ZONE, "tpep_pickup_datetime": DAY}
    total, used = index.select("path").distinct().count(), candidate_files(index, criteria).count()
    found = pruned_scan(spark, path, index, criteria).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fare_amount")
    )
    return _kept(found.withColumn("most_skipped", F.lit((total - used) * 5 >= total * 4)), path.rsplit("/", 1)[0])


def stored_stats(spark, sf_dir):
    """Attribute statistics of three appends, united from what each stored, beside exact distinct counts."""
    folder = scratch_dir(spark, "stats")
    keyed = trips(spark, sf_dir, "green", keys=True)
    for append in range(3):
        store_stats(keyed.where(F.col("o_orderkey") % 3 == append), STATS, folder, append)
    store_stats(keyed.where(F.col("o_orderkey") % 3 == 2), STATS, folder, 2)  # a replay of the last one
    exact = attribute_stats(keyed, STATS, exact=True).select("attribute", F.col("distinct_values").alias("exact"))
    report = read_stats(spark, folder, (0.5,)).join(exact, "attribute")
    return _kept(
        report.select("attribute", "rows", "non_null", "low", "high", "exact", within_bound("distinct_values", "exact").alias("within_bound")),
        folder,
    )


def live_totals(spark, sf_dir):
    """What a listener saw of two running streams, kind by kind, beside the rows that they wrote."""
    root = scratch_dir(spark, "live")
    seen = LiveTotals()
    spark.streams.addListener(seen)
    try:
        for kind in KINDS:
            dropped = trip_files(spark, sf_dir, kind)
            # As many files as the input has parts, half of them per micro-batch: no task gets more as the tables grow.
            dropped.repartition(max(4, dropped.rdd.getNumPartitions())).write.parquet(f"{root}/{kind}/in")
            n_files = len([f for f in files.list_files(spark, f"{root}/{kind}/in") if files.is_parquet_name(f.path)])
            query = (
                observed(stream_trips(spark, f"{root}/{kind}/in", kind, max_files_per_trigger=-(-n_files // 2)), kind)
                .writeStream.format("parquet")
                .option("checkpointLocation", f"{root}/{kind}/checkpoint")
                .trigger(availableNow=True)
                .start(f"{root}/{kind}/out")
            )
            query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(seen)
    written = None
    for kind, spec in KINDS.items():
        part = spark.read.schema(spec.trip_schema).parquet(f"{root}/{kind}/out").agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("written")
        )
        written = part if written is None else written.unionByName(part)
    return _kept(seen.totals(spark).drop("trips_per_second").join(written, "kind"), root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (stream_mixed, stream_expired, ingest_replay, indexed_range, skipped_files, stored_stats, live_totals)
}


def _stamp(moment: datetime) -> str:
    return f"timestamp '{moment:%Y-%m-%d %H:%M:%S}'"


def _between(column: str, pair, show=str) -> str:
    return f"{column} between {show(pair[0])} and {show(pair[1])}"


_SQL = {
    "stream_mixed": """select VendorID, count(*) as trips, sum(passenger_count)::bigint as passengers,
        count(*) filter (o_orderkey % 2 = 1) as with_fee, sum(fare_amount) as fare_amount
      from green_trips group by VendorID""",
    "stream_expired": """select VendorID, count(*) as trips, max(lpep_pickup_datetime) as latest, sum(fare_amount) as fare_amount
      from green_trips, (select max(lpep_pickup_datetime) - interval 30 day as since from green_trips)
      where lpep_pickup_datetime < since or lpep_pickup_datetime is null group by VendorID""",
    "ingest_replay": " union all ".join(
        f"select '{run}' as run, '{kind}' as kind, 'processed' as status, 2::bigint as files, count(*) as records,"
        f" count(*) as loaded, sum(total_amount) as total_amount, {crashes} as crashes, 4 as moved, 0 as left_over"
        f" from {kind}_trips"
        for run, crashes in (("calm", 0), ("disturbed", 2))
        for kind in ("yellow", "green")
    ),
    "indexed_range": f"""select VendorID, count(*) as trips, sum(fare_amount) as fare_amount, true as few_files
      from yellow_trips t join zones p on t.PULocationID = p.zone_id
      where {_between('p.lon', BOX['lon'])} and {_between('p.lat', BOX['lat'])}
        and {_between('tpep_pickup_datetime', BOX['time'], _stamp)} group by VendorID""",
    "skipped_files": f"""select count(*) as trips, sum(fare_amount) as fare_amount, true as most_skipped
      from yellow_trips where PULocationID = {ZONE} and {_between('tpep_pickup_datetime', DAY, _stamp)}""",
    "live_totals": " union all ".join(
        f"select '{kind}' as kind, 2::bigint as batches, count(*) as trips, count(*) filter ({_VALID[kind]}) as valid_trips,"
        f" sum(total_amount) as total_amount, count(*) as written from {kind}_trips"
        for kind in ("yellow", "green")
    ),
    "stored_stats": " union all ".join(
        f"select '{c}' as attribute, count(*) as rows, count({c}) as non_null, min({c})::double as low,"
        f" max({c})::double as high, count(distinct {c}) as exact, true as within_bound from green_trips"
        for c in STATS
    ),
}
ORACLE = {name: with_ctes(sql) for name, sql in _SQL.items()}
