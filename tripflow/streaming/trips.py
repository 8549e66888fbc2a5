"""Continuous typed trips and windowed rates over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from ..functions.coerce import epoch_micros, from_epoch_micros
from ..operators.normalize import normalize
from ..operators.selection import RETENTION_DAYS
from ..schemas import TripKind, kind_of
from ..sources import files
from ..sources.trips import read_listed

LISTING = "path string, modificationTime timestamp, length bigint, content binary"
FILES_PER_TRIGGER = 1000
# The file source forgets files older than the newest one by more than this.
MAX_FILE_AGE = "36500d"


def stream_trips(
    spark: SparkSession, directory: str, kind: str | TripKind, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Typed trips from a folder that receives files of one kind and one schema.

    The stream is read with the kind's file schema; a file of other types ends it. ``unify_files`` takes such files.
    """
    kind = kind_of(kind)
    reader = spark.readStream.schema(kind.file_schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return normalize(reader.parquet(directory), kind)


def unify_files(
    spark: SparkSession,
    directory: str,
    kind: str | TripKind,
    table_dir: str,
    checkpoint_dir: str,
    *,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
    available_now: bool = False,
    trigger_seconds: int = 30,
    change: Callable[[DataFrame], DataFrame] | None = None,
    clock_col: str | None = None,
) -> StreamingQuery:
    """Follow a folder of files of one kind but of unlike schemas, and append their typed trips to a table.

    The stream is one of paths. Tasks read the footers of a micro-batch's files, and each schema among them gets
    one scan, so types and optional columns may change from file to file. Every micro-batch is a folder of
    ``table_dir``; one that was completed is not written again when the stream repeats it after a restart, one that
    was not is replaced. The table has one schema, so it can be streamed from in turn (``unified_trips``).
    ``change`` is applied to the trips before they are written, such as a filter. ``clock_col`` adds the latest
    pickup among the files taken so far, the same for all trips of a micro-batch. A file without a readable footer
    fails the micro-batch; folders where such files turn up are a case for ingestion, which moves them away.
    """
    kind = kind_of(kind)
    files.make_dirs(spark, directory)
    files.make_dirs(spark, table_dir)
    paths = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", MAX_FILE_AGE)
        .option("pathGlobFilter", "*.parquet")
        .load(directory)
        .select("path")
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        target = f"{table_dir.rstrip('/')}/batch={batch_id}"
        listed = [r.path for r in batch.collect()]
        if not listed or files.exists(batch.sparkSession, f"{target}/_SUCCESS"):
            return
        trips = read_listed(batch.sparkSession, listed, kind)
        if clock_col:
            trips = trips.withColumn(clock_col, F.lit(_advance_clock(trips, kind, table_dir, batch_id)))
        (change(trips) if change else trips).write.mode("overwrite").parquet(target)

    writer = paths.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_dir)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{trigger_seconds} seconds"}
    return writer.trigger(**trigger).start()


def _advance_clock(trips: DataFrame, kind: TripKind, table_dir: str, batch_id: int) -> Column:
    """The latest pickup up to this micro-batch, kept beside the table; a repeated micro-batch gets the same one."""
    spark, folder = trips.sparkSession, f"{table_dir.rstrip('/')}/_clock"
    latest = trips.agg(F.max(kind.pickup).alias("at"))
    if batch_id and files.exists(spark, f"{folder}/{batch_id - 1}/_SUCCESS"):
        latest = latest.unionByName(spark.read.schema(latest.schema).parquet(f"{folder}/{batch_id - 1}")).agg(F.max("at").alias("at"))
    latest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{batch_id}")
    if batch_id > 1:
        files.delete_tree(spark, f"{folder}/{batch_id - 2}")
    at = spark.read.schema(latest.schema).parquet(f"{folder}/{batch_id}").first().at
    return F.lit(at).cast("timestamp_ntz")


def unified_trips(
    spark: SparkSession, table_dir: str, kind: str | TripKind, stream: bool = False, clock_col: str | None = None
) -> DataFrame:
    """The trips that ``unify_files`` has written, at once or as a stream."""
    reader = spark.readStream if stream else spark.read
    schema = StructType([*kind_of(kind).trip_schema.fields, *([StructField(clock_col, TimestampNTZType())] if clock_col else [])])
    return reader.schema(schema).parquet(table_dir).drop("batch")


def expired_trips(trips: DataFrame, time_col: str, clock_col: str, days: int = RETENTION_DAYS) -> DataFrame:
    """A stream of the trips that have turned older than ``days``: each is emitted once, when its time has come.

    What ``expire`` drops, as of the latest ``clock_col``. ``trips`` come from ``unified_trips`` with a clock. A trip
    that is older than its clock allows, or has no time, passes at once, however late it is. The others are held until the
    watermark, the latest time seen less ``days``, has passed them; so state holds the distinct trips of the
    last ``days`` days, one row each with the number of its copies, and nothing is dropped as late. Times count in
    milliseconds. The table's micro-batches must be read in the order in which they were written, as the file
    source does by the times of files. Doubles of minus zero come back as zero.
    """
    age, columns = F.expr(f"INTERVAL '{int(days)}' DAY"), trips.columns
    due = F.col(time_col) + age
    old = F.coalesce(due < F.col(clock_col), F.lit(True))
    held = (
        trips.where(~old)
        .withColumn("__due", F.timestamp_micros(epoch_micros(time_col)) + age)
        .withWatermark("__due", f"{int(days)} days 1 millisecond")
        .groupBy("__due", *columns)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    )
    return trips.where(old).unionByName(held.select(*columns)).drop(clock_col)


def windowed_counts(
    trips: DataFrame, time_col: str, window: str = "1 hour", late_days: int = RETENTION_DAYS, by: tuple[str, ...] = ()
) -> DataFrame:
    """Trips per tumbling window. On a stream, trips later than ``late_days`` are dropped and
    the state of closed windows is released.

    A watermark needs an instant: on a stream the wall clock is read as UTC and turned back
    afterwards.
    """
    if not trips.isStreaming:
        counted = trips.groupBy(F.window(time_col, window).alias("w"), *by).agg(F.count(F.lit(1)).alias("trips"))
        return counted.select(F.col("w.start").alias("window_start"), *by, "trips")
    return (
        trips.withColumn("__at", F.timestamp_micros(epoch_micros(time_col)))
        .withWatermark("__at", f"{late_days} days")
        .groupBy(F.window("__at", window).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("trips"))
        .select(from_epoch_micros(F.unix_micros("w.start")).alias("window_start"), *by, "trips")
    )
