"""Directory ingestion: detect the kind of each new file, load it, record it, move it.

A micro-batch takes three steps in this order: sink, ledger, moves. The ledger write is the
commit. What is wrong with a file sends that file to the error folder; anything else fails the
micro-batch, which the stream repeats. A batch that is replayed before it is reset and done again; a batch that is replayed
after it only finishes its moves. Files must appear in the input folder whole (write elsewhere,
then rename).
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import chain
from typing import Protocol

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import quarantine_name
from ..schemas import LEDGER_SCHEMA, SchemaValidationError
from ..sinks.bulk import BulkLoadError
from ..sources import files
from ..sources.footers import detect_kind, probe_paths
from ..sources.trips import scan
from . import ledger as L

log = logging.getLogger(__name__)

MAX_FILES_PER_TRIGGER = 10
TRIGGER_SECONDS = 30
LOAD_THREADS = 5
MOVE_THREADS = 5
# Default of ``IngestConfig.max_file_age``. The file source ignores files older than the newest one it has
# seen by more than this; moved files keep their times, hence the century.
MAX_FILE_AGE = "36500d"
# Errors that say nothing about the file at hand: the micro-batch fails and is repeated.
INFRASTRUCTURE = re.compile(
    "ExecutorLost|executor .* (lost|exited)|No space left|OutOfMemory|Connection (refused|reset)|FetchFailed"
    "|SparkContext (was|has been) (stopped|shut|cancelled)|Cannot call methods on a stopped|TimeoutException"
    "|AccessDenied|Permission denied|UnknownHost"
)
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


class Sink(Protocol):
    def reset(self, spark: SparkSession, ingest_id: str) -> None: ...

    def write(self, frame: DataFrame, kind: str, ingest_id: str, part: str) -> None: ...

    def finish(self, spark: SparkSession, ingest_id: str) -> None: ...


@dataclass(frozen=True)
class IngestConfig:
    input_dir: str
    processed_dir: str
    error_dir: str
    ledger_dir: str
    checkpoint_dir: str
    sink: Sink
    mode: str = "lenient"
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER
    max_file_age: str = MAX_FILE_AGE
    trigger_seconds: int = TRIGGER_SECONDS
    # Micro-batches between snapshots of the ledger.
    compact_every: int = 100
    # Called with "sink", "ledger" or "moves" and the micro-batch's number when that step is done. What it raises
    # ends the stream there, as a crash would.
    after_step: Callable[[str, int], None] | None = None


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _status_of(error: Exception) -> str:
    expected = (SchemaValidationError, PySparkException, Py4JError)
    return L.PROCESSING_ERROR if isinstance(error, expected) else L.UNEXPECTED_ERROR


def _about_the_file(error: Exception) -> bool:
    """Whether a failed load is the file's fault. Lost executors, full disks and the like are not."""
    if isinstance(error, (BulkLoadError, OSError, Py4JNetworkError)):
        return False
    return not INFRASTRUCTURE.search(str(error))


def _load(spark: SparkSession, cfg: IngestConfig, kind: str, group: list, ingest_id: str, part: str) -> list[tuple]:
    """Load files of one schema with one scan. If that fails, load each half of them, so that a bad
    file among many costs a few more jobs and fails alone. Errors that are not about a file are raised.
    Returns ``(file, status, started, finished, error)``."""
    started = _now()
    try:
        frame = scan(spark, [files.literal(f.path) for f in group], with_origin=True)
        cfg.sink.write(frame, kind, ingest_id, part)
    except Exception as error:
        if not _about_the_file(error):
            raise  # the whole micro-batch is repeated, and its files stay where they are
        if len(group) == 1:
            log.error("could not load %s: %s", group[0].path, error)
            return [(group[0], _status_of(error), started, _now(), f"{type(error).__name__}: {error}")]
        log.warning("load of %d %s files failed, trying each half", len(group), kind)
        half = len(group) // 2
        return [
            outcome
            for i, some in enumerate((group[:half], group[half:]))
            for outcome in _load(spark, cfg, kind, some, ingest_id, f"{part}-{i}")
        ]
    finished = _now()
    return [(f, L.PROCESSED, started, finished, None) for f in group]


def ingest_batch(
    spark: SparkSession, listing: DataFrame, cfg: IngestConfig, ingest_id: str, batch_id: int = 0
) -> DataFrame:
    """Ingest the listed files (``path``, ``length``); returns their ledger rows.

    Only file names, kinds and counts come to the driver, and no more of them than one
    micro-batch holds. Rows are read, converted and written by tasks.
    """
    after_step = cfg.after_step or (lambda step, number: None)
    committed = L.read_batch(spark, cfg.ledger_dir, ingest_id)
    if committed is None:
        rows = _ingest_files(spark, listing, cfg, ingest_id, batch_id)
        after_step("sink", batch_id)
        L.write_batch(spark.createDataFrame(rows, LEDGER_SCHEMA), cfg.ledger_dir, ingest_id)
        after_step("ledger", batch_id)
        committed = L.read_batch(spark, cfg.ledger_dir, ingest_id)
    move_files(spark, committed, cfg)
    after_step("moves", batch_id)
    return committed


def _ingest_files(
    spark: SparkSession, listing: DataFrame, cfg: IngestConfig, ingest_id: str, batch_id: int
) -> list[tuple]:
    cfg.sink.reset(spark, ingest_id)
    offered = {r.path: files.FileInfo(r.path, r.length) for r in listing.select("path", "length").collect()}
    # The file source hides empty files. A task lists the folder for them.
    listed = files.listing_frame(spark, cfg.input_dir)
    empty = [files.FileInfo(r.path, 0) for r in listed.where("length = 0").collect()]
    offered |= {f.path: f for f in empty}
    if empty:
        known = L.read_ledger(spark, cfg.ledger_dir)
    else:
        known = L.read_other_ledgers(spark, cfg.ledger_dir, ingest_id)
    paths = set(offered)
    if known is not None:
        pending = L.pending_files(files.file_frame(spark, list(offered.values())), known)
        paths = {r.path for r in pending.select("path").collect()}

    rows, candidates = [], []
    for path in sorted(paths):
        name = _name(path)
        if files.is_hidden(name):
            continue
        if files.is_parquet_name(name):
            candidates.append(files.FileInfo(path, 0))
        else:
            at = _now()
            rows.append((path, name, None, L.NOT_PARQUET, None, batch_id, at, at, None))
    if not candidates:
        return rows

    started = _now()
    probe = detect_kind(probe_paths(spark, [f.path for f in candidates]), cfg.mode)
    groups: dict[tuple[str, str], list] = {}
    records = {}
    for path, kind, shape, count, error in probe.select("path", "kind", "fingerprint", "num_rows", "error").collect():
        if kind == "unknown":
            rows.append((path, _name(path), None, L.SCHEMA_MISMATCH, None, batch_id, started, _now(), error))
        else:
            groups.setdefault((kind, shape), []).append(files.FileInfo(path, 0))
            records[path] = count

    def load(numbered) -> list[tuple]:
        number, (kind, shape) = numbered
        group = sorted(groups[kind, shape], key=lambda f: f.path)
        return [(kind, *o) for o in _load(spark, cfg, kind, group, ingest_id, str(number))]

    # The jobs of different groups run side by side; within a group Spark does the spreading.
    with ThreadPoolExecutor(LOAD_THREADS) as pool:
        for kind, f, status, began, ended, error in chain.from_iterable(pool.map(load, enumerate(sorted(groups)))):
            count = records[f.path] if status == L.PROCESSED else None
            rows.append((f.path, _name(f.path), kind, status, count, batch_id, began, ended, error))
    cfg.sink.finish(spark, ingest_id)
    return rows


def move_files(spark: SparkSession, ledger_rows: DataFrame, cfg: IngestConfig) -> None:
    """Archive processed files, quarantine the others under a name that carries the reason."""
    for folder in (cfg.processed_dir, cfg.error_dir):
        files.make_dirs(spark, folder)
    done = F.col("status") == L.PROCESSED
    target = F.when(done, F.concat(F.lit(cfg.processed_dir.rstrip("/") + "/"), "file_name")).otherwise(
        F.concat(F.lit(cfg.error_dir.rstrip("/") + "/"), quarantine_name("file_name", "status"))
    )
    moves = ledger_rows.select("path", target.alias("target")).collect()

    def move(row) -> None:
        try:
            files.move_file(spark, row.path, row.target)
        except (OSError, Py4JError) as error:  # loaded and recorded; the move alone is missing
            log.error("could not move %s: %s", row.path, error)

    with ThreadPoolExecutor(MOVE_THREADS) as pool:
        list(pool.map(move, moves))


def list_pending(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """Files now in the input folder that the ledger does not know: ``path``, ``length``."""
    listing = files.listing_frame(spark, cfg.input_dir)
    return L.pending_files(listing, L.read_ledger(spark, cfg.ledger_dir))


def start_ingest(spark: SparkSession, cfg: IngestConfig, available_now: bool = False) -> StreamingQuery:
    """Start the ingestion stream; with ``available_now`` it ends once the folder is drained."""
    files.make_dirs(spark, cfg.input_dir)
    listing = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("maxFilesPerTrigger", cfg.max_files_per_trigger)
        .option("maxFileAge", cfg.max_file_age)
        .load(cfg.input_dir)
        .select("path", "length")
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # The query id is kept in the checkpoint: a replayed batch finds its own rows again.
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest_batch(session, batch, cfg, f"{query_id}-{batch_id}", batch_id)
        if batch_id % cfg.compact_every == cfg.compact_every - 1:
            L.compact_ledger(session, cfg.ledger_dir, query_id)

    writer = listing.writeStream.foreachBatch(on_batch).option("checkpointLocation", cfg.checkpoint_dir)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{cfg.trigger_seconds} seconds"}
    return writer.trigger(**trigger).start()


def run_once(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """Ingest everything that is in the folder now; returns the whole ledger."""
    start_ingest(spark, cfg, available_now=True).awaitTermination()
    return L.read_ledger(spark, cfg.ledger_dir)


def stop_ingest(queries: StreamingQuery | Iterable[StreamingQuery]) -> None:
    """Stop one or more streams; stopping twice is harmless."""
    for query in [queries] if isinstance(queries, StreamingQuery) else queries:
        if query.isActive:
            query.stop()
