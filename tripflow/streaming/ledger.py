"""The ingestion ledger: one row per file that was handled, in one folder per stream and micro-batch.

Older micro-batches of a stream are gathered in a snapshot, a folder ``query=...@upto-N`` beside the stream's own, so
that the number of files doesn't grow with the number of micro-batches. A snapshot takes effect when it is renamed
into place; from then on readers pass over the micro-batches that it covers, whether or not these are deleted yet.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER_SCHEMA
from ..sources import files

PROCESSED = "processed"
NOT_PARQUET = "not_parquet"
SCHEMA_MISMATCH = "schema_mismatch"
PROCESSING_ERROR = "processing_error"
UNEXPECTED_ERROR = "unexpected_error"


def _query_of(ingest_id: str) -> tuple[str, str]:
    query, _, batch = ingest_id.rpartition("-")
    return query or "manual", batch


def _batch_dir(ledger_dir: str, ingest_id: str) -> str:
    query, batch = _query_of(ingest_id)
    return f"{ledger_dir.rstrip('/')}/query={query}/batch={batch}"


_SNAPSHOT = "@upto-"
# Micro-batches that a snapshot leaves alone: the stream may repeat its last one.
RECENT = 10


def _streams(spark: SparkSession, ledger_dir: str) -> dict[str, tuple[str | None, dict[int, str]]]:
    """By stream its folder and its snapshots by their last micro-batch, from one listing."""
    found: dict[str, tuple[str | None, dict[int, str]]] = {}
    for folder in files.list_dirs(spark, ledger_dir):
        name = folder.rsplit("/", 1)[-1]
        if not name.startswith("query="):
            continue
        query, _, last = name.removeprefix("query=").partition(_SNAPSHOT)
        own, snapshots = found.get(query, (None, {}))
        found[query] = (own, {**snapshots, int(last): folder}) if last else (folder, snapshots)
    return found


def _read(spark: SparkSession, streams: Iterable[tuple[str | None, dict[int, str]]]) -> DataFrame:
    """Rows of the streams' newest snapshots and of the micro-batches behind them."""
    plain, frames = [], [spark.createDataFrame([], LEDGER_SCHEMA)]
    for own, snapshots in streams:
        if snapshots:
            plain.append(snapshots[max(snapshots)])
        if own and not snapshots:
            plain.append(own)
        elif own:
            rows = spark.read.schema(copy.deepcopy(LEDGER_SCHEMA).add("batch", "string")).parquet(files.literal(own))
            behind = F.expr("try_cast(batch as bigint)") > max(snapshots)
            frames.append(rows.where(F.coalesce(behind, F.lit(True))).select(*LEDGER_SCHEMA.names))
    if plain:
        reader = spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True)
        frames[0] = reader.parquet(*[files.literal(f) for f in plain])
    return reduce(DataFrame.unionByName, frames)


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """Rows of all micro-batches: of each stream its snapshot and what came after."""
    files.make_dirs(spark, ledger_dir)
    return _read(spark, _streams(spark, ledger_dir).values())


def compact_ledger(spark: SparkSession, ledger_dir: str, query: str, recent: int = RECENT, rows_per_file: int = 1_000_000) -> int | None:
    """Gather a stream's micro-batches, all but the ``recent`` last ones, in a new snapshot; returns its last one.

    The snapshot is written to a hidden folder and renamed, then what it covers is deleted. Ended before the rename,
    nothing has changed; ended after it, the next call deletes what is left. Tasks move the rows. None if there is
    nothing to gather. One call at a time per stream, which the stream itself makes between micro-batches.
    """
    own, snapshots = _streams(spark, ledger_dir).get(query, (None, {}))
    if own is None:
        return None
    folders = {int(n): f for f in files.list_dirs(spark, own) if (n := f.rsplit("=", 1)[-1]).isdigit()}
    newest = max(snapshots, default=-1)
    for folder in [f for n, f in folders.items() if n <= newest] + [f for n, f in snapshots.items() if n < newest]:
        files.delete_tree(spark, folder)
    done = sorted(n for n, f in folders.items() if n > newest and files.exists(spark, f"{f}/_SUCCESS"))
    done = done[: len(done) - recent] if recent else done
    if not done:
        return None
    gathered = [folders[n] for n in done] + ([snapshots[newest]] if snapshots else [])
    reader = spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True)
    rows = reader.parquet(*[files.literal(f) for f in gathered])
    hidden = f"{ledger_dir.rstrip('/')}/_compacting-{uuid.uuid4().hex}"
    rows.repartition(max(1, -(-rows.count() // rows_per_file))).write.parquet(hidden)
    files.move_file(spark, hidden, f"{ledger_dir.rstrip('/')}/query={query}{_SNAPSHOT}{done[-1]}")
    for folder in gathered:
        files.delete_tree(spark, folder)
    return done[-1]


def read_other_ledgers(spark: SparkSession, ledger_dir: str, ingest_id: str) -> DataFrame | None:
    """Rows that ingestion with another checkpoint recorded; None when there was no other.

    The stream itself never offers a path twice, so a micro-batch need not read back what its
    own stream has recorded. The driver lists one folder per stream, whatever the number of batches.
    """
    own = _query_of(ingest_id)[0]
    others = [streams for query, streams in _streams(spark, ledger_dir).items() if query != own]
    return _read(spark, others) if others else None


def read_batch(spark: SparkSession, ledger_dir: str, ingest_id: str) -> DataFrame | None:
    """Rows of one micro-batch; None unless its write was completed."""
    folder = _batch_dir(ledger_dir, ingest_id)
    if not files.exists(spark, f"{folder}/_SUCCESS"):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(folder)


def write_batch(rows: DataFrame, ledger_dir: str, ingest_id: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(_batch_dir(ledger_dir, ingest_id))


def pending_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files whose path the ledger does not know."""
    return listing.join(ledger.select(F.col("path")), "path", "left_anti")
