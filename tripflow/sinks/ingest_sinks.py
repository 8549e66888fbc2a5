"""Destinations of ingested files. Each write can be repeated without doubling rows.

A sink has ``reset(spark, ingest_id)``, which removes what an unfinished attempt at a
micro-batch left, ``write(frame, kind, ingest_id, part)``, and ``finish(spark, ingest_id)``, which
is called once after all writes of the micro-batch. Frames carry the file columns plus the row's
origin (file path and position).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import to_documents
from ..operators.features import with_pickup_date
from ..operators.layout import spread
from ..operators.normalize import check_schema, normalize
from ..operators.schema_ops import (
    create_table_sql,
    ddl_types,
    drop_table_sql,
    merge_sql,
    quoted_table,
    sanitize_columns,
    sanitize_name,
)
from ..schemas import KINDS, kind_of
from ..sources import files
from ..sources.trips import ORIGIN
from .bulk import (
    DELAY_MS,
    DOCS_PER_REQUEST,
    MAX_CONCURRENT,
    RESULT_SCHEMA,
    bulk_chunks,
    document_id,
    post_bodies,
    write_bodies,
)
from .tables import MAX_CONNECTIONS, jdbc_options


def _part_dir(root: str, kind: str, ingest_id: str, part: str) -> str:
    return f"{root.rstrip('/')}/{kind}/ingest_id={ingest_id}/part={part}"


def _reset(spark: SparkSession, root: str, ingest_id: str) -> None:
    for kind in KINDS:
        for key in ("ingest_id", "batch"):
            files.delete_tree(spark, f"{root.rstrip('/')}/{kind}/{key}={ingest_id}")


@dataclass(frozen=True)
class TripTables:
    """One Parquet table per kind, in one folder per micro-batch.

    Stores typed trips and ``narrowed`` (a code or count was too large and is null), or with ``typed=False`` the file columns as they are, which suits strict
    detection: there all files of a kind have one schema. Rows are written by the tasks that
    read them, without a shuffle. ``by_date`` partitions further by pickup date, which costs
    one: it pays for large files whose trips are looked up by day.
    """

    path: str
    typed: bool = True
    by_date: bool = False

    def reset(self, spark: SparkSession, ingest_id: str) -> None:
        _reset(spark, self.path, ingest_id)

    def write(self, frame: DataFrame, kind: str, ingest_id: str, part: str) -> None:
        if self.typed:
            check_schema(frame, kind)
            frame = normalize(frame, kind, flag_narrowing=True)
        else:
            frame = frame.drop(*ORIGIN)
        target = _part_dir(self.path, kind, ingest_id, part)
        if self.by_date:
            dated = with_pickup_date(frame, kind).hint("rebalance", "pickup_date")
            dated.write.mode("overwrite").partitionBy("pickup_date").parquet(target)
        else:
            frame.write.mode("overwrite").parquet(target)

    def finish(self, spark: SparkSession, ingest_id: str) -> None:
        pass

    def read(self, spark: SparkSession, kind: str) -> DataFrame:
        """The rows of all micro-batches with the columns of all of them."""
        stored = spark.read.option("mergeSchema", not self.typed).parquet(f"{self.path.rstrip('/')}/{kind}")
        return stored.drop("ingest_id", "part")


@dataclass(frozen=True)
class SearchIndex:
    """Bulk request bodies per kind, posted when a ``poster`` is given.

    Document ids come from the row's origin, so a replay replaces documents.
    """

    outbox: str
    poster: Callable[[str], object] | None = None
    docs_per_request: int = DOCS_PER_REQUEST
    max_concurrent: int = MAX_CONCURRENT
    delay_ms: int = DELAY_MS
    include_derived: bool = False
    parts: int | None = None

    def reset(self, spark: SparkSession, ingest_id: str) -> None:
        _reset(spark, self.outbox, ingest_id)
        files.delete_tree(spark, self._results(ingest_id))

    def _results(self, ingest_id: str) -> str:
        return f"{self.outbox.rstrip('/')}/results/ingest_id={ingest_id}"

    def write(self, frame: DataFrame, kind: str, ingest_id: str, part: str) -> None:
        check_schema(frame, kind)
        trips = normalize(spread(frame, self.parts), kind, keep=ORIGIN).withColumn("doc_id", document_id(*ORIGIN))
        docs = to_documents(trips, kind, self.include_derived, keep=("doc_id",))
        chunks = bulk_chunks(docs, kind_of(kind).index, self.docs_per_request, id_col="doc_id")
        write_bodies(chunks, f"{_part_dir(self.outbox, kind, ingest_id, part)}/bodies")

    def finish(self, spark: SparkSession, ingest_id: str) -> None:
        """Post the bodies of both kinds and all groups together, under one limit."""
        if self.poster is None:
            return
        folders = [
            f"{part}/bodies"
            for kind in KINDS
            for part in files.list_dirs(spark, f"{self.outbox.rstrip('/')}/{kind}/ingest_id={ingest_id}")
            if files.exists(spark, f"{part}/bodies/_SUCCESS")
        ]
        if folders:
            post_bodies(spark, folders, self.poster, self._results(ingest_id), self.max_concurrent, self.delay_ms)

    def results(self, spark: SparkSession, kind: str) -> DataFrame:
        """Outcome of every request sent so far."""
        sent = spark.read.schema(RESULT_SCHEMA).parquet(f"{self.outbox.rstrip('/')}/results/*")
        return sent.where(F.col("index") == kind_of(kind).index).withColumn("kind", F.lit(kind))


@dataclass(frozen=True)
class SqlTables:
    """One database table per kind, with the column types of ``sql_type``.

    A micro-batch is first stored as Parquet at full width, then sent over a limited number of connections to
    a staging table of its own, which each attempt replaces. ``finish`` moves the staged rows to the table in
    one transaction that first deletes the rows of the same ``ingest_id``: a repeated task, attempt or
    micro-batch never doubles rows. ``execute(statements)`` runs SQL statements as one transaction;
    ``write_staging(frame, table, column_types)`` appends a frame to a table and defaults to JDBC.
    """

    staging: str
    url: str
    execute: Callable[[list[str]], object]
    schema: str = "public"
    properties: dict | None = None
    max_connections: int = MAX_CONNECTIONS
    write_staging: Callable[[DataFrame, str, str], object] | None = None

    def _table(self, kind: str) -> str:
        return f"{self.schema}.{kind_of(kind).index}"

    def _staging_table(self, kind: str, ingest_id: str) -> str:
        return f"{self.schema}.staging_{kind}_{sanitize_name(ingest_id)}"

    def reset(self, spark: SparkSession, ingest_id: str) -> None:
        _reset(spark, self.staging, ingest_id)

    def write(self, frame: DataFrame, kind: str, ingest_id: str, part: str) -> None:
        check_schema(frame, kind)
        trips = sanitize_columns(normalize(frame, kind, flag_narrowing=True))
        trips.withColumn("ingest_id", F.lit(ingest_id)).write.mode("overwrite").parquet(
            _part_dir(self.staging, kind, ingest_id, part).replace("/ingest_id=", "/batch=")
        )

    def finish(self, spark: SparkSession, ingest_id: str) -> None:
        for kind in KINDS:
            folder = f"{self.staging.rstrip('/')}/{kind}/batch={ingest_id}"
            if not files.exists(spark, folder):
                continue
            stored = spark.read.parquet(folder).drop("part")
            stage, table = self._staging_table(kind, ingest_id), self._table(kind)
            self.execute(
                [
                    drop_table_sql(stage),
                    create_table_sql(stage, stored.schema),
                    create_table_sql(table, stored.schema, if_not_exists=True),
                ]
            )
            self._send(stored, stage)
            self.execute(merge_sql(table, stage, stored.columns, ingest_id))
            files.delete_tree(spark, folder)

    def _send(self, stored: DataFrame, stage: str) -> None:
        if self.write_staging is not None:
            self.write_staging(stored, stage, ddl_types(stored.schema))
            return
        options = jdbc_options(quoted_table(stage), self.url, max_connections=self.max_connections, properties=self.properties)
        stored.write.format("jdbc").options(**options).mode("append").save()
