"""Search-index bulk load: request bodies cut from documents, and throttled posting."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator
from itertools import accumulate

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import key_text

DOCS_PER_REQUEST = 1000
MAX_CONCURRENT = 2
DELAY_MS = 100
# How long a request may wait for its turn, pauses for a busy destination included, and then for its answer.
MAX_WAIT_S = 30.0
ANSWER_S = 60.0
FIRST_PAUSE_S = 0.1

CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("index", T.StringType(), False),
        T.StructField("chunk_id", T.StringType(), False),
        T.StructField("n_docs", T.LongType(), False),
        T.StructField("body", T.StringType(), False),
    ]
)
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("index", T.StringType(), False),
        T.StructField("chunk_id", T.StringType(), False),
        T.StructField("n_docs", T.LongType(), False),
        T.StructField("ok", T.BooleanType(), False),
        T.StructField("error", T.StringType(), True),
    ]
)


def document_id(*key_cols: str) -> Column:
    """A document id that a replay reproduces, from columns that tell trips apart."""
    return F.md5(key_text(*key_cols))


def bulk_entries(docs: DataFrame, index: str, doc_col: str = "doc", id_col: str | None = None) -> DataFrame:
    """Action line and document line of every document, as one text column ``entry``."""
    target = F.struct(F.lit(index).alias("_index"), *([F.col(id_col).alias("_id")] if id_col else []))
    action = F.to_json(F.struct(target.alias("index")))
    return docs.select(F.concat(action, F.lit("\n"), F.col(doc_col), F.lit("\n")).alias("entry"))


def bulk_chunks(
    docs: DataFrame, index: str, size: int = DOCS_PER_REQUEST, doc_col: str = "doc", id_col: str | None = None
) -> DataFrame:
    """Request bodies of at most ``size`` documents: ``(index, chunk_id, n_docs, body)``.

    Chunks are cut inside each partition, so there is no shuffle and a task buffers one Arrow batch and one
    chunk. ``chunk_id`` is partition and number, so bounds follow the partitions of ``docs``.
    """

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["index", "chunk_id", "n_docs", "body"]
        partition, number, waiting = TaskContext.get().partitionId(), 0, pa.array([], pa.string())

        def emit(entries, counts):
            nonlocal number
            offsets = pa.array([0, *accumulate(counts)], pa.int32())
            bodies = pc.binary_join(pa.ListArray.from_arrays(offsets, entries), "")
            ids = [f"{partition}-{number + i}" for i in range(len(counts))]
            number += len(counts)
            return pa.record_batch([pa.array([index] * len(counts)), ids, pa.array(counts, pa.int64()), bodies], names)

        for batch in batches:
            waiting = pa.concat_arrays([waiting, batch.column("entry").cast(pa.string())])
            full = len(waiting) // size
            if full:
                yield emit(waiting.slice(0, full * size), [size] * full)
                waiting = pa.concat_arrays([waiting.slice(full * size)])
        if len(waiting):
            yield emit(waiting, [len(waiting)])

    return bulk_entries(docs, index, doc_col, id_col).mapInArrow(cut, CHUNK_SCHEMA)


class Busy(RuntimeError):
    """What a poster raises when the destination asks to come back later."""


class _Turns:
    """One request at a time. A request without an answer keeps the turn until it ends, reported or not."""

    def __init__(self, poster: Callable[[str], object], max_wait_s: float, answer_s: float):
        self.poster, self.max_wait_s, self.answer_s = poster, max_wait_s, answer_s
        self.free = threading.Semaphore(1)

    def post(self, body: str) -> None:
        """Send ``body``; while the destination is busy again and again, each pause twice as long as the last."""
        until, pause = time.monotonic() + self.max_wait_s, FIRST_PAUSE_S
        while True:
            try:
                return self._send(body, until)
            except Busy as e:
                left = until - time.monotonic()
                if left <= 0:
                    raise TimeoutError(f"turned away for {self.max_wait_s:g} s: {e}") from e
                time.sleep(min(pause, left))
                pause *= 2

    def _send(self, body: str, until: float) -> None:
        if not self.free.acquire(timeout=max(0.0, until - time.monotonic())):
            raise TimeoutError(f"waited {self.max_wait_s:g} s for a turn")
        answer: queue.Queue = queue.Queue()

        def work() -> None:
            error = None
            try:
                self.poster(body)
            except Exception as e:
                error = e
            finally:
                self.free.release()
                answer.put(error)

        threading.Thread(target=work, daemon=True).start()
        try:
            error = answer.get(timeout=self.answer_s)
        except queue.Empty:
            raise TimeoutError(f"no answer in {self.answer_s:g} s") from None
        if error is not None:
            raise error


def _speculates(spark: SparkSession) -> bool:
    on = {name: spark.conf.get(f"spark.{name}", "false") == "true" for name in ("speculation", "dynamicAllocation.enabled")}
    return on["speculation"] and not on["dynamicAllocation.enabled"]


def post_chunks(
    chunks: DataFrame,
    poster: Callable[[str], object],
    max_concurrent: int = MAX_CONCURRENT,
    delay_ms: int = DELAY_MS,
    max_wait_s: float = MAX_WAIT_S,
    answer_s: float = ANSWER_S,
    barrier: bool | None = None,
) -> DataFrame:
    """Send every body with ``poster``; rows ``(index, chunk_id, n_docs, ok, error)``.

    At most ``max_concurrent`` requests run at a time, each after a pause: so many tasks, with one turn each.
    ``poster`` raises on failure, and ``Busy`` to be asked again after a pause. A request that waits longer than
    ``max_wait_s`` for its turn or for a busy destination, or longer than ``answer_s`` for its answer, is reported
    as failed. With ``barrier`` the tasks are a barrier stage, which has no speculative copies of tasks that would add
    requests; by default it is one where the session speculates (Spark allows none with dynamic allocation).
    Evaluating the result sends the requests: write it once, as ``post_outbox`` does.
    """

    def send(batches: Iterator) -> Iterator:
        turns = _Turns(poster, max_wait_s, answer_s)
        for frame in batches:
            oks, errors = [], []
            for body in frame["body"]:
                if delay_ms:
                    time.sleep(delay_ms / 1000)
                try:
                    turns.post(body)
                    oks.append(True)
                    errors.append(None)
                except Exception as e:  # reported per request; post_outbox fails the batch
                    oks.append(False)
                    errors.append(f"{type(e).__name__}: {e}")
            yield frame[["index", "chunk_id", "n_docs"]].assign(ok=oks, error=errors)

    if barrier is None:
        barrier = _speculates(chunks.sparkSession)
    # A barrier stage can't begin with gathered partitions, so its bodies are shuffled.
    laid = chunks.repartition(max_concurrent) if barrier else chunks.coalesce(max_concurrent)
    return laid.mapInPandas(send, RESULT_SCHEMA, barrier=barrier)


class BulkLoadError(RuntimeError):
    """At least one bulk request was refused."""


def write_bodies(chunks: DataFrame, folder: str) -> None:
    """Bodies to post later, written at full parallelism, which the throttle would hold back."""
    chunks.write.mode("overwrite").parquet(folder)


def post_bodies(
    spark: SparkSession,
    folders: list[str],
    poster: Callable[[str], object],
    results: str,
    max_concurrent: int = MAX_CONCURRENT,
    delay_ms: int = DELAY_MS,
    **limits,
) -> DataFrame:
    """Post the bodies of all ``folders`` in one job, so that the limit holds for them together.

    Outcomes are written to ``results``; any refused request fails the call, and with document ids a
    repeated call replaces what was already accepted. ``limits`` are those of ``post_chunks``.
    """
    stored = spark.read.schema(CHUNK_SCHEMA).parquet(*folders).select(*CHUNK_SCHEMA.names)
    post_chunks(stored, poster, max_concurrent, delay_ms, **limits).write.mode("overwrite").parquet(results)
    outcome = spark.read.schema(RESULT_SCHEMA).parquet(results)
    failure = outcome.filter(~F.col("ok")).select("chunk_id", "error").first()
    if failure is not None:
        raise BulkLoadError(f"bulk request {failure.chunk_id} failed: {failure.error}")
    return outcome


def post_outbox(
    chunks: DataFrame,
    poster: Callable[[str], object],
    outbox: str,
    max_concurrent: int = MAX_CONCURRENT,
    delay_ms: int = DELAY_MS,
    **limits,
) -> DataFrame:
    """Write the bodies to ``outbox``, then post them throttled; returns the outcomes."""
    write_bodies(chunks, f"{outbox}/bodies")
    spark = chunks.sparkSession
    return post_bodies(spark, [f"{outbox}/bodies"], poster, f"{outbox}/results", max_concurrent, delay_ms, **limits)


def index_document(
    document: str, index: str, client: Callable[[str, str, str | None], str], doc_id: str | None = None
) -> str:
    """Index one document; returns its id.

    ``client(index, document, doc_id)`` sends it and answers with the id that the index gave or kept. A
    refused document raises ``BulkLoadError``.
    """
    try:
        return client(index, document, doc_id)
    except Exception as e:
        raise BulkLoadError(f"document for {index} was refused: {type(e).__name__}: {e}") from e
