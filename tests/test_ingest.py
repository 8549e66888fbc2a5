import os
import shutil
from dataclasses import dataclass, field, replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tripflow.operators import metrics
from tripflow.plans import catalog
from tripflow.plans.testbed import trip_files
from tripflow.sinks.bulk import BulkLoadError
from tripflow.sinks.ingest_sinks import SearchIndex, SqlTables, TripTables
from tripflow.sources import files
from tripflow.streaming import ingest, ledger


def config(root, sink=None, **changes):
    cfg = ingest.IngestConfig(
        input_dir=f"{root}/in",
        processed_dir=f"{root}/processed",
        error_dir=f"{root}/error",
        ledger_dir=f"{root}/ledger",
        checkpoint_dir=f"{root}/checkpoint",
        sink=sink or TripTables(f"{root}/tables"),
    )
    return replace(cfg, **changes)


@pytest.fixture(scope="module")
def monthly(spark, tmp_path_factory):
    """Single trip files by name, as if downloaded: three yellow and two green."""
    folder = tmp_path_factory.mktemp("monthly")
    for kind, months in (("yellow", (1, 2, 3)), ("green", (1, 2))):
        time = "tpep_pickup_datetime" if kind == "yellow" else "lpep_pickup_datetime"
        trips = trip_files(spark, SF, kind)
        for month in months:
            parts = folder / f"{kind}-{month}"
            trips.filter(F.month(time) == month).coalesce(1).write.parquet(str(parts))
            shutil.copy(next(parts.glob("*.parquet")), folder / f"{kind}_tripdata_2025_0{month}.parquet")
    other = folder / "other"
    df = spark.createDataFrame([("k7", 0.5)], "sensor string, reading double")
    df.coalesce(1).write.parquet(str(other))
    shutil.copy(next(other.glob("*.parquet")), folder / "other.parquet")
    return folder


def put(monthly, root, *names):
    (root / "in").mkdir(exist_ok=True)
    for name in names:
        shutil.copy(monthly / name, root / "in" / name)


def names(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) if folder.exists() else []


YELLOW = [f"yellow_tripdata_2025_0{m}.parquet" for m in (1, 2, 3)]
GREEN = [f"green_tripdata_2025_0{m}.parquet" for m in (1, 2)]


def rows_in(spark, monthly, chosen):
    return sum(spark.read.parquet(str(monthly / n)).count() for n in chosen)


def add_junk(monthly, root):
    inbox = root / "in"
    put(monthly, root, "other.parquet")
    (inbox / "notes.txt").write_text("hello")
    (inbox / "README").write_text("hello")
    (inbox / "zero.parquet").touch()
    (inbox / "torn.PARQUET").write_bytes((monthly / YELLOW[0]).read_bytes()[:500])
    (inbox / ".hidden").write_text("x")
    (inbox / "_tmp").write_text("x")


@pytest.mark.parametrize("mode", ["lenient", "strict"])
def test_whole_folder(spark, monthly, tmp_path, mode):
    put(monthly, tmp_path, *YELLOW, *GREEN)
    add_junk(monthly, tmp_path)
    sink = TripTables(f"{tmp_path}/tables", typed=mode == "lenient")
    cfg = config(tmp_path, sink, mode=mode, max_files_per_trigger=4)
    book = ingest.run_once(spark, cfg)
    status = {r.file_name: (r.kind, r.status) for r in book.collect()}
    assert status == {
        **{n: ("yellow", "processed") for n in YELLOW},
        **{n: ("green", "processed") for n in GREEN},
        "other.parquet": (None, "schema_mismatch"),
        "zero.parquet": (None, "schema_mismatch"),
        "torn.PARQUET": (None, "schema_mismatch"),
        "notes.txt": (None, "not_parquet"),
        "README": (None, "not_parquet"),
    }
    assert names(tmp_path / "in") == ["_tmp"]
    assert names(tmp_path / "processed") == sorted(YELLOW + GREEN)
    assert names(tmp_path / "error") == [
        "README_not_parquet",
        "notes_not_parquet.txt",
        "other_schema_mismatch.parquet",
        "torn_schema_mismatch.PARQUET",
        "zero_schema_mismatch.parquet",
    ]
    for kind, chosen in (("yellow", YELLOW), ("green", GREEN)):
        assert cfg.sink.read(spark, kind).count() == rows_in(spark, monthly, chosen)
    assert ("ehail_fee" in cfg.sink.read(spark, "green").columns) == (mode == "strict")
    totals = {r.kind: r for r in metrics.ledger_totals(book).collect()}
    assert totals["total"].files == 10 and totals["total"].files_errored == 5
    assert totals["yellow"].records == rows_in(spark, monthly, YELLOW)
    assert book.select("batch_id").distinct().count() > 1


def test_second_pass_adds_only_new_files(spark, monthly, tmp_path):
    put(monthly, tmp_path, YELLOW[0])
    cfg = config(tmp_path)
    assert ingest.run_once(spark, cfg).count() == 1
    assert ingest.run_once(spark, cfg).count() == 1
    put(monthly, tmp_path, YELLOW[1])
    assert ingest.list_pending(spark, cfg).count() == 1
    assert ingest.run_once(spark, cfg).count() == 2
    assert cfg.sink.read(spark, "yellow").count() == rows_in(spark, monthly, YELLOW[:2])


def test_old_file_is_not_ignored(spark, monthly, tmp_path):
    put(monthly, tmp_path, YELLOW[0])
    cfg = config(tmp_path)
    ingest.run_once(spark, cfg)
    put(monthly, tmp_path, YELLOW[1])
    os.utime(tmp_path / "in" / YELLOW[1], (10**9, 10**9))
    assert ingest.run_once(spark, cfg).count() == 2


def test_files_of_different_years(spark, monthly, tmp_path):
    """The lenient mode takes older column types; the table has one type per column."""
    put(monthly, tmp_path, YELLOW[0])
    old = spark.read.parquet(str(monthly / YELLOW[1])).drop("cbd_congestion_fee")
    old = old.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    old.coalesce(1).write.parquet(str(tmp_path / "old"))
    shutil.copy(next((tmp_path / "old").glob("*.parquet")), tmp_path / "in" / "old.parquet")
    cfg = config(tmp_path)
    assert {r.status for r in ingest.run_once(spark, cfg).collect()} == {"processed"}
    stored = cfg.sink.read(spark, "yellow")
    assert stored.schema["passenger_count"].dataType.simpleString() == "int"
    assert stored.count() == rows_in(spark, monthly, YELLOW[:2])


def test_known_path_is_skipped_even_with_a_new_checkpoint(spark, monthly, tmp_path):
    put(monthly, tmp_path, YELLOW[0])
    cfg = config(tmp_path)
    ingest.run_once(spark, cfg)
    put(monthly, tmp_path, YELLOW[0])
    again = replace(cfg, checkpoint_dir=f"{tmp_path}/checkpoint2")
    assert ingest.list_pending(spark, again).isEmpty()
    assert ingest.run_once(spark, again).count() == 1
    assert cfg.sink.read(spark, "yellow").count() == rows_in(spark, monthly, YELLOW[:1])


def listing(spark, cfg):
    return files.file_frame(spark, files.list_files(spark, cfg.input_dir))


def test_replay_before_the_commit_starts_over(spark, monthly, tmp_path, monkeypatch):
    put(monthly, tmp_path, *YELLOW)
    cfg = config(tmp_path)
    frame = listing(spark, cfg)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "write_batch", lost)
        with pytest.raises(RuntimeError):
            ingest.ingest_batch(spark, frame, cfg, "q-0")
    assert cfg.sink.read(spark, "yellow").count() > 0
    ingest.ingest_batch(spark, frame, cfg, "q-0")
    assert cfg.sink.read(spark, "yellow").count() == rows_in(spark, monthly, YELLOW)


def test_replay_after_the_commit_only_moves(spark, monthly, tmp_path, monkeypatch):
    put(monthly, tmp_path, *YELLOW)
    cfg = config(tmp_path)
    frame = listing(spark, cfg)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "move_files", lost)
        with pytest.raises(RuntimeError):
            ingest.ingest_batch(spark, frame, cfg, "q-0")
    assert names(tmp_path / "in") == sorted(YELLOW)
    again = ingest.ingest_batch(spark, frame, cfg, "q-0")
    assert again.count() == 3 and names(tmp_path / "processed") == sorted(YELLOW)
    ingest.ingest_batch(spark, frame, cfg, "q-0")
    assert cfg.sink.read(spark, "yellow").count() == rows_in(spark, monthly, YELLOW)
    assert ledger.read_ledger(spark, cfg.ledger_dir).count() == 3


def test_bad_file_fails_alone(spark, monthly, tmp_path):
    """A file with a sound footer and broken data pages does not take its group down."""
    put(monthly, tmp_path, *YELLOW)
    data = bytearray((monthly / YELLOW[1]).read_bytes())
    data[4 : len(data) // 2] = bytes(len(data) // 2 - 4)
    (tmp_path / "in" / YELLOW[1]).write_bytes(bytes(data))
    cfg = config(tmp_path)
    status = {r.file_name: r.status for r in ingest.run_once(spark, cfg).collect()}
    assert status == {YELLOW[0]: "processed", YELLOW[1]: "processing_error", YELLOW[2]: "processed"}
    assert names(tmp_path / "error") == ["yellow_tripdata_2025_02_processing_error.parquet"]
    assert cfg.sink.read(spark, "yellow").count() == rows_in(spark, monthly, [YELLOW[0], YELLOW[2]])


@dataclass
class FailingSink:
    error: Exception
    bad: str | None = None
    calls: list = field(default_factory=list)

    def reset(self, spark, ingest_id):
        pass

    def write(self, frame, kind, ingest_id, part):
        self.calls.append(part)
        if self.bad is None or any(self.bad in f for f in frame.inputFiles()):
            raise self.error

    def finish(self, spark, ingest_id):
        pass


def test_sink_failure_is_the_files_fault(spark, monthly, tmp_path):
    put(monthly, tmp_path, GREEN[0])
    book = ingest.run_once(spark, config(tmp_path, FailingSink(KeyError("bug"))))
    assert [(r.kind, r.status, r.records, r.error) for r in book.collect()] == [
        ("green", "unexpected_error", None, "KeyError: 'bug'")
    ]
    assert names(tmp_path / "error") == ["green_tripdata_2025_01_unexpected_error.parquet"]


@pytest.mark.parametrize(
    "error", [OSError("no connection"), RuntimeError("Job aborted: ExecutorLostFailure (executor 3 exited)")]
)
def test_infrastructure_failure_leaves_the_files(spark, monthly, tmp_path, error):
    put(monthly, tmp_path, GREEN[0])
    cfg = config(tmp_path, FailingSink(error))
    with pytest.raises(type(error)):
        ingest.ingest_batch(spark, listing(spark, cfg), cfg, "q-0")
    assert names(tmp_path / "in") == [GREEN[0]] and not names(tmp_path / "error")
    assert ledger.read_ledger(spark, cfg.ledger_dir).isEmpty()


def test_one_bad_file_of_many_costs_few_loads(spark, monthly, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(16):
        shutil.copy(monthly / GREEN[0], tmp_path / "in" / f"green_{i:02d}.parquet")
    sink = FailingSink(KeyError("bug"), bad="green_05")
    cfg = config(tmp_path, sink)
    book = ingest.ingest_batch(spark, listing(spark, cfg), cfg, "q-0")
    assert {r.file_name for r in book.where("status <> 'processed'").collect()} == {"green_05.parquet"}
    assert book.count() == 16 and len(sink.calls) == 9


def test_many_batches_cost_one_listing_per_stream(spark, tmp_path, monkeypatch):
    book = tmp_path / "ledger"
    for batch in range(1000):
        (book / "query=q" / f"batch={batch}").mkdir(parents=True)
    (book / "query=other" / "batch=0").mkdir(parents=True)
    listed = []
    real = files.list_dirs
    monkeypatch.setattr(files, "list_dirs", lambda s, d: listed.append(d) or real(s, d))
    assert ledger.read_other_ledgers(spark, str(book), "q-1000").isEmpty()
    assert listed == [str(book)]
    assert ledger.read_other_ledgers(spark, str(book), "other-1") is not None


def test_missing_required_column(spark, monthly, tmp_path):
    """The lenient detector accepts it, the typed projection does not."""
    (tmp_path / "in").mkdir()
    spark.read.parquet(str(monthly / YELLOW[0])).drop("extra").coalesce(1).write.parquet(str(tmp_path / "cut"))
    shutil.copy(next((tmp_path / "cut").glob("*.parquet")), tmp_path / "in" / "cut.parquet")
    book = ingest.run_once(spark, config(tmp_path, TripTables(f"{tmp_path}/tables")))
    assert book.first().status == "processing_error"


def test_tables_by_date(spark, monthly, tmp_path):
    put(monthly, tmp_path, YELLOW[0])
    cfg = config(tmp_path, TripTables(f"{tmp_path}/tables", by_date=True))
    ingest.run_once(spark, cfg)
    stored = cfg.sink.read(spark, "yellow")
    assert stored.count() == rows_in(spark, monthly, YELLOW[:1])
    assert "airport_fee" in stored.columns and "pickup_date" in stored.columns


def store_bodies(folder):
    def post(body):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            out.write(body)

    return post


def test_search_index(spark, monthly, tmp_path):
    received = tmp_path / "received"
    received.mkdir()
    put(monthly, tmp_path, YELLOW[0], GREEN[0])
    sink = SearchIndex(f"{tmp_path}/outbox", store_bodies(received), docs_per_request=100, delay_ms=0)
    cfg = config(tmp_path, sink)
    frame = listing(spark, cfg)
    ingest.ingest_batch(spark, frame, cfg, "q-0")
    ids = set()
    for body in received.iterdir():
        ids |= set(body.read_text().splitlines()[::2])
    assert len(ids) == rows_in(spark, monthly, [YELLOW[0], GREEN[0]])
    totals = metrics.sink_totals(sink.results(spark, "yellow")).first()
    assert totals["index"] == "yellowtaxi" and totals.documents == rows_in(spark, monthly, YELLOW[:1])


def test_refused_bulk_request_fails_the_batch(spark, monthly, tmp_path):
    def refuse(body):
        raise ConnectionError("503")

    put(monthly, tmp_path, GREEN[0])
    cfg = config(tmp_path, SearchIndex(f"{tmp_path}/outbox", refuse, delay_ms=0))
    with pytest.raises(BulkLoadError, match="503"):
        ingest.ingest_batch(spark, listing(spark, cfg), cfg, "q-0")
    assert names(tmp_path / "in") == [GREEN[0]]
    assert ledger.read_ledger(spark, cfg.ledger_dir).isEmpty()


def test_one_limit_for_all_groups(spark, monthly, tmp_path):
    """Requests of two kinds and two schemas: with a limit of one, no two overlap."""
    spans = tmp_path / "spans"
    spans.mkdir()

    def post(body):
        import time
        import uuid

        start = time.time()
        time.sleep(0.05)
        with open(f"{spans}/{uuid.uuid4().hex}", "w") as out:
            out.write(f"{start} {time.time()}")

    put(monthly, tmp_path, YELLOW[0], GREEN[0])
    sink = SearchIndex(f"{tmp_path}/outbox", post, docs_per_request=50, max_concurrent=1, delay_ms=0)
    cfg = config(tmp_path, sink)
    ingest.ingest_batch(spark, listing(spark, cfg), cfg, "q-0")
    times = sorted(tuple(map(float, f.read_text().split())) for f in spans.iterdir())
    assert len(times) > 4
    assert all(end <= start for (_, end), (start, _) in zip(times, times[1:]))
    assert sink.results(spark, "yellow").count() + sink.results(spark, "green").count() == len(times)


def test_sql_tables_without_a_database(spark, monthly, tmp_path):
    """Statements and staged rows as a database would get them; a repeated batch replaces its rows."""
    put(monthly, tmp_path, YELLOW[0], GREEN[0])
    statements, staged = [], []

    def stage(frame, table, types):
        staged.append((table, types, frame.count(), frame.select("ingest_id").distinct().count()))

    sink = SqlTables(f"{tmp_path}/staging", "jdbc:none", lambda s: statements.append(list(s)), write_staging=stage)
    cfg = config(tmp_path, sink)
    ingest.ingest_batch(spark, listing(spark, cfg), cfg, "q-0")
    assert [(t, n, k) for t, _, n, k in staged] == [
        ("public.staging_yellow_q_0", rows_in(spark, monthly, YELLOW[:1]), 1),
        ("public.staging_green_q_0", rows_in(spark, monthly, GREEN[:1]), 1),
    ]
    assert '"trip_distance" DOUBLE PRECISION' in staged[0][1] and '"VendorID" INTEGER' in staged[0][1]
    create, merge = statements[0], statements[1]
    assert create[0] == 'DROP TABLE IF EXISTS "public"."staging_yellow_q_0"'
    assert create[2].startswith('CREATE TABLE IF NOT EXISTS "public"."yellowtaxi" ("VendorID" INTEGER')
    assert merge[0] == """DELETE FROM "public"."yellowtaxi" WHERE "ingest_id" = 'q-0'"""
    assert merge[1].startswith('INSERT INTO "public"."yellowtaxi" ("VendorID", ') and merge[2] == create[0]
    assert len(statements) == 4


def test_outbox_without_poster(spark, monthly, tmp_path):
    put(monthly, tmp_path, GREEN[0])
    ingest.run_once(spark, config(tmp_path, SearchIndex(f"{tmp_path}/outbox")))
    stored = spark.read.parquet(f"{tmp_path}/outbox/green/*/*/bodies")
    assert stored.agg(F.sum("n_docs")).first()[0] == rows_in(spark, monthly, GREEN[:1])


def test_archive_replaces_an_older_file(spark, monthly, tmp_path):
    put(monthly, tmp_path, YELLOW[0])
    (tmp_path / "processed").mkdir()
    (tmp_path / "processed" / YELLOW[0]).write_text("old")
    ingest.run_once(spark, config(tmp_path))
    assert (tmp_path / "processed" / YELLOW[0]).stat().st_size > 3


def test_file_name_with_pattern_characters(spark, monthly, tmp_path):
    put(monthly, tmp_path, YELLOW[0])
    (tmp_path / "in" / YELLOW[0]).rename(tmp_path / "in" / "trips [a] {1}.parquet")
    book = ingest.run_once(spark, config(tmp_path))
    assert book.first().status == "processed"
    assert names(tmp_path / "processed") == ["trips [a] {1}.parquet"]


def test_continuous_stream_and_stop(spark, monthly, tmp_path):
    put(monthly, tmp_path, YELLOW[0])
    cfg = config(tmp_path, trigger_seconds=1)
    query = ingest.start_ingest(spark, cfg)
    query.processAllAvailable()
    put(monthly, tmp_path, GREEN[0])
    query.processAllAvailable()
    ingest.stop_ingest(query)
    ingest.stop_ingest([query, query])
    assert not query.isActive
    assert {r.kind for r in ledger.read_ledger(spark, cfg.ledger_dir).collect()} == {"yellow", "green"}


def test_timer_and_rates(spark):
    rows = [
        ("/a", "a", "yellow", "processed", 60, 0, datetime(2024, 1, 1, 10, 0, 0), datetime(2024, 1, 1, 10, 0, 30), None),
        ("/b", "b", "yellow", "processed", 120, 0, datetime(2024, 1, 1, 10, 0, 0), datetime(2024, 1, 1, 10, 0, 59), None),
        ("/c", "c", None, "not_parquet", None, 0, datetime(2024, 1, 1, 10, 1, 0), datetime(2024, 1, 1, 10, 1, 1), "text"),
    ]
    book = spark.createDataFrame(rows, ledger.LEDGER_SCHEMA)
    timers = {r.kind: tuple(r)[1:] for r in metrics.timer_stats(book).collect()}
    assert timers == {"yellow": (2, 89.0, 59.0), None: (1, 1.0, 1.0)}
    rates = {(r.window_start, r.kind): (r.files, r.records_per_second) for r in metrics.ledger_rates(book).collect()}
    assert rates == {
        (datetime(2024, 1, 1, 10, 0), "yellow"): (2, 3.0),
        (datetime(2024, 1, 1, 10, 1), None): (1, 0.0),
    }
    status = {(r.kind, r.status): (r.files, r.records) for r in metrics.status_totals(book).collect()}
    assert status == {("yellow", "processed"): (2, 180), (None, "not_parquet"): (1, 0)}


def test_query_over_an_input_whose_first_part_is_empty(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # Parts far smaller than a row group: only the one with its middle has rows.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = catalog.ingest_directory(spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["kind"], r["status"]) for r in found) == [("green", "processed"), ("yellow", "processed")]
    assert all(r["records"] == r["loaded"] > 0 for r in found)
