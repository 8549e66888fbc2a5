"""Mixed schemas, replay, indices and kept statistics."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF, plan_of
from tripflow.operators import spacetime as st
from tripflow.plans import stored
from tripflow.schemas import LEDGER_SCHEMA
from tripflow.sources import files
from tripflow.streaming import ledger as L
from tripflow.operators.stored_stats import DISTINCT_BOUND, compact_stats, read_stats, store_stats
from tripflow.schemas import SchemaValidationError
from tripflow.sources import skip_index as si
from tripflow.sources.trips import read_any, read_listed
from tripflow.streaming.trips import expired_trips, stream_trips, unified_trips, unify_files, windowed_counts

EXTENT = st.Extent((0.0, 8.0), (0.0, 8.0), (datetime(2024, 1, 1), datetime(2024, 1, 9)), bits=5)


def test_columns_of_unlike_types_are_widened_or_refused(spark, tmp_path):
    spark.sql("select 1 a, cast(2 as bigint) b, 'x' c").write.parquet(f"{tmp_path}/one")
    spark.sql("select cast(5000000000 as bigint) a, cast(2.5 as double) B, true d").write.parquet(f"{tmp_path}/two")
    df = read_any(spark, [f"{tmp_path}/one", f"{tmp_path}/two"], with_origin=True)
    types = {name.lower(): dtype for name, dtype in df.dtypes}
    assert {c: types[c] for c in "abcd"} == {"a": "bigint", "b": "double", "c": "string", "d": "boolean"}
    rows = sorted(tuple(r)[:2] for r in df.select("a", "b").collect())
    assert rows == [(1, 2.0), (5_000_000_000, 2.5)] and df.select("source_file").distinct().count() == 2
    spark.sql("select 'text' a").write.parquet(f"{tmp_path}/three")
    with pytest.raises(SchemaValidationError, match="column a is (int|string) in .*(one|three)/.*and (int|string) in .*(one|three)/"):
        read_any(spark, [f"{tmp_path}/one", f"{tmp_path}/three"])
    spark.createDataFrame([], "a int").write.parquet(f"{tmp_path}/none")
    with pytest.raises(ValueError, match="no rows"):
        read_any(spark, f"{tmp_path}/none")


def test_streams_of_unlike_files_survive_a_crash(spark, make_raw, tmp_path):
    def drop_in(n, **change):
        raw = make_raw("yellow", *[{"passenger_count": i % 5} for i in range(n)])
        raw.withColumns(change).drop(*[c for c, v in change.items() if v is None]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    drop_in(3)
    drop_in(4, passenger_count=F.col("passenger_count").cast("double"))
    make_raw("yellow", {}, {}).drop("cbd_congestion_fee", "Airport_fee").write.mode("append").parquet(f"{tmp_path}/in")
    folders = (f"{tmp_path}/in", "yellow", f"{tmp_path}/table", f"{tmp_path}/checkpoint")

    def fail(trips):
        raise RuntimeError("crash")

    with pytest.raises(Exception, match="crash"):
        unify_files(spark, *folders, available_now=True, change=fail).awaitTermination()
    for _ in range(2):  # once after the crash, once with nothing new
        unify_files(spark, *folders, available_now=True, max_files_per_trigger=2).awaitTermination()
        assert unified_trips(spark, folders[2], "yellow").count() == 9
    drop_in(5, passenger_count=F.col("passenger_count").cast("double"))
    unify_files(spark, *folders, available_now=True).awaitTermination()
    assert unified_trips(spark, folders[2], "yellow").agg(F.sum("passenger_count")).first()[0] == 3 + 6 + 6 + 10
    counts = windowed_counts(unified_trips(spark, folders[2], "yellow", stream=True), "tpep_pickup_datetime")
    assert counts.isStreaming and counts.columns == ["window_start", "trips"]
    (tmp_path / "in" / "torn.parquet").write_bytes(b"PAR1 torn")
    with pytest.raises(OSError, match="torn.parquet"):
        read_listed(spark, [f"{tmp_path}/in/torn.parquet"], "yellow")
    assert stream_trips(spark, f"{tmp_path}/in", "yellow").isStreaming


def test_key_ranges_hold_every_point_of_the_box(spark):
    draw = random.Random(2)
    points = [(draw.uniform(-1, 9), draw.uniform(-1, 9), datetime(2024, 1, 1) + timedelta(hours=draw.uniform(-9, 220))) for _ in range(2000)]
    points += [(None, 1.0, datetime(2024, 1, 2)), (1.0, 1.0, None), (8.0, 8.0, datetime(2024, 1, 9))]
    df = spark.createDataFrame(points, "lon double, lat double, at timestamp_ntz")
    keyed = df.withColumn("key", st.z_key(F.col("lon"), F.col("lat"), F.col("at"), EXTENT)).collect()
    assert [r.key for r in keyed if r.lon is None or r.at is None] == [-1, -1]
    boxes = [
        {"lon": (1.0, 2.5), "lat": (3.0, 3.1), "time": (datetime(2024, 1, 2), datetime(2024, 1, 4))},
        {"lat": (0.0, 8.0)},
        {"time": (datetime(2024, 1, 8, 12), datetime(2024, 2, 1))},
        {},
    ]
    for most in (8, 256):
        for box in boxes:
            ranges = st.key_ranges(box, EXTENT, most)
            assert ranges == sorted(ranges) and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
            for r in keyed:
                inside = all(
                    v is not None and (box.get(k) is None or box[k][0] <= v <= box[k][1])
                    for k, v in (("lon", r.lon), ("lat", r.lat), ("time", r.at))
                )
                if inside:
                    assert any(low <= r.key <= high for low, high in ranges)
    small = sum(b - a + 1 for a, b in st.key_ranges(boxes[0], EXTENT))
    assert small < (1 << 15) / 20
    assert st.key_ranges({"lon": (3.0, 1.0)}, EXTENT) == []


def test_boxes_read_few_files(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "id", "(id % 97) / 12.2 lon", "(id % 89) / 11.3 lat", "timestampadd(MINUTE, cast(id % 11000 as int), timestamp_ntz'2024-01-01') at"
    )
    hot = spark.range(5000).selectExpr("id + 100000 id", "1.0 lon", "1.0 lat", "timestamp_ntz'2024-01-03' at")
    df = df.unionByName(hot)
    index = st.write_clustered(df, f"{tmp_path}/t", "lon", "lat", "at", EXTENT, 40)
    box = {"lon": (0.9, 2.0), "lat": (1.0, 2.0), "time": (datetime(2024, 1, 2), datetime(2024, 1, 4))}
    found = st.read_box(spark, f"{tmp_path}/t", "lon", "lat", "at", EXTENT, box)
    want = df.where("lon between 0.9 and 2 and lat between 1 and 2 and at between timestamp_ntz'2024-01-02' and timestamp_ntz'2024-01-04'")
    assert found.count() == want.count() > 5000
    assert index.select("path").distinct().count() > 30 and max(r["rows"] for r in index.collect()) < 3000  # the hot key is spread
    empty = st.read_box(spark, f"{tmp_path}/t", "lon", "lat", "at", EXTENT, {"lon": (5.0, 4.0)})
    assert empty.count() == 0


def test_skip_index_never_leaves_out_a_match(spark, tmp_path):
    df = spark.range(4000).selectExpr(
        "id", "case when id % 10 = 0 then null else id % 50 end code", "id / 8 amount", "concat('n', id % 50) name",
        "timestampadd(HOUR, cast(id as int), timestamp_ntz'2024-01-01') at", "date_add(date'2024-01-01', cast(id % 300 as int)) day",
    )
    df.repartitionByRange(12, "id").write.parquet(f"{tmp_path}/t")
    df.where("id < 100").drop("code").write.mode("append").parquet(f"{tmp_path}/t")
    columns = ["id", "code", "amount", "name", "at", "day", "absent"]
    index = si.build_skip_index(spark, f"{tmp_path}/t", columns, bloom=["code", "name", "amount"]).cache()
    assert index.select("path").distinct().count() == 13
    whole = spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/t").select("*", "_metadata.file_path")
    cases = [
        ({"id": (100, 200)}, "id between 100 and 200"),
        ({"id": 17}, "id = 17"),
        ({"amount": 12.5}, "amount = 12.5"),
        ({"amount": (None, 3.0)}, "amount <= 3"),
        ({"code": [3, 7], "id": (0, 500)}, "code in (3, 7) and id between 0 and 500"),
        ({"name": "n7"}, "name = 'n7'"),
        ({"at": (datetime(2024, 1, 3), datetime(2024, 1, 4))}, "at between timestamp_ntz'2024-01-03' and timestamp_ntz'2024-01-04'"),
        ({"day": date(2024, 2, 2)}, "day = date'2024-02-02'"),
        ({"unknown": 3, "id": 5}, "id = 5"),
    ]
    for criteria, condition in cases:
        used = {r.path for r in si.candidate_files(index, criteria).collect()}
        assert {r.file_path.replace("file:///", "file:/") for r in whole.where(condition).select("file_path").distinct().collect()} <= used
    assert si.candidate_files(index, {"id": (100, 200)}).count() <= 2
    assert si.candidate_files(index, {"code": 10_000}).count() == 0 and si.candidate_files(index, {"name": "n99"}).count() <= 1
    assert si.pruned_scan(spark, f"{tmp_path}/t", index, {"id": (5000, None)}).count() == 0
    assert si.pruned_scan(spark, f"{tmp_path}/t", index, {"name": ["n3", "n5"]}).count() == 160 + 4
    with pytest.raises(ValueError, match="no index columns"):
        si.build_skip_index(spark, f"{tmp_path}/t", ["id"], bloom=["name"])


def test_statistics_of_appends_add_up(spark, tmp_path):
    df = spark.range(30_000).selectExpr(
        "id % 9000 key", "if(id % 7 = 0, null, id / 4) amount", "concat('t', id % 11) name", "cast(id as int) part",
        "timestampadd(SECOND, cast(id as int), timestamp_ntz'2024-01-01') at", "cast(null as double) never",
    )
    columns = ["key", "amount", "name", "at", "never"]
    for i in range(3):
        store_stats(df.where(F.col("part") % 3 == i), columns, f"{tmp_path}/s", i)
    store_stats(df.where(F.col("part") % 3 == 1), columns, f"{tmp_path}/s", 1)  # replayed
    compact_stats(spark, f"{tmp_path}/s", f"{tmp_path}/c")
    for folder in ("s", "c"):
        found = {r.attribute: r for r in read_stats(spark, f"{tmp_path}/{folder}", (0.5, 0.9)).collect()}
        assert set(found) == set(columns) and all(r["rows"] == 30_000 for r in found.values())
        assert abs(found["key"].distinct_values - 9000) <= 9000 * DISTINCT_BOUND and found["name"].distinct_values == 11
        assert (found["key"].low, found["key"].high) == (0.0, 8999.0) and abs(found["key"].q50 - 4000) < 300
        assert found["amount"].non_null == df.where("amount is not null").count()
        assert abs(found["amount"].q90 - 6750) < 250
        assert found["never"].non_null == 0 and found["never"].low is None and found["never"].q50 is None
        assert found["name"].low is None
    with pytest.raises(FileNotFoundError):
        read_stats(spark, f"{tmp_path}/absent")


def _book(spark, ledger_dir, batches, query="q"):
    at = datetime(2024, 1, 1)
    for b in batches:
        rows = [(f"/in/{b}-{i}.parquet", f"{b}-{i}.parquet", "green", L.PROCESSED, 1, b, at, at, None) for i in range(2)]
        L.write_batch(spark.createDataFrame(rows, LEDGER_SCHEMA), ledger_dir, f"{query}-{b}")


def _paths(spark, ledger_dir):
    return sorted(r.path for r in L.read_ledger(spark, ledger_dir).collect())


def test_snapshots_of_the_ledger_lose_and_double_nothing(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/ledger"
    assert L.read_ledger(spark, folder).count() == 0 and L.compact_ledger(spark, folder, "q") is None
    _book(spark, folder, range(14))
    _book(spark, folder, range(3), query="other")
    everything = _paths(spark, folder)
    assert len(everything) == 34
    # Ended before the rename: nothing has changed.
    with monkeypatch.context() as m:
        m.setattr(L.files, "move_file", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            L.compact_ledger(spark, folder, "q", recent=2)
    assert _paths(spark, folder) == everything
    # Ended after it: covered folders are passed over, and deleted by the next call.
    with monkeypatch.context() as m:
        m.setattr(L.files, "delete_tree", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            L.compact_ledger(spark, folder, "q", recent=2)
    assert len(files.list_dirs(spark, f"{folder}/query=q")) == 14 and _paths(spark, folder) == everything
    assert L.compact_ledger(spark, folder, "q", recent=2) is None
    assert len(files.list_dirs(spark, f"{folder}/query=q")) == 2
    _book(spark, folder, range(14, 20))
    assert L.compact_ledger(spark, folder, "q", recent=2) == 17
    assert _paths(spark, folder) == sorted(everything + [f"/in/{b}-{i}.parquet" for b in range(14, 20) for i in range(2)])
    assert len(files.list_dirs(spark, f"{folder}/query=q")) == 2
    assert len([d for d in files.list_dirs(spark, folder) if "@upto-" in d]) == 1
    assert L.read_batch(spark, folder, "q-19").count() == 2
    listing = spark.createDataFrame([("/in/3-1.parquet", 1), ("/in/19-0.parquet", 1), ("/in/new.parquet", 1)], "path string, length long")
    assert [r.path for r in L.pending_files(listing, L.read_ledger(spark, folder)).collect()] == ["/in/new.parquet"]
    assert L.read_other_ledgers(spark, folder, "other-1").count() == 40


def test_trips_expire_one_by_one_and_state_is_let_go(spark, make_raw, tmp_path):
    start, day = datetime(2024, 1, 1), timedelta(days=1)
    folders = (f"{tmp_path}/in", "yellow", f"{tmp_path}/table", f"{tmp_path}/c1")

    def run(*pickups):
        make_raw("yellow", *[{"tpep_pickup_datetime": p} for p in pickups]).coalesce(1).write.mode("append").parquet(folders[0])
        unify_files(spark, *folders, available_now=True, clock_col="clock").awaitTermination()
        old = expired_trips(unified_trips(spark, folders[2], "yellow", True, "clock"), "tpep_pickup_datetime", "clock")
        query = old.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True)
        query = query.start(f"{tmp_path}/out")
        query.awaitTermination()
        emitted = spark.read.schema(old.schema).parquet(f"{tmp_path}/out").select("tpep_pickup_datetime").collect()
        return sorted((r[0] for r in emitted), key=str), query.lastProgress.stateOperators[0].numRowsTotal

    assert run(start, start, start + day) == ([], 2)  # copies share a row of state
    # Exactly 30 days old is not expired; a millisecond more is.
    assert run(start + 30 * day) == ([], 3)
    moment = timedelta(milliseconds=1)
    assert run(start + 30 * day + moment) == ([start, start], 3)
    # Late trips and those without a time pass at once; what is late but young enough is held.
    out, held = run(start - 9 * day, None, start + 2 * day)
    assert out == sorted([start, start, start - 9 * day, None], key=str) and held == 4
    out, held = run(start + 90 * day)
    assert len(out) == 8 and held == 1
    everything = unified_trips(spark, folders[2], "yellow")
    assert everything.count() == 9


def test_live_totals_writes_as_many_files_as_its_input_has_parts(spark, monkeypatch):
    limits = []

    def stream(session, path, kind, max_files_per_trigger):
        limits.append(max_files_per_trigger)
        return stream_trips(session, path, kind, max_files_per_trigger=max_files_per_trigger)

    monkeypatch.setattr(stored, "stream_trips", stream)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        found = stored.live_totals(spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(r["batches"] == 2 and r["trips"] == r["written"] > 0 for r in found) and len(found) == 2
    assert min(limits) > 2


@pytest.mark.parametrize("bits", [5, 12, 20])
def test_keys_interleave_in_few_expressions(spark, bits):
    extent = st.Extent((0.0, 8.0), (0.0, 8.0), (datetime(2024, 1, 1), datetime(2024, 1, 9)), bits=bits)
    draw = random.Random(bits)
    rows = [(draw.uniform(0, 8), draw.uniform(0, 8), datetime(2024, 1, 1) + timedelta(hours=draw.uniform(0, 192))) for _ in range(300)]
    df = spark.createDataFrame(rows, "lon double, lat double, at timestamp_ntz")
    key = st.z_key(F.col("lon"), F.col("lat"), F.col("at"), extent)
    for lon, lat, at, found in df.withColumn("key", key).collect():
        cells = [st._cell_of(lon, 0.0, 8.0, bits), st._cell_of(lat, 0.0, 8.0, bits)]
        cells.append(st._cell_of(float(st._micros(at)), *(float(st._micros(t)) for t in extent.time), bits))
        assert found == sum((c >> b & 1) << 3 * b + 2 - i for i, c in enumerate(cells) for b in range(bits))
    assert str(key).count("shiftleft") <= 3 * -(-bits // 6)


def test_replayed_files_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    plans, write = [], stored.trip_files

    def trip_files(*args):
        plans.append(plan_of(write(*args).coalesce(1)))
        return write(*args)

    monkeypatch.setattr(stored, "trip_files", trip_files)
    rows = stored.ingest_replay(spark, SF).collect()
    assert len(rows) == 4 and all((r["files"], r["moved"], r["left_over"]) == (2, 4, 0) for r in rows)
    assert {r["run"]: r["crashes"] for r in rows} == {"calm": 0, "disturbed": 2}
    # Each of the two files of a kind is made once, from half of the rows.
    assert len(plans) == 4 and not any("Exchange" in p for p in plans) and all("staged" in p for p in plans)
