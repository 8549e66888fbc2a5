import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF, YELLOW_ROW, plan_of
from tripflow.plans import catalog
from tripflow.functions import names
from tripflow.operators import documents, schema_ops
from tripflow.operators.quality import violation_report
from tripflow.operators.selection import expire, filter_trips, keep_valid
from tripflow.schemas import GREEN, YELLOW, SchemaValidationError
from tripflow.sources import files, footers
from tripflow.sources.trips import read_any, read_documents, read_green, read_trips, read_yellow, read_zones


def test_read_both_kinds(spark, trip_dir):
    yellow, green = read_yellow(spark, f"{trip_dir}/yellow"), read_green(spark, f"{trip_dir}/green")
    assert yellow.schema == YELLOW.trip_schema and green.schema == GREEN.trip_schema
    assert yellow.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert green.count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_missing_path_and_directory(spark, trip_dir):
    with pytest.raises(FileNotFoundError, match="there is no"):
        read_yellow(spark, f"{trip_dir}/nothing.parquet")
    with pytest.raises(IsADirectoryError, match="is a folder"):
        read_yellow(spark, f"{trip_dir}/yellow", files_only=True)
    single = files.list_files(spark, f"{trip_dir}/yellow")[0].path
    assert read_yellow(spark, single, files_only=True).count() > 0


def test_wrong_kind_is_refused(spark, trip_dir):
    with pytest.raises(SchemaValidationError, match="lpep_pickup_datetime"):
        read_green(spark, f"{trip_dir}/yellow")


def test_file_without_rows(spark, make_raw, tmp_path):
    make_raw("yellow").limit(0).coalesce(1).write.parquet(f"{tmp_path}/empty")
    empty = read_yellow(spark, f"{tmp_path}/empty")
    assert empty.count() == 0 and empty.schema == YELLOW.trip_schema
    with pytest.raises(ValueError, match="no rows"):
        read_any(spark, f"{tmp_path}/empty")


def test_files_of_different_years(spark, make_raw, tmp_path):
    make_raw("yellow").coalesce(1).write.parquet(f"{tmp_path}/new")
    old = make_raw("yellow").drop("Airport_fee", "cbd_congestion_fee")
    old = old.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    old.coalesce(1).write.parquet(f"{tmp_path}/old")
    for order in (["new", "old"], ["old", "new"]):
        both = read_yellow(spark, [f"{tmp_path}/{name}" for name in order])
        got = sorted((r.passenger_count, r.airport_fee is None, r.cbd_congestion_fee is None) for r in both.collect())
        assert got == [(3, False, False), (3, True, True)]


def test_nested_files_of_any_name(spark, make_raw, tmp_path):
    """Two files of one schema and one of another, one without a suffix, one in a nested folder."""
    one = write_one(make_raw("yellow"), tmp_path / "one")
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "new.parquet").write_bytes(one.read_bytes())
    (tmp_path / "in" / "noname").write_bytes(one.read_bytes())
    old = write_one(make_raw("yellow").drop("cbd_congestion_fee"), tmp_path / "two")
    (tmp_path / "in" / "deep" / "old [1].parquet").write_bytes(old.read_bytes())
    got = read_yellow(spark, f"{tmp_path}/in", with_origin=True)
    assert sorted(r.cbd_congestion_fee is None for r in got.collect()) == [False, False, True]
    assert got.select("source_file").distinct().count() == 3
    assert read_any(spark, f"{tmp_path}/in").where("cbd_congestion_fee is null").count() == 1


def test_unreadable_file_fails_the_read(spark, make_raw, tmp_path):
    make_raw("yellow").coalesce(1).write.parquet(f"{tmp_path}/in")
    (tmp_path / "in" / "notes.txt").write_text("hello")
    with pytest.raises(OSError, match="notes.txt"):
        read_yellow(spark, f"{tmp_path}/in")


def test_narrowing_is_flagged(spark, make_raw, tmp_path):
    make_raw("yellow", {"passenger_count": 3_000_000_000}, {}).write.parquet(f"{tmp_path}/in")
    trips = read_yellow(spark, f"{tmp_path}/in", flag_narrowing=True)
    assert sorted((r.passenger_count is None, r.narrowed) for r in trips.collect()) == [(False, False), (True, True)]
    assert [tuple(r) for r in violation_report(trips, "yellow").collect()] == [("yellow", "narrowing", 1)]


def test_valid_only_reaches_the_scan_and_equals_the_filter(spark, trip_dir):
    early = read_green(spark, f"{trip_dir}/green", valid_only=True)
    late = keep_valid(read_green(spark, f"{trip_dir}/green"), "green")
    assert early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty()
    plan = plan_of(early.select("total_amount"))
    pushed = plan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
    assert "passenger_count" in pushed and "trip_type" in pushed


def test_missing_file_is_no_mismatch(spark, tmp_path):
    with pytest.raises(Exception, match="FileNotFound|No such file"):
        probe(spark, tmp_path / "gone.parquet").collect()


def test_footers_from_bytes(spark, make_raw, tmp_path):
    """What is done on file systems that Arrow can't open."""
    path = write_one(make_raw("green"), tmp_path / "g")
    content = spark.read.format("binaryFile").load(str(path)).select("path", "content")
    assert footers.detect_kind(footers.probe_footers(content)).first().kind == "green"


def test_hadoop_names_of_file_systems():
    assert files.is_arrow_path("/a") and files.is_arrow_path("file:/a") and files.is_arrow_path("s3a://b/c")
    assert not files.is_arrow_path("dbfs:/a") and not files.is_arrow_path("wasbs://c@a/b")


def test_origin_identifies_rows(spark, trip_dir):
    trips = read_yellow(spark, f"{trip_dir}/yellow", with_origin=True)
    assert trips.select("source_file", "source_row").distinct().count() == trips.count()


def test_criteria_reach_the_scan(spark, trip_dir):
    criteria = {"vendor": 1, "payment": [1, 2], "distance": (1.0, None), "pickup_time": (datetime(1995, 1, 1), None)}
    df = read_trips(spark, f"{trip_dir}/yellow", "yellow", criteria=criteria).select("total_amount")
    plan = plan_of(df)
    pushed = plan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
    for part in ("EqualTo(VendorID,1)", "trip_distance", "tpep_pickup_datetime", "In(payment_type"):
        assert part in pushed
    schema = plan.split("ReadSchema: ")[1]
    assert "tip_amount" not in schema and "total_amount" in schema


def test_validity_reaches_the_scan(spark, trip_dir):
    plan = plan_of(keep_valid(read_yellow(spark, f"{trip_dir}/yellow"), "yellow").select("total_amount"))
    pushed = plan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
    for part in ("In(VendorID", "IsNotNull(tpep_pickup_datetime)", "In(store_and_fwd_flag"):
        assert part in pushed
    assert "Exchange" not in plan and "Python" not in plan


def test_filter_names_are_checked(make_trips):
    with pytest.raises(ValueError, match="unknown criterion"):
        filter_trips(make_trips("yellow"), "yellow", colour=1)


def test_filters(make_trips):
    trips = make_trips("yellow", {}, {"VendorID": 2}, {"fare_amount": None}, {"trip_distance": 50.0})
    assert filter_trips(trips, "yellow", vendor=1).count() == 3
    assert filter_trips(trips, "yellow", vendor=[1, 2], distance=(7.25, 7.25)).count() == 3
    assert filter_trips(trips, "yellow", fare=(None, 100.0)).count() == 3
    assert filter_trips(trips, "yellow", pickup_zone=88, dropoff_zone=232).count() == 0
    at = datetime(2024, 1, 18, 8, 5)
    assert filter_trips(trips, "yellow", pickup_time=(at, at)).count() == 4


def test_expiry(make_trips):
    trips = make_trips("yellow", {}, {"tpep_pickup_datetime": datetime(2024, 1, 17)}, {"tpep_pickup_datetime": None})
    as_of = datetime(2024, 2, 17, 8, 5)
    assert expire(trips, "tpep_pickup_datetime", as_of).count() == 1
    assert expire(trips, "tpep_pickup_datetime", as_of, days=32).count() == 2
    assert expire(trips, "tpep_pickup_datetime").count() == 0


def test_documents(spark, make_trips, tmp_path):
    trips = make_trips("yellow", {}, {"passenger_count": None, "trip_distance": None})
    doc = json.loads(documents.to_documents(trips, "yellow").first().doc)
    assert list(doc) == YELLOW.trip_schema.names
    assert doc["tpep_pickup_datetime"] == "2024-01-18T08:05:00" and doc["VendorID"] == 1
    derived = json.loads(documents.to_documents(trips, "yellow", include_derived=True).first().doc)
    assert derived["valid"] is True and derived["tripDurationMinutes"] == 45
    assert tuple(documents.round_trip_mismatches(trips, "yellow").first()) == (2, 0)
    assert tuple(documents.serialization_rate(trips, "yellow").first()) == (2, 2, 1.0)
    broken = trips.sparkSession.createDataFrame([("{nope",), (None,), (json.dumps(doc),)], "doc string")
    assert tuple(documents.document_rate(broken, "yellow").first())[:2] == (3, 1)
    documents.to_documents(trips, "yellow", include_derived=True).write.text(f"{tmp_path}/docs")
    assert read_documents(spark, f"{tmp_path}/docs", "yellow").exceptAll(trips).count() == 0


def test_fractional_seconds_survive(make_trips):
    trips = make_trips("green", {"lpep_pickup_datetime": datetime(2024, 1, 18, 8, 5, 0, 120)})
    assert tuple(documents.round_trip_mismatches(trips, "green").first()) == (1, 0)


def test_document_with_unknown_and_missing_fields(spark):
    doc = json.dumps({"VendorID": 2, "tpep_pickup_datetime": "2024-01-18T08:05", "surprise": [1]})
    df = spark.createDataFrame([(doc,)], "doc string")
    trip = documents.from_documents(df, "yellow").first()
    assert (trip.VendorID, trip.tpep_pickup_datetime, trip.fare_amount) == (2, datetime(2024, 1, 18, 8, 5), None)


def test_malformed_document(spark):
    df = spark.createDataFrame([("{nope",)], "doc string")
    with pytest.raises(Exception):
        documents.from_documents(df, "yellow").collect()
    assert documents.from_documents(df, "yellow", strict=False).first().VendorID is None


def test_zones(spark, tmp_path):
    spark.createDataFrame([(1, -74.0, 40.5)], "zone_id long, lon double, lat double").write.parquet(f"{tmp_path}/z")
    assert tuple(read_zones(spark, f"{tmp_path}/z").first()) == (1, -74.0, 40.5)


def probe(spark, *paths):
    frame = files.file_frame(spark, [files.FileInfo(str(p), 0) for p in paths])
    return footers.probe_footers(frame, len(paths))


def write_one(df, folder):
    df.coalesce(1).write.parquet(str(folder))
    return next(folder.glob("*.parquet"))


def test_kind_detection(spark, make_raw, tmp_path):
    yellow = write_one(make_raw("yellow"), tmp_path / "y")
    green = write_one(make_raw("green"), tmp_path / "g")
    fewer = write_one(make_raw("yellow").drop("extra"), tmp_path / "fewer")
    reordered = make_raw("green").select(*reversed(GREEN.file_schema.names))
    reordered = write_one(reordered, tmp_path / "r")
    other = spark.createDataFrame([("k7", 0.5)], "sensor string, reading double")
    other = write_one(other, tmp_path / "o")
    no_rows = write_one(make_raw("yellow").limit(0), tmp_path / "n")
    zero = tmp_path / "zero.parquet"
    zero.touch()
    spaced = tmp_path / "with space [1] #2.parquet"
    spaced.write_bytes(yellow.read_bytes())
    paths = [yellow, green, fewer, reordered, other, no_rows, zero, spaced]
    kinds = {}
    for mode in ("lenient", "strict"):
        rows = footers.detect_kind(probe(spark, *paths), mode).collect()
        kinds[mode] = {r.path: r.kind for r in rows}
    expected = ["yellow", "green", "yellow", "green", "unknown", "unknown", "unknown", "yellow"]
    assert [kinds["lenient"][str(p)] for p in paths] == expected
    expected = ["yellow", "green", "unknown", "unknown", "unknown", "unknown", "unknown", "yellow"]
    assert [kinds["strict"][str(p)] for p in paths] == expected
    with pytest.raises(ValueError):
        footers.detect_kind(probe(spark, yellow), "vague")


def test_probe_contents(spark, make_raw, tmp_path):
    path = write_one(make_raw("green", {}, {}), tmp_path / "g")
    zero = tmp_path / "zero.parquet"
    zero.touch()
    good, bad = sorted(probe(spark, path, zero).collect(), key=lambda r: r.error is not None)
    assert good.num_rows == 2 and good.columns == GREEN.file_schema.names
    assert good.fingerprint == footers.schema_fingerprint(GREEN.file_schema)
    assert json.loads(good.schema_json)["fields"][0] == {"name": "VendorID", "type": "int", "nullable": True}
    assert bad.columns is None and bad.num_rows is None and bad.error


def test_schema_as_json_and_sql(spark, make_raw):
    raw = make_raw("yellow")
    assert json.loads(schema_ops.schema_json(raw))["fields"][0]["name"] == "VendorID"
    ddl = schema_ops.column_definitions(raw.schema)
    assert ddl[:4] == [
        '"VendorID" INTEGER',
        '"tpep_pickup_datetime" TIMESTAMP',
        '"tpep_dropoff_datetime" TIMESTAMP',
        '"passenger_count" BIGINT',
    ]
    assert '"trip_distance" DOUBLE PRECISION' in ddl and '"store_and_fwd_flag" TEXT' in ddl
    odd = spark.sql("select 1 as `a b`, true as t, cast(1 as float) f, X'00' as x, array(1) as `l\"`")
    assert schema_ops.ddl_types(odd.schema) == (
        '"a_b" INTEGER NOT NULL, "t" BOOLEAN NOT NULL, "f" REAL NOT NULL, "x" BYTEA NOT NULL, "l_" TEXT NOT NULL'
    )
    assert schema_ops.create_table_sql("public.trips", odd.select("t").schema, if_not_exists=True) == (
        'CREATE TABLE IF NOT EXISTS "public"."trips" ("t" BOOLEAN NOT NULL)'
    )
    assert schema_ops.sanitize_columns(odd).columns == ["a_b", "t", "f", "x", "l_"]


@pytest.mark.parametrize(
    "function, text, expected",
    [
        (names.sanitize_table_name, "Trips of May/June", "trips_of_may_june"),
        (names.sanitize_column_name, "Fare Amount($)", "Fare_Amount___"),
        (names.derive_table_name, "/in/yellow_tripdata_2025_01.parquet", "yellow_tripdata_2025_01"),
        (names.derive_table_name, "a.tar.gz", "a.tar"),
        (names.derive_table_name, "/in/.hidden", ".hidden"),
        (names.derive_table_name, "plain", "plain"),
        (names.quote_identifier, 'a"b', '"a""b"'),
    ],
)
def test_names(spark, function, text, expected):
    df = spark.createDataFrame([(text,)], "n string")
    assert df.select(function("n")).first()[0] == expected


def test_yellow_row_matches_file_schema():
    assert list(YELLOW_ROW) == YELLOW.file_schema.names


def test_rows_of_tables_that_are_folders(spark, tmp_path):
    spark.range(7).coalesce(1).write.parquet(f"{tmp_path}/staged")
    (single,) = (tmp_path / "staged").glob("*.parquet")
    single.rename(tmp_path / "one.parquet")
    spark.range(100).repartition(5).write.parquet(f"{tmp_path}/many.parquet")
    spark.range(40).withColumn("k", F.col("id") % 4).write.partitionBy("k").parquet(f"{tmp_path}/deep.parquet")
    spark.range(3).repartition(2).write.parquet(f"{tmp_path}/torn.parquet")
    (tmp_path / "torn.parquet" / "part.parquet").write_bytes(b"PAR1 torn")
    found = {r.table_name: r.n_rows for r in footers.table_rows(spark, str(tmp_path)).collect()}
    assert found == {"one": 7, "many": 100, "deep": 40, "torn": None}
    assert catalog.footer_counts(spark, str(tmp_path)).count() == 4
