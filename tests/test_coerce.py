from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import coerce
from tripflow.operators.normalize import check_schema, normalize
from tripflow.schemas import GREEN, YELLOW, SchemaValidationError


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_int_overflow_is_null_and_flagged(spark):
    df = spark.createDataFrame([(5,), (3_000_000_000,), (None,)], "v bigint")
    assert values(df, coerce.to_int("v"), coerce.is_narrowed("v")) == [(5, False), (None, True), (None, False)]


def test_int_from_double_truncates(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (float("nan"),)], "v double")
    assert values(df, coerce.to_int("v")) == [(1,), (-1,), (None,)]


def test_optional_column(spark):
    df = spark.createDataFrame([(1.5,)], "Airport_fee double")
    assert values(df, coerce.optional(df, "airport_fee", "double"), coerce.optional(df, "none", "double")) == [
        (1.5, None)
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-18 08:05:00", datetime(2024, 1, 18, 8, 5)),
        ("2024-01-18T08:05:00", datetime(2024, 1, 18, 8, 5)),
        ("2024-01-18T08:05", datetime(2024, 1, 18, 8, 5)),
        ("2024-01-18T08:05:00.25", datetime(2024, 1, 18, 8, 5, 0, 250000)),
        ("2024-02-30 10:00:00", datetime(2024, 2, 29, 10, 0)),
        ("2024-02-30T10:00:00", None),
        ("2024-01-18 24:00:00", datetime(2024, 1, 19)),
        ("2024-01-18T24:00:00", None),
        ("2024-13-01 10:00:00", None),
        ("2024-01-32 10:00:00", None),
        ("2024-01-18", None),
        ("2024-01-18 08:05", None),
        ("2024-01-18T08:05:00Z", None),
        ("15/01/2024 10:30", None),
        ("", None),
        (None, None),
    ],
)
def test_datetime_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert values(df, coerce.to_datetime("t", T.StringType(), strict=False)) == [(expected,)]


def test_strict_datetime_fails_on_bad_text_only(spark):
    good = spark.createDataFrame([("2024-01-18 08:05:00",), (None,)], "t string")
    assert values(good, coerce.to_datetime("t", T.StringType())) == [(datetime(2024, 1, 18, 8, 5),), (None,)]
    bad = spark.createDataFrame([("soon",)], "t string")
    with pytest.raises(Exception, match="no datetime: soon"):
        bad.select(coerce.to_datetime("t", T.StringType())).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_datetimes_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day; as a wall clock it does.
        df = spark.createDataFrame([(1710037800_250000, "2024-03-10 02:30:00")], "us bigint, t string").select(
            coerce.to_datetime("us", T.LongType()).alias("a"), coerce.to_datetime("t", T.StringType()).alias("b")
        )
        got = values(
            df,
            "a",
            "b",
            coerce.epoch_micros("a"),
            coerce.to_millis_precision("a").cast("string"),
            coerce.duration_minutes(F.expr("b - interval 2 hours"), "b"),
        )
        assert got == [
            (
                datetime(2024, 3, 10, 2, 30, 0, 250000),
                datetime(2024, 3, 10, 2, 30),
                1710037800_250000,
                "2024-03-10 02:30:00.25",
                120,
            )
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_micros_before_1970(spark):
    df = spark.createDataFrame([(-500_000,)], "us bigint")
    assert values(df, coerce.to_datetime("us", T.LongType())) == [(datetime(1969, 12, 31, 23, 59, 59, 500000),)]


@pytest.mark.parametrize(
    "seconds, minutes",
    [(45 * 60, 45), (270 * 60, 270), (0, 0), (59, 0), (-59.5, -1), (-59, 0), (-60, -1), (-60.5, -1), (60.999999, 1)],
)
def test_duration(spark, seconds, minutes):
    df = spark.range(1).select(
        F.expr("timestamp_ntz'2024-01-18 08:05:00'").alias("p"),
        F.expr(f"timestamp_ntz'2024-01-18 08:05:00' + interval '{seconds}' second").alias("d"),
    )
    assert values(df, coerce.duration_minutes("p", "d")) == [(minutes,)]


def test_duration_of_missing_time_is_null(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), None)], "p timestamp_ntz, d timestamp_ntz")
    assert values(df, coerce.duration_minutes("p", "d")) == [(None,)]


def test_canonical_columns(make_raw):
    yellow, green = normalize(make_raw("yellow"), "yellow"), normalize(make_raw("green"), "green")
    assert yellow.schema == YELLOW.trip_schema and green.schema == GREEN.trip_schema
    assert len(yellow.columns) == len(green.columns) == 20
    assert "airport_fee" in yellow.columns and "ehail_fee" not in green.columns


def test_either_spelling_of_the_airport_fee(make_raw):
    raw = make_raw("yellow", {"Airport_fee": 1.75})
    assert normalize(raw, "yellow").first().airport_fee == 1.75
    assert normalize(raw.withColumnRenamed("Airport_fee", "airport_fee"), "yellow").first().airport_fee == 1.75
    assert normalize(raw.drop("Airport_fee", "cbd_congestion_fee"), "yellow").first().airport_fee is None


def test_schema_check_names_every_missing_column(make_raw):
    raw = make_raw("yellow").drop("VendorID", "extra", "cbd_congestion_fee")
    with pytest.raises(SchemaValidationError, match=r"not there: VendorID, extra$"):
        check_schema(raw, "yellow")


def test_schema_report(make_raw):
    report = check_schema(make_raw("yellow"), "yellow")
    assert (report.required, report.optional_present) == (18, 2)
    report = check_schema(make_raw("green").drop("cbd_congestion_fee", "ehail_fee"), "green")
    assert (report.required, report.optional_present) == (19, 0)


def test_text_in_a_number_column_is_refused(make_raw):
    raw = make_raw("yellow").withColumn("trip_distance", F.lit("far"))
    with pytest.raises(SchemaValidationError, match="trip_distance is not a number"):
        normalize(raw, "yellow")


def test_narrowing_flag(make_raw):
    raw = make_raw("yellow", {}, {"passenger_count": 3_000_000_000})
    rows = normalize(raw, "yellow", flag_narrowing=True).select("passenger_count", "narrowed").collect()
    assert [tuple(r) for r in rows] == [(3, False), (None, True)]


def test_other_physical_types(make_raw):
    raw = (
        make_raw("yellow")
        .withColumn("passenger_count", F.col("passenger_count").cast("double"))
        .withColumn("fare_amount", F.col("fare_amount").cast("float"))
        .withColumn("tpep_pickup_datetime", F.lit("2024-01-18 08:05:00"))
        .withColumn("tpep_dropoff_datetime", F.lit(1705567800000000))
    )
    trip = normalize(raw, "yellow").first()
    assert (trip.passenger_count, trip.fare_amount) == (3, 21.75)
    assert trip.tpep_dropoff_datetime == datetime(2024, 1, 18, 8, 50)
