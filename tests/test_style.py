import pytest

from tripflow.functions import style
from tripflow.functions.names import quarantine_name


def collect(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_fare_bands(spark):
    df = spark.createDataFrame([(50.01,), (50.0,), (20.01,), (20.0,), (-5.0,), (None,)], "total_amount double")
    assert collect(df, style.fare_band(), style.fare_colour(), style.fare_size()) == [
        ("High Fare Trips", "#FF0000", 12),
        ("Medium Fare Trips", "#FFA500", 10),
        ("Medium Fare Trips", "#FFA500", 10),
        ("Low Fare Trips", "#00FF00", 8),
        ("Low Fare Trips", "#00FF00", 8),
        ("Default", "#808080", 6),
    ]


@pytest.mark.parametrize(
    "payment, trip_type, passengers, expected",
    [
        (1, 1, 1, ["Credit Card Payment", "Street Hail"]),
        (2, 2, 3, ["Cash Payment", "Dispatch", "Multiple Passengers"]),
        (3, 1, 2, ["Street Hail", "Multiple Passengers"]),
        (None, 1, 2, ["Default"]),
        (4, None, 2, ["Default"]),
        (1, None, None, ["Credit Card Payment"]),
        (5, 3, 1, ["Default"]),
    ],
)
def test_rules(spark, payment, trip_type, passengers, expected):
    df = spark.createDataFrame(
        [(payment, trip_type, passengers)], "payment_type int, trip_type int, passenger_count int"
    )
    assert collect(df, style.matched_rules(), style.is_else()) == [(expected, expected == ["Default"])]


def test_sizes(spark):
    df = spark.createDataFrame([(100.0, 4), (None, None)], "total_amount double, passenger_count int")
    assert collect(df, style.marker_size(), style.passenger_size()) == [(25.0, 12), (None, None)]


def test_route_width(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (4.9,), (5.0,), (10.0,), (None,)], "trip_distance double")
    assert [w for (w,) in collect(df, style.route_width())] == [1, 2, 2, 3, 4, None]
    assert [w for (w,) in collect(df, style.route_width(breaks=[2.0], widths=[7, 9]))] == [7, 7, 9, 9, 9, None]
    with pytest.raises(ValueError):
        style.route_width(breaks=[1.0], widths=[1])


def test_labels(spark):
    schema = "total_amount double, trip_distance double, passenger_count int"
    df = spark.createDataFrame([(31.6, 7.2, 2), (7.0, 1.0, 1), (None, 1.0, 1), (7.0, 1.0, None)], schema)
    assert [v for (v,) in collect(df, style.trip_label())] == [
        "$31.6\n7.2 mi\n2 pax",
        "$7\n1.0 mi\n1 pax",
        None,
        None,
    ]
    assert collect(df, style.total_label())[0] == ("31.6",)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("not_parquet.txt", "not_parquet_why.txt"),
        ("a.b.parquet", "a.b_why.parquet"),
        ("README", "README_why"),
    ],
)
def test_quarantine_name(spark, name, expected):
    df = spark.createDataFrame([(name, "why")], "n string, r string")
    assert collect(df, quarantine_name("n", "r")) == [(expected,)]
