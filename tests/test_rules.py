from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SPECS
from tripflow.functions import rules
from tripflow.operators.normalize import normalize
from tripflow.operators.quality import valid_share, violation_report, with_quality
from tripflow.operators.selection import keep_valid, street_hails

PICKUP = datetime(2024, 1, 18, 8, 5)


def checked(df, kind):
    return [(r.is_valid, r.violation, r.violations) for r in with_quality(df, kind).collect()]


@pytest.mark.parametrize("kind", ["yellow", "green"])
def test_unchanged_row_is_valid(make_trips, kind):
    assert checked(make_trips(kind), kind) == [(True, None, [])]


CASES = [
    ("yellow", {"VendorID": 3}, "vendor_code"),
    ("yellow", {"VendorID": None}, "vendor_code"),
    ("yellow", {"tpep_pickup_datetime": None}, "missing_datetime"),
    ("yellow", {"tpep_dropoff_datetime": None}, "missing_datetime"),
    ("yellow", {"tpep_dropoff_datetime": datetime(2024, 1, 18, 8, 4)}, "dropoff_before_pickup"),
    ("yellow", {"store_and_fwd_flag": "X"}, "store_and_fwd_flag"),
    ("yellow", {"store_and_fwd_flag": "y"}, "store_and_fwd_flag"),
    ("yellow", {"store_and_fwd_flag": None}, "store_and_fwd_flag"),
    ("yellow", {"passenger_count": -1}, "passenger_count"),
    ("yellow", {"trip_distance": -0.1}, "trip_distance"),
    ("green", {"VendorID": 7}, "vendor_code"),
    ("green", {"trip_type": 3}, "trip_type"),
    ("green", {"trip_type": 0}, "trip_type"),
]


@pytest.mark.parametrize("kind, change, rule", CASES)
def test_one_broken_rule(make_trips, kind, change, rule):
    assert checked(make_trips(kind, change), kind) == [(False, rule, [rule])]


@pytest.mark.parametrize(
    "kind, change",
    [
        ("yellow", {"VendorID": 7}),
        ("yellow", {"tpep_dropoff_datetime": PICKUP}),
        ("yellow", {"passenger_count": None}),
        ("yellow", {"passenger_count": 0}),
        ("yellow", {"trip_distance": None}),
        ("yellow", {"trip_distance": float("nan")}),
        ("yellow", {"trip_distance": -0.0}),
        ("yellow", {"store_and_fwd_flag": "Y"}),
        ("green", {"trip_type": None}),
        ("green", {"trip_type": 2}),
    ],
)
def test_edge_values_are_valid(make_trips, kind, change):
    assert checked(make_trips(kind, change), kind) == [(True, None, [])]


def test_order_of_rules(make_trips):
    broken = {"VendorID": 9, "store_and_fwd_flag": None, "passenger_count": -2, "trip_distance": -1.0}
    assert checked(make_trips("yellow", broken), "yellow") == [
        (False, "vendor_code", ["vendor_code", "store_and_fwd_flag", "passenger_count", "trip_distance"])
    ]


def test_narrowing_is_reported(make_raw):
    trips = normalize(make_raw("yellow", {"RatecodeID": 2**40}), "yellow", flag_narrowing=True)
    assert checked(trips, "yellow") == [(True, None, ["narrowing"])]
    assert [tuple(r) for r in violation_report(trips, "yellow").collect()] == [("yellow", "narrowing", 1)]


def test_share_and_report(make_trips):
    trips = make_trips("green", {}, {}, {"trip_type": 5}, {"trip_type": 5, "VendorID": None})
    assert tuple(valid_share(trips, "green").first()) == (4, 2, 0.5)
    report = {r.rule: r.trips for r in violation_report(trips, "green").collect()}
    assert report == {"trip_type": 2, "vendor_code": 1}


def test_street_hails(make_trips):
    trips = make_trips("green", {}, {"trip_type": 2}, {"trip_type": None}, {"VendorID": 9})
    assert street_hails(trips).count() == 1


def trip_changes(kind):
    spec = SPECS[kind]
    times = st.none() | st.integers(-3, 3).map(lambda m: PICKUP + timedelta(minutes=m))
    fields = {
        "VendorID": st.sampled_from([None, 0, 1, 2, 3, 6, 7, 99]),
        spec.pickup: times,
        spec.dropoff: times,
        "store_and_fwd_flag": st.sampled_from([None, "Y", "N", "n", ""]),
        "passenger_count": st.sampled_from([None, -1, 0, 4]),
        "trip_distance": st.sampled_from([None, -1.0, -0.0, 0.0, 2.5, float("nan"), float("inf")]),
    }
    if kind == "green":
        fields["trip_type"] = st.sampled_from([None, 0, 1, 2, 3])
    return st.fixed_dictionaries(fields)


@pytest.mark.parametrize("kind", ["yellow", "green"])
@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_valid_means_no_violation(make_trips, kind, data):
    changes = data.draw(st.lists(trip_changes(kind), min_size=60, max_size=200))
    trips = make_trips(kind, *changes)
    for valid, first, every in checked(trips, kind):
        assert valid == (first is None) == (not every)
        assert first is None or every[0] == first
    assert keep_valid(trips, kind).count() == trips.filter(rules.is_valid(kind)).count()
