from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF, plan_of
from tripflow.operators import dimensions, features
from tripflow.operators.selection import filter_trips
from tripflow.plans.testbed import raw_trips, zones


@pytest.fixture
def two_zones(spark):
    return spark.createDataFrame([(88, -73.5, 40.5), (231, -74.25, 41.0)], "zone_id int, lon double, lat double")


def test_zone_lookup(make_trips, two_zones):
    trips = make_trips("yellow", {}, {"PULocationID": 1}, {"DOLocationID": None})
    got = features.with_zones(trips, two_zones).select("pu_lon", "pu_lat", "do_lon", "do_lat").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(-73.5, 40.5, -74.25, 41.0), (None, None, -74.25, 41.0), (-73.5, 40.5, None, None)], key=str
    )


def test_broadcast_needs_a_checked_size(spark, make_trips, two_zones):
    assert "BroadcastHashJoin" in plan_of(features.with_zones(make_trips("yellow"), two_zones))
    large = spark.range(50).select(F.col("id").cast("int").alias("zone_id"))
    assert "ResolvedHint" in dimensions.broadcast_if_small(large, 50)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in dimensions.broadcast_if_small(large, 49)._jdf.queryExecution().analyzed().toString()


def test_hot_zone_without_broadcast(spark, monkeypatch):
    """Every trip from one zone and a lookup table over the bound: same rows, shuffled join."""
    trips = raw_trips(spark, SF, "yellow").withColumn("PULocationID", F.lit(132))
    expected = features.with_zones(trips, zones(spark)).select("VendorID", "pu_lon", "do_lat")
    monkeypatch.setattr(dimensions, "MAX_BROADCAST_ROWS", 10)
    monkeypatch.setattr(features, "broadcast_if_small", lambda z: dimensions.broadcast_if_small(z, 10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = features.with_zones(trips, zones(spark)).select("VendorID", "pu_lon", "do_lat")
        assert "SortMergeJoin" in plan_of(shuffled)
        assert shuffled.exceptAll(expected).isEmpty() and expected.exceptAll(shuffled).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "geometry, wkt",
    [
        ("pickup", "POINT (-73.5 40.5)"),
        ("dropoff", "POINT (-74.25 41.0)"),
        ("line", "LINESTRING (-73.5 40.5, -74.25 41.0)"),
    ],
)
def test_feature_table(make_raw, two_zones, geometry, wkt):
    raw = make_raw("yellow", {"tpep_pickup_datetime": datetime(2024, 1, 18, 8, 5, 0, 123456)})
    row = features.to_features(raw, "yellow", two_zones, geometry).first()
    assert (row.geom, row.srid) == (wkt, 4326)
    assert row.tpep_pickup_datetime == datetime(2024, 1, 18, 8, 5, 0, 123000)
    assert list(row.asDict())[2:] == raw.columns


def test_typed_trips_as_features(make_trips, two_zones):
    features_df = features.to_features(make_trips("green"), "green", two_zones)
    assert features_df.schema["passenger_count"].dataType.simpleString() == "bigint"
    assert features_df.first().ehail_fee is None


def test_unknown_geometry(make_raw, two_zones):
    with pytest.raises(ValueError):
        features.to_features(make_raw("green"), "green", two_zones, "area")


def test_unknown_zone_has_no_geometry(make_raw, two_zones):
    raw = make_raw("green", {"PULocationID": 5}, {"DOLocationID": None})
    lines = features.to_features(raw, "green", two_zones, "line").collect()
    assert len(lines) == 2 and all(r.geom is None for r in lines)


def test_point_features_join_once(make_raw, two_zones):
    assert plan_of(features.to_features(make_raw("green"), "green", two_zones)).count("BroadcastHashJoin") == 1


def points(spark, n, trip="a", first=0):
    return [(trip, i, float(i), 1.0) for i in range(first, first + n)]


POINT_SCHEMA = "trip string, seq int, lon double, lat double"


def test_route_in_one_part(spark):
    df = spark.createDataFrame(points(spark, 3)[::-1] + points(spark, 1, "b"), POINT_SCHEMA)
    got = {r.trip: (r.part_no, r.n_points, r.geom) for r in features.route_lines(df, ["trip"]).collect()}
    assert got == {"a": (0, 3, "LINESTRING (0.0 1.0, 1.0 1.0, 2.0 1.0)"), "b": (0, 1, None)}


def segments(geoms):
    out = []
    for geom in geoms:
        at = geom[len("LINESTRING (") : -1].split(", ")
        out += list(zip(at, at[1:]))
    return out


@pytest.mark.parametrize("stretch", [3, 10_000])
@pytest.mark.parametrize("step", [1, 7, 10_000])
@pytest.mark.parametrize("n", [4, 5, 6, 8, 9, 10])
def test_route_parts_hold_every_segment_once(spark, monkeypatch, n, step, stretch):
    monkeypatch.setattr(features, "RANK_STRETCH", stretch)
    df = spark.createDataFrame([("a", 9999 + i * step, float(i), 1.0) for i in range(n)], POINT_SCHEMA)
    parts = features.route_lines(df, ["trip"], part_points=4).orderBy("part_no").collect()
    assert [p.part_no for p in parts] == list(range(-(-(n - 1) // 4)))
    assert all(p.geom is not None and 2 <= p.n_points <= 5 for p in parts)
    at = [f"{float(i)} 1.0" for i in range(n)]
    assert segments(p.geom for p in parts) == list(zip(at, at[1:]))


def test_route_keeps_equal_positions(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 0.0), ("a", 1, 1.0, 0.0), ("a", 2, 0.0, 0.0), ("a", 1, 1.0, 0.0)], POINT_SCHEMA)
    row = features.route_lines(df, ["trip"]).first()
    assert (row.n_points, row.geom) == (4, "LINESTRING (1.0 0.0, 1.0 0.0, 2.0 0.0, 0.0 0.0)")


def test_route_ties_are_ordered_by_the_given_columns(spark):
    df = spark.createDataFrame([("a", 1, 2, 5.0, 0.0), ("a", 1, 1, 9.0, 0.0)], "trip string, seq int, tie int, lon double, lat double")
    assert features.route_lines(df, ["trip"], ties=["tie"]).first().geom == "LINESTRING (9.0 0.0, 5.0 0.0)"


def test_route_with_a_missing_coordinate_has_no_line(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 0.0), ("a", 2, None, 0.0), (None, 1, 1.0, 1.0), (None, 2, 1.0, 2.0)], POINT_SCHEMA)
    got = {r.trip: (r.n_points, r.geom) for r in features.route_lines(df, ["trip"]).collect()}
    assert got == {"a": (2, None), None: (2, "LINESTRING (1.0 1.0, 1.0 2.0)")}


def test_layout_pruning_and_purge(spark, two_zones, make_raw, tmp_path):
    days = [datetime(2024, 1, d, 10, 30) for d in (1, 10, 20)]
    raw = make_raw("green", *({"lpep_pickup_datetime": d} for d in days), {"lpep_pickup_datetime": None})
    path = str(tmp_path / "features")
    features.write_features(features.to_features(raw, "green", two_zones), "green", path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    recent = filter_trips(stored, "green", pickup_time=(datetime(2024, 1, 15), None))
    assert recent.count() == 1
    assert "PartitionFilters: [isnotnull(pickup_date" in plan_of(recent)
    removed = features.purge_expired(spark, path, datetime(2024, 2, 9, 12), days=30)
    assert removed == [date(2024, 1, 1)]
    assert spark.read.parquet(path).count() == 2
    assert features.purge_expired(spark, path, datetime(2024, 2, 9, 12), days=30) == []


def test_hot_date_is_split(spark, two_zones, make_raw, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    try:
        raw = make_raw("yellow").crossJoin(spark.range(60_000).withColumn("x", F.rand(1))).drop("id")
        raw = raw.withColumn("tip_amount", F.col("x")).drop("x").repartition(8)
        path = tmp_path / "hot"
        features.write_features(raw, "yellow", str(path))
        assert len(list(path.glob("pickup_date=2024-01-18/*.parquet"))) > 1
        assert spark.read.parquet(str(path)).count() == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_attribute_stats(spark):
    raw = raw_trips(spark, SF, "yellow")
    exact = {r.attribute: r for r in features.attribute_stats(raw, ["VendorID", "tip_amount"], exact=True).collect()}
    assert (exact["VendorID"].min_value, exact["VendorID"].max_value) == ("1", "7")
    assert exact["VendorID"].distinct_values == 5 and exact["tip_amount"].distinct_values == 20
    sketch = {r.attribute: r for r in features.attribute_stats(raw, ["VendorID", "tip_amount"]).collect()}
    for name, row in exact.items():
        assert sketch[name][:4] == row[:4]
        assert abs(sketch[name].distinct_values - row.distinct_values) <= 0.1 * row.distinct_values
