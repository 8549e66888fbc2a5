"""Spatial features of trips: zone lookup, geometries, table layout, statistics, expiry."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geometry import SRID, coordinate, line_of, line_through, point_through
from ..schemas import TripKind, kind_of
from ..sources import files
from .dimensions import broadcast_if_small
from .normalize import feature_attributes
from .selection import RETENTION_DAYS

PART_POINTS = 10_000
# Fixed value: Spark's folder name for a null partition value.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
# Positions (values of ``seq``) whose points one task ranks together.
RANK_STRETCH = 10_000


def _join_zone(trips: DataFrame, zones: DataFrame, key: str, prefix: str) -> DataFrame:
    """Left join on one location column; the zone's other columns get the prefix."""
    side = zones.select(
        F.col("zone_id").alias(f"__{prefix}id"),
        *[F.col(c).alias(f"{prefix}{c}") for c in zones.columns if c != "zone_id"],
    )
    return trips.join(side, F.col(key) == F.col(f"__{prefix}id"), "left").drop(f"__{prefix}id")


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds pickup and drop-off coordinates; null where the zone is unknown.

    ``zones`` has one row per ``zone_id``.
    """
    zones = broadcast_if_small(zones.select("zone_id", "lon", "lat"))
    return _join_zone(_join_zone(trips, zones, "PULocationID", "pu_"), zones, "DOLocationID", "do_")


def to_features(trips: DataFrame, kind: str | TripKind, zones: DataFrame, geometry: str = "pickup") -> DataFrame:
    """Feature table: ``geom`` (WKT), ``srid``, then all trip attributes in file order.

    ``geometry`` is "pickup" or "dropoff" (a point) or "line". Takes file columns or typed
    trips; attributes have the file types, datetimes at millisecond precision. The default time
    is the pickup time. Coordinates become text once per zone, not once per trip.
    """
    kind = kind_of(kind)
    if geometry not in ("pickup", "dropoff", "line"):
        raise ValueError(f"geometry is 'pickup', 'dropoff' or 'line', not {geometry!r}")
    places = broadcast_if_small(zones.select("zone_id", coordinate("lon", "lat").alias("at")))
    joined = trips
    if geometry != "dropoff":
        joined = _join_zone(joined, places, "PULocationID", "__pu_")
    if geometry != "pickup":
        joined = _join_zone(joined, places, "DOLocationID", "__do_")
    geom = {"pickup": point_through("__pu_at"), "dropoff": point_through("__do_at")}.get(
        geometry, line_through("__pu_at", "__do_at")
    )
    return joined.select(geom.alias("geom"), F.lit(SRID).alias("srid"), *feature_attributes(joined, kind))


def _ranked(points: DataFrame, trip_keys: Sequence[str], seq: str, ties: Sequence[str]) -> DataFrame:
    """Adds ``__rank``, the place of a point in its trip from 0.

    Points are ranked within stretches of ``RANK_STRETCH`` positions, to which the number of points of
    earlier stretches is added. A trip that holds most of the points is thereby spread over many tasks.
    """
    stretch = points.withColumn("__stretch", F.floor(F.col(seq) / F.lit(RANK_STRETCH)))
    counts = stretch.groupBy(*trip_keys, "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*trip_keys).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    keys = [*trip_keys, "__stretch"]
    other = counts.select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)], "__before")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__c{i}")) for i, k in enumerate(keys)])
    within = Window.partitionBy(*keys).orderBy(F.col(seq), *ties, "lon", "lat")
    return (
        stretch.join(other, same)
        .drop(*[f"__c{i}" for i in range(len(keys))])
        .withColumn("__rank", F.col("__before") + F.row_number().over(within) - 1)
    )


def route_lines(
    points: DataFrame,
    trip_keys: Sequence[str],
    seq: str = "seq",
    ties: Sequence[str] = (),
    part_points: int = PART_POINTS,
) -> DataFrame:
    """Route geometries from coordinate sequences ``(trip keys, seq, lon, lat)``.

    One row per part of a trip: ``(trip keys, part_no, n_points, geom, srid)``. The points of a trip are
    put in order of ``seq``, then ``ties``, longitude and latitude; no two are merged. Part ``k`` runs from
    the point of rank ``k * part_points`` to that of rank ``(k + 1) * part_points``, or to the last one, so
    consecutive parts share an end, every segment is in one part, and no task gathers more than
    ``part_points + 1`` points. Gaps in ``seq`` don't matter. A trip of one point has a part without a line;
    a part with a missing coordinate has a null ``geom`` as well, like any line.
    """
    if part_points < 1:
        raise ValueError("part_points must be positive")
    ranked = _ranked(points.select(*trip_keys, seq, *ties, "lon", "lat"), trip_keys, seq, ties)
    part = F.floor(F.col("__rank") / F.lit(part_points)).cast("bigint")
    closes_previous = (F.pmod("__rank", F.lit(part_points)) == 0) & (F.col("__rank") > 0)
    placed = ranked.select(
        *trip_keys,
        F.explode(F.when(closes_previous, F.array(part - 1, part)).otherwise(F.array(part))).alias("part_no"),
        F.struct("__rank", coordinate("lon", "lat").alias("at")).alias("__point"),
    )
    grouped = placed.groupBy(*trip_keys, "part_no").agg(F.sort_array(F.collect_list("__point")).alias("__points"))
    n_points = F.size("__points")
    # A last part that only holds the end of the one before it is no part.
    return grouped.filter((n_points > 1) | (F.col("part_no") == 0)).select(
        *trip_keys,
        "part_no",
        n_points.alias("n_points"),
        F.when(n_points > 1, line_of(F.col("__points.at"))).alias("geom"),
        F.lit(SRID).alias("srid"),
    )


def with_pickup_date(df: DataFrame, kind: str | TripKind) -> DataFrame:
    return df.withColumn("pickup_date", F.to_date(kind_of(kind).pickup))


def write_features(features: DataFrame, kind: str | TripKind, path: str, mode: str = "append") -> None:
    """Parquet partitioned by pickup date, sorted by pickup zone within each file.

    The rebalance hint gathers a date into few files, yet lets AQE split a date that is too
    large for one task.
    """
    dated = with_pickup_date(features, kind)
    (
        dated.hint("rebalance", "pickup_date")
        .sortWithinPartitions("pickup_date", "PULocationID")
        .write.mode(mode)
        .partitionBy("pickup_date")
        .parquet(path)
    )


def purge_expired(spark: SparkSession, path: str, as_of: datetime, days: int = RETENTION_DAYS) -> list[date]:
    """Delete the date partitions of a feature table that lie wholly before the expiry time.

    Rows of the boundary date that are also too old stay on disk; ``expire`` hides them. The partition of
    trips without a pickup time goes too, since ``expire`` never shows those. Returns the dates.
    """
    limit = (as_of - timedelta(days=days)).date()
    removed = []
    for directory in files.list_dirs(spark, path):
        name, _, value = directory.rsplit("/", 1)[-1].partition("=")
        if name != "pickup_date":
            continue
        try:
            day = date.fromisoformat(value)
        except ValueError:
            if value == NO_DATE:
                files.delete_tree(spark, directory)
            continue
        if day < limit:
            files.delete_tree(spark, directory)
            removed.append(day)
    return removed


def attribute_stats(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """One row per attribute: non-null count, minimum, maximum, distinct values.

    Distinct values are a sketch, and everything comes from one scan, unless ``exact``: then every attribute
    is aggregated on its own from a scan of that column alone, and its values are made distinct by task
    before they are shuffled.
    """

    def measures(c: Column, distinct) -> list[Column]:
        return [
            F.count(c).alias("non_null"),
            F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
            distinct(c).alias("distinct_values"),
        ]

    if exact:
        each = [df.agg(F.lit(c).alias("attribute"), *measures(F.col(c), F.count_distinct)) for c in columns]
        return reduce(DataFrame.unionByName, each)
    packed = [F.struct(F.lit(c).alias("attribute"), *measures(F.col(c), F.approx_count_distinct)) for c in columns]
    return df.agg(F.array(*packed).alias("rows")).select(F.inline("rows"))
