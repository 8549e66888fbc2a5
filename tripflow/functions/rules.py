"""Validity rules of a trip, in the order in which they are checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TripKind, kind_of

RULE_NAMES = (
    "vendor_code",
    "missing_datetime",
    "dropoff_before_pickup",
    "store_and_fwd_flag",
    "passenger_count",
    "trip_distance",
    "trip_type",
)
FLAG_VALUES = ("Y", "N")
TRIP_TYPES = (1, 2)
NARROWING = "narrowing"


def _ok_or(condition: Column, when_unknown: bool) -> Column:
    return F.coalesce(condition, F.lit(when_unknown))


def passes(kind: str | TripKind) -> dict[str, Column]:
    """One never-null boolean per rule; true means the trip passes it."""
    kind = kind_of(kind)
    pickup, dropoff = F.col(kind.pickup), F.col(kind.dropoff)
    rules = {
        "vendor_code": _ok_or(F.col("VendorID").isin(*kind.vendor_codes), False),
        "missing_datetime": pickup.isNotNull() & dropoff.isNotNull(),
        "dropoff_before_pickup": _ok_or(dropoff >= pickup, True),
        "store_and_fwd_flag": _ok_or(F.col("store_and_fwd_flag").isin(*FLAG_VALUES), False),
        "passenger_count": _ok_or(F.col("passenger_count") >= 0, True),
        "trip_distance": _ok_or(~(F.col("trip_distance") < 0), True),
    }
    if kind.has_trip_type:
        rules["trip_type"] = _ok_or(F.col("trip_type").isin(*TRIP_TYPES), True)
    return rules


def is_valid(kind: str | TripKind) -> Column:
    return reduce(lambda a, b: a & b, passes(kind).values())


def valid_filter(kind: str | TripKind) -> Column:
    """``is_valid`` for use in a filter, written so that its parts reach the Parquet scan."""
    kind = kind_of(kind)
    pickup, dropoff = F.col(kind.pickup), F.col(kind.dropoff)
    count, distance = F.col("passenger_count"), F.col("trip_distance")
    parts = [
        F.col("VendorID").isin(*kind.vendor_codes),
        pickup.isNotNull(),
        dropoff.isNotNull(),
        dropoff >= pickup,
        F.col("store_and_fwd_flag").isin(*FLAG_VALUES),
        count.isNull() | (count >= 0),
        distance.isNull() | ~(distance < 0),
    ]
    if kind.has_trip_type:
        parts.append(F.col("trip_type").isNull() | F.col("trip_type").isin(*TRIP_TYPES))
    return reduce(lambda a, b: a & b, parts)


def first_violation(kind: str | TripKind) -> Column:
    """Name of the first rule a trip fails; null for a valid trip."""
    chain = F
    for name, ok in passes(kind).items():
        chain = chain.when(~ok, F.lit(name))
    return chain


def violations(kind: str | TripKind, narrowed: Column | None = None) -> Column:
    """Names of all rules a trip fails. ``narrowed`` adds the code-overflow flag of ``normalize``."""
    failures = {name: ~ok for name, ok in passes(kind).items()}
    if narrowed is not None:
        failures[NARROWING] = narrowed
    none = F.array().cast("array<string>")
    # Joined from one-element arrays: unlike an array filter, this stays in generated code.
    return F.concat(*[F.when(failed, F.array(F.lit(name))).otherwise(none) for name, failed in failures.items()])
