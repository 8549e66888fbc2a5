"""Row selection by attribute, range, validity and age."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import valid_filter
from ..schemas import TripKind, kind_of

# The attributes that trips are looked up by.
EQUALITY = {
    "vendor": "VendorID",
    "pickup_zone": "PULocationID",
    "dropoff_zone": "DOLocationID",
    "payment": "payment_type",
    "trip_type": "trip_type",
}
RANGES = {"distance": "trip_distance", "fare": "fare_amount", "tip": "tip_amount", "total": "total_amount"}
RETENTION_DAYS = 30


def _column_of(kind: TripKind, criterion: str) -> str:
    times = {"pickup_time": kind.pickup, "dropoff_time": kind.dropoff}
    try:
        return {**EQUALITY, **RANGES, **times}[criterion]
    except KeyError:
        known = sorted([*EQUALITY, *RANGES, *times])
        raise ValueError(f"unknown criterion {criterion!r}; expected one of {known}") from None


def pushable(df: DataFrame, kind: str | TripKind, criterion: str) -> bool:
    """The criterion means the same on this frame's column as on the typed trip."""
    dtype = df.schema[_column_of(kind_of(kind), criterion)].dataType
    return isinstance(dtype, (T.NumericType, T.TimestampNTZType))


def filter_trips(df: DataFrame, kind: str | TripKind, **criteria) -> DataFrame:
    """Keep trips that meet every criterion.

    Equality criteria (vendor, pickup_zone, dropoff_zone, payment, trip_type) take a value or a
    list of values. Range criteria (pickup_time, dropoff_time, distance, fare, tip, total) take
    an inclusive ``(low, high)`` pair with None for an open end. A pickup-time range also
    restricts ``pickup_date`` where the frame has it, so that date partitions are pruned.
    """
    kind = kind_of(kind)
    for name, value in criteria.items():
        column = F.col(_column_of(kind, name))
        if name in EQUALITY:
            values = value if isinstance(value, (list, tuple, set)) else [value]
            df = df.filter(column.isin(*values) if len(values) != 1 else column == next(iter(values)))
            continue
        low, high = (_bound(v) for v in value)
        if low is not None:
            df = df.filter(column >= low)
        if high is not None:
            df = df.filter(column <= high)
        if name == "pickup_time" and "pickup_date" in df.columns:
            if low is not None:
                df = df.filter(F.col("pickup_date") >= low.cast("date"))
            if high is not None:
                df = df.filter(F.col("pickup_date") <= high.cast("date"))
    return df


def _bound(value) -> Column | None:
    if value is None:
        return None
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def rules_apply(df: DataFrame, kind: str | TripKind) -> bool:
    """The validity rules can be put on this frame's own columns: times are times, numbers are numbers.

    A code or count beyond 32 bits is then judged as it is, not as the null that it becomes.
    """
    kind = kind_of(kind)
    types = {f.name: f.dataType for f in df.schema}
    numbers = ["VendorID", "passenger_count", "trip_distance", *(["trip_type"] if kind.has_trip_type else [])]
    return (
        all(isinstance(types.get(c), T.NumericType) for c in numbers)
        and all(isinstance(types.get(c), T.TimestampNTZType) for c in (kind.pickup, kind.dropoff))
        and isinstance(types.get("store_and_fwd_flag"), T.StringType)
    )


def keep_valid(df: DataFrame, kind: str | TripKind) -> DataFrame:
    return df.filter(valid_filter(kind))


def street_hails(df: DataFrame) -> DataFrame:
    """Valid green trips that were hailed on the street."""
    return keep_valid(df, "green").filter(F.col("trip_type") == 1)


def expire(
    df: DataFrame, time_col: str, as_of: datetime | Column | None = None, days: int = RETENTION_DAYS
) -> DataFrame:
    """Drop rows older than ``days`` before ``as_of`` (default: now). Works on streams as well."""
    if as_of is None:
        as_of = F.localtimestamp()
    elif isinstance(as_of, datetime):
        as_of = _bound(as_of)
    return df.filter(F.col(time_col) >= as_of - F.expr(f"INTERVAL '{int(days)}' DAY"))
