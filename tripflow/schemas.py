"""Trip kinds: file schemas, typed trips, required columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_INT, _LONG, _DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
_STRING, _NTZ = T.StringType(), T.TimestampNTZType()

# Columns and types of the two trip files, in file order.
YELLOW_FILE_FIELDS = (
    ("VendorID", _INT),
    ("tpep_pickup_datetime", _NTZ),
    ("tpep_dropoff_datetime", _NTZ),
    ("passenger_count", _LONG),
    ("trip_distance", _DOUBLE),
    ("RatecodeID", _LONG),
    ("store_and_fwd_flag", _STRING),
    ("PULocationID", _INT),
    ("DOLocationID", _INT),
    ("payment_type", _LONG),
    ("fare_amount", _DOUBLE),
    ("extra", _DOUBLE),
    ("mta_tax", _DOUBLE),
    ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE),
    ("improvement_surcharge", _DOUBLE),
    ("total_amount", _DOUBLE),
    ("congestion_surcharge", _DOUBLE),
    ("Airport_fee", _DOUBLE),
    ("cbd_congestion_fee", _DOUBLE),
)
GREEN_FILE_FIELDS = (
    ("VendorID", _INT),
    ("lpep_pickup_datetime", _NTZ),
    ("lpep_dropoff_datetime", _NTZ),
    ("store_and_fwd_flag", _STRING),
    ("RatecodeID", _LONG),
    ("PULocationID", _INT),
    ("DOLocationID", _INT),
    ("passenger_count", _LONG),
    ("trip_distance", _DOUBLE),
    ("fare_amount", _DOUBLE),
    ("extra", _DOUBLE),
    ("mta_tax", _DOUBLE),
    ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE),
    ("ehail_fee", _DOUBLE),
    ("improvement_surcharge", _DOUBLE),
    ("total_amount", _DOUBLE),
    ("payment_type", _LONG),
    ("trip_type", _LONG),
    ("congestion_surcharge", _DOUBLE),
    ("cbd_congestion_fee", _DOUBLE),
)


@dataclass(frozen=True)
class TripKind:
    """What distinguishes one kind of trip file from the other."""

    name: str
    pickup: str
    dropoff: str
    file_schema: T.StructType
    trip_schema: T.StructType
    optional: tuple[str, ...]
    vendor_codes: tuple[int, ...]
    index: str

    @property
    def required(self) -> list[str]:
        skip = {c.lower() for c in self.optional} | {"ehail_fee"}
        return [f.name for f in self.file_schema if f.name.lower() not in skip]

    @property
    def has_trip_type(self) -> bool:
        return "trip_type" in self.trip_schema.names


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def _typed(fields, drop=(), rename=None) -> T.StructType:
    """Typed trips keep the file order, with every code and count as a 32-bit int."""
    rename = rename or {}
    return _struct(
        (rename.get(name, name), _INT if dtype == _LONG else dtype) for name, dtype in fields if name not in drop
    )


YELLOW = TripKind(
    name="yellow",
    pickup="tpep_pickup_datetime",
    dropoff="tpep_dropoff_datetime",
    file_schema=_struct(YELLOW_FILE_FIELDS),
    trip_schema=_typed(YELLOW_FILE_FIELDS, rename={"Airport_fee": "airport_fee"}),
    optional=("airport_fee", "cbd_congestion_fee"),
    vendor_codes=(1, 2, 6, 7),
    index="yellowtaxi",
)
GREEN = TripKind(
    name="green",
    pickup="lpep_pickup_datetime",
    dropoff="lpep_dropoff_datetime",
    file_schema=_struct(GREEN_FILE_FIELDS),
    trip_schema=_typed(GREEN_FILE_FIELDS, drop=("ehail_fee",)),
    optional=("cbd_congestion_fee",),
    vendor_codes=(1, 2, 6),
    index="greentaxi",
)
KINDS = {"yellow": YELLOW, "green": GREEN}

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("path", _STRING, False),
        T.StructField("file_name", _STRING, False),
        T.StructField("kind", _STRING, True),
        T.StructField("status", _STRING, False),
        T.StructField("records", _LONG, True),
        T.StructField("batch_id", _LONG, True),
        T.StructField("started_at", _NTZ, True),
        T.StructField("finished_at", _NTZ, True),
        T.StructField("error", _STRING, True),
    ]
)


class SchemaValidationError(ValueError):
    """A file or frame does not have the columns or types its trip kind needs."""


def kind_of(kind: str | TripKind) -> TripKind:
    if isinstance(kind, TripKind):
        return kind
    try:
        return KINDS[kind]
    except KeyError:
        raise ValueError(f"unknown trip kind {kind!r}; expected one of {sorted(KINDS)}") from None
