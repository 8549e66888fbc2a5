"""Trips as flat JSON documents and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import duration_minutes, to_datetime
from ..functions.rules import is_valid
from ..schemas import TripKind, kind_of


def iso_text(ts: Column | str) -> Column:
    """ISO local datetime text; keeps fractional seconds without trailing zeros."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.translate(ts.cast("string"), " ", "T")


def document(kind: str | TripKind, include_derived: bool = False) -> Column:
    """The typed trip as JSON text: file column names, nulls kept, ISO datetimes."""
    kind = kind_of(kind)
    fields = []
    for field in kind.trip_schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType):
            column = iso_text(column)
        fields.append(column.alias(field.name))
    if include_derived:
        fields.append(is_valid(kind).alias("valid"))
        fields.append(duration_minutes(kind.pickup, kind.dropoff).alias("tripDurationMinutes"))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_documents(df: DataFrame, kind: str | TripKind, include_derived: bool = False, keep=()) -> DataFrame:
    """Frame of ``doc``, preceded by the columns named in ``keep``."""
    return df.select(*keep, document(kind, include_derived).alias("doc"))


def _wire(kind: TripKind) -> T.StructType:
    """The trip as it is in a document: datetimes are texts."""
    text = T.StringType()
    return T.StructType(
        [
            T.StructField(f.name, text if isinstance(f.dataType, T.TimestampNTZType) else f.dataType, True)
            for f in kind.trip_schema
        ]
    )


def from_documents(df: DataFrame, kind: str | TripKind, col: str = "doc", strict: bool = True, keep=()) -> DataFrame:
    """Typed trips from JSON text; unknown fields are ignored, absent fields are null."""
    kind = kind_of(kind)
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    parsed = df.select(*keep, F.from_json(F.col(col), _wire(kind), options).alias("__trip"))
    columns = []
    for field in kind.trip_schema:
        column = F.col(f"__trip.{field.name}")
        if isinstance(field.dataType, T.TimestampNTZType):
            column = to_datetime(column, T.StringType(), strict)
        columns.append(column.alias(field.name))
    return parsed.select(*keep, *columns)


def round_trip_mismatches(df: DataFrame, kind: str | TripKind) -> DataFrame:
    """One row: trips, and trips that JSON text and back does not restore exactly."""
    kind = kind_of(kind)
    original = F.struct(*[F.col(c) for c in kind.trip_schema.names])
    packed = df.select(original.alias("before"), document(kind).alias("doc"))
    restored = from_documents(packed, kind, keep=("before",))
    after = F.struct(*[F.col(c) for c in kind.trip_schema.names])
    return restored.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(~F.col("before").eqNullSafe(after)).alias("mismatches"),
    )


def serialization_rate(df: DataFrame, kind: str | TripKind) -> DataFrame:
    """One row: share of trips whose document is JSON text of a trip, as a reader finds."""
    return document_rate(df.select(document(kind).alias("doc")), kind)


def document_rate(docs: DataFrame, kind: str | TripKind, col: str = "doc") -> DataFrame:
    """One row: texts, those that parse as a trip document, and their share."""
    wire = T.StructType([*_wire(kind_of(kind)).fields, T.StructField("__bad", T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    parsed = docs.select(F.from_json(F.col(col), wire, options).alias("trip"))
    good = F.count_if(F.col("trip").isNotNull() & F.col("trip.__bad").isNull())
    total = F.count(F.lit(1))
    return parsed.agg(total.alias("trips"), good.alias("documents"), (good / total).alias("success_rate"))
