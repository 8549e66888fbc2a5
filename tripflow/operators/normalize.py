"""Schema check and projection of file columns to typed trips."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import is_narrowed, optional, to_datetime, to_double, to_int, to_millis_precision, to_str
from ..schemas import SchemaValidationError, TripKind, kind_of


@dataclass(frozen=True)
class SchemaReport:
    required: int
    optional_present: int


def check_schema(df: DataFrame, kind: str | TripKind) -> SchemaReport:
    """All required columns are present; raises with every missing name. Runs no job."""
    kind = kind_of(kind)
    present = set(df.columns)
    missing = [name for name in kind.required if name not in present]
    if missing:
        raise SchemaValidationError(
            f"{kind.name} trips need columns that are not there: {', '.join(missing)}"
        )
    lowered = {c.lower() for c in df.columns}
    found = sum(name.lower() in lowered for name in kind.optional)
    return SchemaReport(required=len(kind.required), optional_present=found)


def normalize(
    df: DataFrame,
    kind: str | TripKind,
    *,
    strict: bool = True,
    keep: Sequence[str] = (),
    flag_narrowing: bool = False,
) -> DataFrame:
    """Typed trips in canonical column order.

    ``strict`` decides what unreadable datetime text does (see ``to_datetime``). ``keep`` passes
    further columns through. ``flag_narrowing`` adds ``narrowed``, true where a code or count
    exceeded 32 bits and became null.
    """
    kind = kind_of(kind)
    types = {f.name.lower(): f.dataType for f in df.schema}
    columns, narrowing = [], []
    for field in kind.trip_schema:
        source = optional(df, field.name, field.dataType)
        dtype = types.get(field.name.lower(), field.dataType)
        if isinstance(field.dataType, T.TimestampNTZType):
            column = to_datetime(source, dtype, strict)
        elif isinstance(field.dataType, T.StringType):
            column = source if isinstance(dtype, T.StringType) else to_str(source)
        elif dtype == field.dataType:
            column = source
        elif not isinstance(dtype, (T.NumericType, T.NullType)):
            raise SchemaValidationError(f"Field {field.name} is not a number: {dtype.simpleString()}")
        elif isinstance(field.dataType, T.IntegerType):
            column = to_int(source)
            narrowing.append(is_narrowed(source))
        else:
            column = to_double(source)
        columns.append(column.alias(field.name))
    columns += [F.col(name) for name in keep]
    if flag_narrowing:
        columns.append(reduce(lambda a, b: a | b, narrowing, F.lit(False)).alias("narrowed"))
    return df.select(*columns)


def feature_attributes(df: DataFrame, kind: str | TripKind) -> list:
    """File columns as feature attributes: file types, datetimes at millisecond precision."""
    kind = kind_of(kind)
    columns = []
    for field in kind.file_schema:
        source = optional(df, field.name, field.dataType)
        if isinstance(field.dataType, T.TimestampNTZType):
            source = to_millis_precision(source)
        else:
            source = source.cast(field.dataType)
        columns.append(source.alias(field.name))
    return columns
