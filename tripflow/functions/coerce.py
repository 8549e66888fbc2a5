"""Conversions from file columns to typed trip columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SchemaValidationError

# The two accepted text forms of a datetime.
STANDARD_DATETIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fits_int(c: Column) -> Column:
    return (c > F.lit(-(2**31) - 1)) & (c < F.lit(2**31))


def to_int(c: Column | str) -> Column:
    """32-bit integer from a number; null when it does not fit (see ``is_narrowed``).

    A range test instead of ``try_cast``, which raises and catches an error per overflow.
    """
    c = _col(c)
    return F.when(_fits_int(c), c.cast("int"))


def is_narrowed(c: Column | str) -> Column:
    """True where ``to_int`` loses a value."""
    return F.coalesce(~_fits_int(_col(c)), F.lit(False))


def to_double(c: Column | str) -> Column:
    return _col(c).cast("double")


def to_str(c: Column | str) -> Column:
    return _col(c).cast("string")


def optional(df: DataFrame, name: str, dtype: T.DataType | str) -> Column:
    """The column under any letter case, or a typed null when the frame lacks it."""
    for present in df.columns:
        if present.lower() == name.lower():
            return F.col(f"`{present}`")
    return F.lit(None).cast(dtype)


def from_epoch_micros(c: Column | str) -> Column:
    """Microseconds since the epoch as a wall-clock datetime, whatever the session zone is."""
    return F.expr(_EPOCH) + _col(c).cast("bigint") * F.expr("INTERVAL '0.000001' SECOND")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Exact seconds between two wall-clock datetimes, as a decimal.

    Subtraction stays in wall-clock time; the timestamp functions would go through the session
    zone and stumble over its clock changes.
    """
    return (_col(end) - _col(start)).cast("decimal(20,6)")


def micros_between(start: Column | str, end: Column | str) -> Column:
    return (seconds_between(start, end) * F.lit(1_000_000)).cast("bigint")


def epoch_micros(ts: Column | str) -> Column:
    """Wall-clock datetime to microseconds since the epoch."""
    return micros_between(F.expr(_EPOCH), ts)


def to_millis_precision(ts: Column | str) -> Column:
    """Wall-clock datetime with its microseconds cut off.

    Only the remainder below a millisecond is taken through the session zone, and zones shift by
    whole seconds.
    """
    ts = _col(ts)
    rest = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1000))
    return ts - rest * F.expr("INTERVAL '0.000001' SECOND")


def parse_datetime_text(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` or ISO local datetime; null for any other text.

    The first form resolves as calendars do: 24:00:00 is the next midnight and a day up to 31
    that the month lacks is its last day. The ISO form takes only datetimes that exist.
    """
    c = _col(c)
    standard = c.rlike(STANDARD_DATETIME)
    month_end = F.last_day(F.try_to_date(F.concat(F.substring(c, 1, 8), F.lit("01"))))
    day = F.substring(c, 9, 2)
    clamped = F.when(
        day.between("29", "31"), F.concat(F.substring(c, 1, 8), F.least(day, F.day(month_end).cast("string")))
    ).otherwise(F.substring(c, 1, 10))
    time = F.substring(c, 12, 8)
    midnight = time == "24:00:00"
    resolved = F.concat(clamped, F.lit(" "), F.when(midnight, F.lit("00:00:00")).otherwise(time)).try_cast(
        "timestamp_ntz"
    )
    standard_value = resolved + F.when(midnight, F.expr("INTERVAL '1' DAY")).otherwise(F.expr("INTERVAL '0' DAY"))
    return F.when(c.rlike(ISO_DATETIME), c.try_cast("timestamp_ntz")).when(standard, standard_value)


def to_datetime(c: Column | str, dtype: T.DataType, strict: bool = True) -> Column:
    """Wall-clock datetime from a timestamp, epoch-microsecond or text column.

    ``strict`` fails the query on text that is no datetime; otherwise it becomes null.
    """
    c = _col(c)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return from_epoch_micros(F.unix_micros(c))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return from_epoch_micros(c)
    if isinstance(dtype, T.StringType):
        parsed = parse_datetime_text(c)
        if not strict:
            return parsed
        failed = F.raise_error(F.concat(F.lit("no datetime: "), c)).cast("timestamp_ntz")
        return F.coalesce(parsed, F.when(c.isNotNull(), failed))
    raise SchemaValidationError(f"cannot read a datetime from {dtype.simpleString()}")


def duration_minutes(pickup: Column | str, dropoff: Column | str) -> Column:
    """Whole minutes from pickup to drop-off: floor to seconds, then truncate toward zero.

    Casting an interval to whole seconds truncates, which is the floor unless it is negative.
    """
    pickup, dropoff = _col(pickup), _col(dropoff)
    forward = (dropoff - pickup).cast("bigint")
    backward = F.floor(seconds_between(pickup, dropoff)).cast("bigint")
    seconds = F.when(dropoff >= pickup, forward).otherwise(backward)
    return F.call_function("div", seconds, F.lit(60))
