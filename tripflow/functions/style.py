"""Attribute-driven classes, sizes and labels of trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band name, fill colour, marker size.
FARE_BANDS = {
    "high": ("High Fare Trips", "#FF0000", 12),
    "medium": ("Medium Fare Trips", "#FFA500", 10),
    "low": ("Low Fare Trips", "#00FF00", 8),
    "default": ("Default", "#808080", 6),
}
FARE_LIMITS = (20, 50)
# Names of the attribute rules and of the else rule.
RULES = ("Credit Card Payment", "Cash Payment", "Street Hail", "Dispatch", "Multiple Passengers")
ELSE_RULE = "Default"
# Marker and route sizes.
TOTAL_FACTOR, TOTAL_BASE, PASSENGER_FACTOR = 0.2, 5.0, 3
ROUTE_BREAKS, ROUTE_WIDTHS = (1.0, 5.0, 10.0), (1, 2, 3, 4)
AMOUNT_FORMAT = "#.##"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _by_band(total: Column | str, field: int) -> Column:
    total = _col(total)
    low, high = FARE_LIMITS
    return (
        F.when(total > high, F.lit(FARE_BANDS["high"][field]))
        .when(total > low, F.lit(FARE_BANDS["medium"][field]))
        .when(total <= low, F.lit(FARE_BANDS["low"][field]))
        .otherwise(F.lit(FARE_BANDS["default"][field]))
    )


def fare_band(total: Column | str = "total_amount") -> Column:
    return _by_band(total, 0)


def fare_colour(total: Column | str = "total_amount") -> Column:
    return _by_band(total, 1)


def fare_size(total: Column | str = "total_amount") -> Column:
    return _by_band(total, 2)


def rule_flags(
    payment: Column | str = "payment_type",
    trip_type: Column | str = "trip_type",
    passengers: Column | str = "passenger_count",
) -> dict[str, Column]:
    """One three-valued condition per rule. Rules overlap: a trip may match several.

    ``p <> 1 or p <> 2`` holds for every non-null ``p``; it is kept because it decides how
    trips without a payment or trip type are treated.
    """
    p, t, n = _col(payment), _col(trip_type), _col(passengers)
    some_payment = (p != 1) | (p != 2)
    some_type = (t != 1) | (t != 2)
    conditions = (
        p == 1,
        p == 2,
        (t == 1) & some_payment,
        (t == 2) & some_payment,
        (n > 1) & some_payment & some_type,
    )
    return dict(zip(RULES, conditions))


def matched_rules(**columns: Column | str) -> Column:
    """Names of all matching rules, or the else rule when there is none."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rule_flags(**columns).items()]))
    return F.when(F.size(names) == 0, F.array(F.lit(ELSE_RULE))).otherwise(names)


def is_else(**columns: Column | str) -> Column:
    """True when no rule matches."""
    result = F.lit(True)
    for condition in rule_flags(**columns).values():
        result = result & ~F.coalesce(condition, F.lit(False))
    return result


def marker_size(total: Column | str = "total_amount") -> Column:
    return _col(total) * F.lit(TOTAL_FACTOR) + F.lit(TOTAL_BASE)


def passenger_size(passengers: Column | str = "passenger_count") -> Column:
    return _col(passengers) * F.lit(PASSENGER_FACTOR)


def route_width(
    distance: Column | str = "trip_distance",
    breaks: Sequence[float] = ROUTE_BREAKS,
    widths: Sequence[int] = ROUTE_WIDTHS,
) -> Column:
    """Step function: ``widths[i]`` below ``breaks[i]``, the last width from the last break on."""
    if len(widths) != len(breaks) + 1:
        raise ValueError("route_width needs one more width than breaks")
    distance = _col(distance)
    steps = F
    for limit, width in zip(breaks, widths):
        steps = steps.when(distance < F.lit(limit), F.lit(width))
    return steps.when(distance.isNotNull(), F.lit(widths[-1]))


def total_label(total: Column | str = "total_amount") -> Column:
    return _col(total).cast("string")


def trip_label(
    total: Column | str = "total_amount",
    distance: Column | str = "trip_distance",
    passengers: Column | str = "passenger_count",
) -> Column:
    """Three lines: amount, miles, passengers. Null when any part is null."""
    return F.concat(
        F.lit("$"),
        F.call_function("format_number", _col(total), F.lit(AMOUNT_FORMAT)),
        F.lit("\n"),
        _col(distance).cast("string"),
        F.lit(" mi\n"),
        _col(passengers).cast("string"),
        F.lit(" pax"),
    )
