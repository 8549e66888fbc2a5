"""Validity columns and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import first_violation, is_valid, passes, violations
from ..schemas import TripKind, kind_of


def with_quality(df: DataFrame, kind: str | TripKind) -> DataFrame:
    """Adds ``is_valid``, ``violation`` (the first) and ``violations`` (all)."""
    narrowed = F.col("narrowed") if "narrowed" in df.columns else None
    return df.withColumns(
        {
            "is_valid": is_valid(kind),
            "violation": first_violation(kind),
            "violations": violations(kind, narrowed),
        }
    )


def valid_share(df: DataFrame, kind: str | TripKind) -> DataFrame:
    """One row: trips, valid trips and their share."""
    valid = F.count_if(is_valid(kind))
    return df.agg(
        F.count(F.lit(1)).alias("trips"),
        valid.alias("valid_trips"),
        (valid / F.count(F.lit(1))).alias("valid_share"),
    )


def violation_report(df: DataFrame, kind: str | TripKind) -> DataFrame:
    """Trips per violated rule, ``(kind, rule, trips)``; a trip counts once per rule it fails.

    The rules are counted side by side in one aggregation, so each task sends a single row and
    nothing is exploded.
    """
    kind = kind_of(kind)
    conditions = {name: ~ok for name, ok in passes(kind).items()}
    if "narrowed" in df.columns:
        conditions["narrowing"] = F.col("narrowed")
    counts = df.agg(*[F.count_if(failed).alias(name) for name, failed in conditions.items()])
    long_form = counts.unpivot([], list(conditions), "rule", "trips")
    return long_form.filter("trips > 0").select(F.lit(kind.name).alias("kind"), "rule", "trips")
