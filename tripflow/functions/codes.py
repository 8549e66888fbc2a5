"""Code sets: lookup, membership and rendered form."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code, name, description of every code set.
CODE_SETS = {
    "vendor": (
        (1, "CREATIVE_MOBILE_TECHNOLOGIES", "Creative Mobile Technologies, LLC"),
        (2, "CURB_MOBILITY", "Curb Mobility, LLC"),
        (6, "MYLE_TECHNOLOGIES", "Myle Technologies Inc"),
        (7, "HELIX", "Helix"),
    ),
    "rate": (
        (1, "STANDARD_RATE", "Standard rate"),
        (2, "JFK", "JFK"),
        (3, "NEWARK", "Newark"),
        (4, "NASSAU_OR_WESTCHESTER", "Nassau or Westchester"),
        (5, "NEGOTIATED_FARE", "Negotiated fare"),
        (6, "GROUP_RIDE", "Group ride"),
        (99, "NULL_OR_UNKNOWN", "Null/unknown"),
    ),
    "trip_type": (
        (1, "STREET_HAIL", "Street-hail"),
        (2, "DISPATCH", "Dispatch"),
    ),
    "payment": (
        (0, None, "Flex Fare trip"),
        (1, None, "Credit card"),
        (2, None, "Cash"),
        (3, None, "No charge"),
        (4, None, "Dispute"),
        (5, None, "Unknown"),
        (6, None, "Voided trip"),
    ),
    "flag": (
        ("Y", None, "store and forward trip"),
        ("N", None, "not a store and forward trip"),
    ),
}
TYPE_NAMES = {"vendor": "VendorID", "rate": "RatecodeID", "trip_type": "TripType"}


def _entries(code_set: str):
    try:
        return CODE_SETS[code_set]
    except KeyError:
        raise ValueError(f"unknown code set {code_set!r}; expected one of {sorted(CODE_SETS)}") from None


def _lookup(code: Column, code_set: str, field: int) -> Column:
    pairs = chain.from_iterable((F.lit(row[0]), F.lit(row[field])) for row in _entries(code_set))
    return F.try_element_at(F.create_map(*pairs), code)


def decode(code: Column | str, code_set: str, field: str = "description", on_unknown: str = "null") -> Column:
    """Name or description of a code. Unknown codes give null, or fail with ``on_unknown="error"``."""
    code = F.col(code) if isinstance(code, str) else code
    if on_unknown not in ("null", "error"):
        raise ValueError(f"on_unknown is 'null' or 'error', not {on_unknown!r}")
    value = _lookup(code, code_set, {"name": 1, "description": 2}[field])
    if on_unknown == "null":
        return value
    label = TYPE_NAMES.get(code_set, code_set)
    message = F.concat(F.lit(f"Invalid {label} code: "), F.coalesce(code.cast("string"), F.lit("null")))
    return F.coalesce(value, F.raise_error(message).cast("string"))


def is_code(code: Column | str, code_set: str) -> Column:
    """Membership; null is not a member."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(code.isin([row[0] for row in _entries(code_set)]), F.lit(False))


def render_code(code: Column | str, code_set: str) -> Column:
    """Text such as ``VendorID{code=2, description='...'}``; null for an unknown code."""
    code = F.col(code) if isinstance(code, str) else code
    description = decode(code, code_set)
    text = F.format_string(f"{TYPE_NAMES[code_set]}{{code=%d, description='%s'}}", code, description)
    return F.when(description.isNotNull(), text)


def code_frame(spark: SparkSession, code_set: str) -> DataFrame:
    """The code set as a dimension of a few rows."""
    rows = _entries(code_set)
    code_type = T.StringType() if isinstance(rows[0][0], str) else T.IntegerType()
    schema = T.StructType(
        [
            T.StructField("code", code_type, False),
            T.StructField("name", T.StringType(), True),
            T.StructField("description", T.StringType(), False),
        ]
    )
    return spark.createDataFrame(list(rows), schema)


def decode_join(df: DataFrame, column: str, code_set: str) -> DataFrame:
    """Dimension-join form of ``decode``: adds ``<column>_name`` and ``<column>_description``.

    The broadcast side is one of the fixed code sets above, at most seven rows.
    """
    dim = code_frame(df.sparkSession, code_set).select(
        F.col("code").alias("__code"),
        F.col("name").alias(f"{column}_name"),
        F.col("description").alias(f"{column}_description"),
    )
    return df.join(F.broadcast(dim), F.col(column) == F.col("__code"), "left").drop("__code")
