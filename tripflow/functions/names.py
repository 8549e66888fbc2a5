"""Table and column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters that a sanitised name replaces by an underscore.
UNSAFE = "[^a-zA-Z0-9_]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def derive_table_name(path: Column | str) -> Column:
    """File name without its last extension; a name that only starts with a dot keeps it."""
    return F.regexp_replace(file_name(path), r"^(.+)\.[^.]*$", "$1")


def sanitize_table_name(name: Column | str) -> Column:
    return F.lower(sanitize_column_name(name))


def sanitize_column_name(name: Column | str) -> Column:
    return F.regexp_replace(_col(name), UNSAFE, "_")


def key_text(*columns: str) -> Column:
    """Several columns as one text that no other values give: each with its length in front, null as "-"."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def quote_identifier(name: Column | str) -> Column:
    return F.concat(F.lit('"'), F.replace(_col(name), F.lit('"'), F.lit('""')), F.lit('"'))


def quarantine_name(name: Column | str, reason: Column | str) -> Column:
    """``base_reason.ext``; a name without extension gets the reason appended."""
    name, reason = _col(name), _col(reason)
    stem = F.regexp_extract(name, r"^(.*)(\.[^.]*)$", 1)
    extension = F.regexp_extract(name, r"^(.*)(\.[^.]*)$", 2)
    return F.when(extension == "", F.concat(name, F.lit("_"), reason)).otherwise(
        F.concat(stem, F.lit("_"), reason, extension)
    )
