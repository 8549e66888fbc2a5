"""Schemas as JSON, SQL column types and sanitised column names."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.names import UNSAFE

# Spark type to SQL column type; anything else is stored as text.
SQL_TYPES = {
    T.IntegerType: "INTEGER",
    T.ShortType: "INTEGER",
    T.ByteType: "INTEGER",
    T.LongType: "BIGINT",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.BooleanType: "BOOLEAN",
    T.StringType: "TEXT",
    T.BinaryType: "BYTEA",
}


def schema_json(df: DataFrame) -> str:
    return json.dumps(json.loads(df.schema.json()), indent=2)


def sanitize_name(name: str) -> str:
    return re.sub(UNSAFE, "_", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitize_name(c) for c in df.columns])


def sql_type(field: T.StructField) -> str:
    name = SQL_TYPES.get(type(field.dataType), "TEXT")
    return name if field.nullable else f"{name} NOT NULL"


def column_definitions(schema: T.StructType) -> list[str]:
    return ['"{}" {}'.format(sanitize_name(f.name).replace('"', '""'), sql_type(f)) for f in schema]


def ddl_types(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE statement."""
    return ", ".join(column_definitions(schema))


def quoted_table(table: str) -> str:
    return ".".join('"{}"'.format(part.replace('"', '""')) for part in table.split("."))


def create_table_sql(table: str, schema: T.StructType, if_not_exists: bool = False) -> str:
    clause = "IF NOT EXISTS " if if_not_exists else ""
    return f"CREATE TABLE {clause}{quoted_table(table)} ({ddl_types(schema)})"


def drop_table_sql(table: str) -> str:
    return f"DROP TABLE IF EXISTS {quoted_table(table)}"


def merge_sql(table: str, staging: str, columns: Sequence[str], ingest_id: str) -> list[str]:
    """One transaction: the rows of an ingestion are replaced by the staged ones, and staging goes."""
    names = ", ".join('"{}"'.format(c.replace('"', '""')) for c in columns)
    key = ingest_id.replace("'", "''")
    return [
        f"DELETE FROM {quoted_table(table)} WHERE \"ingest_id\" = '{key}'",
        f"INSERT INTO {quoted_table(table)} ({names}) SELECT {names} FROM {quoted_table(staging)}",
        drop_table_sql(staging),
    ]
