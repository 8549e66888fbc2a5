"""SQL tables: JDBC databases and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.schema_ops import sanitize_columns

BATCH_SIZE = 1000


MAX_CONNECTIONS = 5


def jdbc_options(
    table: str,
    url: str,
    batch_size: int = BATCH_SIZE,
    max_connections: int = MAX_CONNECTIONS,
    properties: dict | None = None,
) -> dict[str, str]:
    """Options of the JDBC writer. ``properties`` pass driver settings (user, ssl, ...) through.

    Column types come from Spark's dialect for the database, which also marks non-null columns.
    Every task opens a connection, so their number is limited for the database's sake.
    """
    return {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(max_connections),
    }


def _written(df: DataFrame, write) -> int:
    """Run ``write`` and return the number of rows that passed, without a second scan."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return int(seen.get["n"])


def load_table(
    df: DataFrame,
    table: str,
    url: str,
    *,
    drop_if_exists: bool = False,
    batch_size: int = BATCH_SIZE,
    max_connections: int = MAX_CONNECTIONS,
    properties: dict | None = None,
    staging: str | None = None,
) -> int:
    """Append to a database table, creating it when missing; returns the number of rows.

    ``drop_if_exists`` drops and recreates it. The connection limit also limits the tasks, so with
    ``staging`` (a folder) the rows are first computed at full width and stored there. Each task inserts its
    own partition in batches and commits once, so a task that fails leaves nothing; a task that is retried
    after its commit would insert twice. ``SqlTables`` is the sink for which that can't happen.
    """
    options = jdbc_options(table, url, batch_size, max_connections, properties)
    mode = "overwrite" if drop_if_exists else "append"
    df = sanitize_columns(df)
    if staging is not None:
        df.write.mode("overwrite").parquet(staging)
        df = df.sparkSession.read.schema(df.schema).parquet(staging)
    return _written(df, lambda out: out.write.format("jdbc").options(**options).mode(mode).save())


def load_catalog_table(df: DataFrame, table: str, *, drop_if_exists: bool = False) -> int:
    """The same contract for a Parquet table in the session catalog."""
    mode = "overwrite" if drop_if_exists else "append"
    return _written(sanitize_columns(df), lambda out: out.write.format("parquet").mode(mode).saveAsTable(table))
