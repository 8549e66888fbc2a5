"""Trips derived from the test tables: yellow from lineitem, green from orders.

Each column is one SQL expression that Spark and DuckDB read alike, except for the minute
arithmetic. Amounts are multiples of 0.25, so sums of doubles are exact in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KINDS

YELLOW_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
GREEN_KEYS = ("o_orderkey",)
KEYS = {"yellow": YELLOW_KEYS, "green": GREEN_KEYS}
SOURCE = {"yellow": "lineitem", "green": "orders"}
N_ZONES = 265


def _spark_add(ts: str, minutes: str) -> str:
    return f"timestampadd(MINUTE, cast({minutes} as int), {ts})"


def _duckdb_add(ts: str, minutes: str) -> str:
    return f"({ts} + to_minutes(cast({minutes} as bigint)))"


def _d(value: float) -> str:
    return f"cast({value} as double)"


def _yellow(add: Callable[[str, str], str]) -> dict[str, str]:
    tolls = f"case when l_suppkey % 10 = 0 then {_d(6.75)} else {_d(0)} end"
    total = (
        f"l_quantity * {_d(1.5)} + {_d(3.0)} + (l_linenumber % 3) * {_d(0.5)} + {_d(4.75)}"
        f" + (l_partkey % 20) * {_d(0.25)} + ({tolls})"
    )
    return {
        "VendorID": "cast(case l_linenumber when 1 then 1 when 2 then 2 when 3 then 6 when 4 then 7"
        " when 5 then 3 when 6 then null else 1 end as int)",
        "tpep_pickup_datetime": add("l_shipdate", "l_partkey % 1440"),
        "tpep_dropoff_datetime": "case when l_partkey % 53 = 0 then null else "
        + add("l_shipdate", "l_partkey % 1440 + l_quantity - 3")
        + " end",
        "passenger_count": "cast(case when l_suppkey % 17 = 0 then null"
        " else cast(l_quantity as bigint) % 7 - 1 end as bigint)",
        "trip_distance": f"(l_quantity - {_d(2.0)}) * {_d(0.25)}",
        "RatecodeID": "cast(case l_partkey % 8 when 7 then 99 when 0 then 42 else l_partkey % 8 end as bigint)",
        "store_and_fwd_flag": "case when l_returnflag = 'N' then 'N' when l_returnflag = 'R' then 'Y'"
        " when l_linestatus = 'F' then 'N' else null end",
        "PULocationID": "cast(l_partkey % 265 + 1 as int)",
        "DOLocationID": "cast(l_suppkey % 265 + 1 as int)",
        "payment_type": "cast(l_orderkey % 7 as bigint)",
        "fare_amount": f"l_quantity * {_d(1.5)} + {_d(3.0)}",
        "extra": f"(l_linenumber % 3) * {_d(0.5)}",
        "mta_tax": _d(0.5),
        "tip_amount": f"(l_partkey % 20) * {_d(0.25)}",
        "tolls_amount": tolls,
        "improvement_surcharge": _d(1.0),
        "total_amount": f"case when l_orderkey % 97 = 0 then null else {total} end",
        "congestion_surcharge": _d(2.5),
        "Airport_fee": f"case when l_partkey % 8 = 2 then {_d(1.75)} else {_d(0)} end",
        "cbd_congestion_fee": _d(0.75),
    }


def _green(add: Callable[[str, str], str]) -> dict[str, str]:
    return {
        "VendorID": "cast(case o_orderkey % 6 when 0 then 1 when 1 then 2 when 2 then 6 when 3 then 7"
        " when 4 then 1 else 2 end as int)",
        "lpep_pickup_datetime": add("o_orderdate", "o_custkey % 1440"),
        "lpep_dropoff_datetime": add("o_orderdate", "o_custkey % 1440 + o_orderkey % 60 - 2"),
        "store_and_fwd_flag": "case when o_orderstatus = 'P' then 'Y' when o_orderkey % 41 = 0 then null else 'N' end",
        "RatecodeID": "cast(case o_custkey % 8 when 7 then 99 when 0 then 42 else o_custkey % 8 end as bigint)",
        "PULocationID": "cast(o_custkey % 265 + 1 as int)",
        "DOLocationID": "cast(o_orderkey % 265 + 1 as int)",
        "passenger_count": "cast(case when o_orderkey % 31 = 0 then null else o_orderkey % 6 end as bigint)",
        "trip_distance": f"(o_orderkey % 60) * {_d(0.25)}",
        "fare_amount": f"(o_orderkey % 60) * {_d(0.75)} + {_d(3.0)}",
        "extra": _d(0.5),
        "mta_tax": _d(0.5),
        "tip_amount": f"(o_custkey % 12) * {_d(0.5)}",
        "tolls_amount": _d(0),
        "ehail_fee": "cast(null as double)",
        "improvement_surcharge": _d(1.0),
        "total_amount": f"case when o_orderkey % 89 = 0 then null"
        f" else (o_orderkey % 60) * {_d(0.75)} + {_d(5.0)} + (o_custkey % 12) * {_d(0.5)} end",
        "payment_type": "cast(case when o_orderkey % 29 = 0 then null else o_custkey % 7 end as bigint)",
        "trip_type": "cast(case when o_orderkey % 23 = 0 then null when o_orderkey % 19 = 0 then 3"
        " else o_orderkey % 2 + 1 end as bigint)",
        "congestion_surcharge": _d(2.75),
        "cbd_congestion_fee": _d(0.75),
    }


_COLUMNS = {"yellow": _yellow, "green": _green}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str, kind: str, keys: bool = False) -> DataFrame:
    """File columns of one kind; ``keys`` puts the source table's row key in front."""
    columns = [f"{sql} as {name}" for name, sql in _COLUMNS[kind](_spark_add).items()]
    return table(spark, sf_dir, SOURCE[kind]).selectExpr(*(KEYS[kind] if keys else ()), *columns)


def trip_files(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Trips to be written as trip files, whose columns are all nullable.

    Literal columns are not nullable and would be written so; the union with an empty frame of
    the file schema lifts that.
    """
    return raw_trips(spark, sf_dir, kind).unionByName(spark.createDataFrame([], KINDS[kind].file_schema))


def zones(spark: SparkSession) -> DataFrame:
    zone = F.col("id")
    return spark.range(1, N_ZONES + 1).select(
        zone.cast("int").alias("zone_id"),
        (F.lit(-74.25) + (zone % 23) * F.lit(0.03125)).alias("lon"),
        (F.lit(40.5) + F.floor(zone / 23) * F.lit(0.03125)).alias("lat"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingestion ledger with one file per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('/in/file_', event_id, '.parquet') as path",
        "concat('file_', event_id, '.parquet') as file_name",
        "case when event_type = 'error' and event_id % 4 < 2 then null"
        " when user_id % 2 = 0 then 'yellow' else 'green' end as kind",
        "case when event_type <> 'error' then 'processed' when event_id % 4 = 0 then 'not_parquet'"
        " when event_id % 4 = 1 then 'schema_mismatch' when event_id % 4 = 2 then 'processing_error'"
        " else 'unexpected_error' end as status",
        "case when event_type <> 'error' then cast(floor(value) as bigint) end as records",
        "event_id div 10 as batch_id",
        "ts - (event_id % 90) * 1000137 * INTERVAL '0.000001' SECOND as started_at",
        "ts as finished_at",
    )


def _cte(kind: str) -> str:
    columns = ", ".join(f"{sql} as {name}" for name, sql in _COLUMNS[kind](_duckdb_add).items())
    return f"raw_{kind} as (select {', '.join(KEYS[kind])}, {columns} from {SOURCE[kind]})"


def _typed_cte(kind: str) -> str:
    narrow = {"passenger_count", "RatecodeID", "payment_type", "trip_type"}
    columns = []
    for name in _COLUMNS[kind](_duckdb_add):
        if name == "ehail_fee":
            continue
        alias = "airport_fee" if name == "Airport_fee" else name
        columns.append(f"cast({name} as integer) as {alias}" if name in narrow else f"{name} as {alias}")
    return f"{kind} as (select {', '.join(KEYS[kind])}, {', '.join(columns)} from raw_{kind})"


ZONES_CTE = (
    f"zones as (select cast(z as integer) as zone_id, {_d(-74.25)} + (z % 23) * {_d(0.03125)} as lon,"
    f" {_d(40.5)} + floor(z / 23) * {_d(0.03125)} as lat from range(1, {N_ZONES + 1}) t(z))"
)
LEDGER_CTE = """ledger as (select
    concat('/in/file_', event_id, '.parquet') as path,
    case when event_type = 'error' and event_id % 4 < 2 then null
         when user_id % 2 = 0 then 'yellow' else 'green' end as kind,
    case when event_type <> 'error' then 'processed' when event_id % 4 = 0 then 'not_parquet'
         when event_id % 4 = 1 then 'schema_mismatch' when event_id % 4 = 2 then 'processing_error'
         else 'unexpected_error' end as status,
    case when event_type <> 'error' then cast(floor(value) as bigint) end as records,
    (event_id % 90) * 1000137 as us,
    ts as finished_at
  from events)"""


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the derived tables that it mentions."""
    ctes = []
    for kind in ("yellow", "green"):
        if f"{kind}_trips" in sql or f"raw_{kind}" in sql:
            ctes.append(_cte(kind))
        if f"{kind}_trips" in sql:
            ctes.append(_typed_cte(kind).replace(f"{kind} as (", f"{kind}_trips as (", 1))
    if "zones" in sql:
        ctes.append(ZONES_CTE)
    if " ledger" in sql:
        ctes.append(LEDGER_CTE)
    if ctes and sql.startswith("with "):
        return f"with {', '.join(ctes)}, {sql.removeprefix('with ')}"
    return f"with {', '.join(ctes)} {sql}" if ctes else sql
