"""The result of every registered query as DuckDB SQL over the same tables."""

from __future__ import annotations

from .catalog import STATS_YELLOW, TABLES
from .testbed import with_ctes

# Fixed values, stated here apart from the code under test: code, name, description of every code set.
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
    "trip_type": ((1, "STREET_HAIL", "Street-hail"), (2, "DISPATCH", "Dispatch")),
    "payment": (
        (0, None, "Flex Fare trip"),
        (1, None, "Credit card"),
        (2, None, "Cash"),
        (3, None, "No charge"),
        (4, None, "Dispute"),
        (5, None, "Unknown"),
        (6, None, "Voided trip"),
    ),
    "flag": (("Y", None, "store and forward trip"), ("N", None, "not a store and forward trip")),
}
TYPE_NAMES = {"vendor": "VendorID", "rate": "RatecodeID", "trip_type": "TripType"}

YK = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

_YELLOW_OK = {
    "vendor_code": "coalesce(VendorID in (1, 2, 6, 7), false)",
    "missing_datetime": "tpep_pickup_datetime is not null and tpep_dropoff_datetime is not null",
    "dropoff_before_pickup": "coalesce(tpep_dropoff_datetime >= tpep_pickup_datetime, true)",
    "store_and_fwd_flag": "coalesce(store_and_fwd_flag in ('Y', 'N'), false)",
    "passenger_count": "coalesce(passenger_count >= 0, true)",
    "trip_distance": "coalesce(not (trip_distance < 0), true)",
}
_GREEN_OK = {
    "vendor_code": "coalesce(VendorID in (1, 2, 6), false)",
    "missing_datetime": "lpep_pickup_datetime is not null and lpep_dropoff_datetime is not null",
    "dropoff_before_pickup": "coalesce(lpep_dropoff_datetime >= lpep_pickup_datetime, true)",
    "store_and_fwd_flag": "coalesce(store_and_fwd_flag in ('Y', 'N'), false)",
    "passenger_count": "coalesce(passenger_count >= 0, true)",
    "trip_distance": "coalesce(not (trip_distance < 0), true)",
    "trip_type": "coalesce(trip_type in (1, 2), true)",
}
_OK = {"yellow": _YELLOW_OK, "green": _GREEN_OK}
_VALID = {kind: " and ".join(f"({ok})" for ok in rules.values()) for kind, rules in _OK.items()}
_KEYS = {"yellow": YK, "green": "o_orderkey"}


def _minutes(pickup: str, dropoff: str) -> str:
    return f"cast(floor((epoch_us({dropoff}) - epoch_us({pickup})) / 1e6) as bigint) // 60"


def _case(code: str, code_set: str, field: int) -> str:
    whens = " ".join(
        "when {} then {}".format(_text(row[0]), _text(row[field])) for row in CODE_SETS[code_set]
    )
    return f"case {code} {whens} end"


def _text(value) -> str:
    return "'{}'".format(value.replace("'", "''")) if isinstance(value, str) else str(value)


def _rendered(code: str, code_set: str) -> str:
    whens = " ".join(
        "when {} then {}".format(row[0], _text(f"{TYPE_NAMES[code_set]}{{code={row[0]}, description='{row[2]}'}}"))
        for row in CODE_SETS[code_set]
    )
    return f"case {code} {whens} end"


def _decoded(kind: str, column: str, code_set: str) -> str:
    named = CODE_SETS[code_set][0][1] is not None
    name = f"{_case('code', code_set, 1)} as name, " if named else ""
    return (
        f"select code, trips, {name}{_case('code', code_set, 2)} as description from"
        f" (select {column} as code, count(*) as trips from {kind}_trips group by 1) t"
    )


def _keyed(column: str) -> str:
    """A key column as text with its length in front."""
    return f"length(cast({column} as varchar)) || ':' || cast({column} as varchar)"


def _violation_sql(kind: str) -> str:
    first = " ".join(f"when not ({ok}) then '{name}'" for name, ok in _OK[kind].items())
    every = ", ".join(f"case when not ({ok}) then '{name}' end" for name, ok in _OK[kind].items())
    return (
        f"select {_KEYS[kind]}, {_VALID[kind]} as is_valid, case {first} end as violation,"
        f" concat_ws(',', {every}) as violations from {kind}_trips"
    )


def _report_sql(kind: str) -> str:
    return " union all ".join(
        f"select '{kind}' as kind, '{name}' as rule, count(*) as trips from {kind}_trips where not ({ok})"
        f" having count(*) > 0"
        for name, ok in _OK[kind].items()
    )


def _per_kind(template: str) -> str:
    return " union all ".join(template.format(kind=kind, valid=_VALID[kind]) for kind in ("yellow", "green"))


_BAND = """case when total_amount > 50 then 'High Fare Trips' when total_amount > 20 then 'Medium Fare Trips'
  when total_amount <= 20 then 'Low Fare Trips' else 'Default' end"""
_STYLE = {
    "credit_card_payment": "payment_type = 1",
    "cash_payment": "payment_type = 2",
    "street_hail": "trip_type = 1 and (payment_type <> 1 or payment_type <> 2)",
    "dispatch": "trip_type = 2 and (payment_type <> 1 or payment_type <> 2)",
    "multiple_passengers": "passenger_count > 1 and (payment_type <> 1 or payment_type <> 2)"
    " and (trip_type <> 1 or trip_type <> 2)",
}
_STYLE_NAMES = ("Credit Card Payment", "Cash Payment", "Street Hail", "Dispatch", "Multiple Passengers")
_ANY_STYLE = " or ".join(f"coalesce({c}, false)" for c in _STYLE.values())
_MATCHED = ", ".join(f"case when {c} then '{n}' end" for n, c in zip(_STYLE_NAMES, _STYLE.values()))


def _amount(c: str) -> str:
    """Two decimals with trailing zeros, and then a bare point, removed."""
    return f"regexp_replace(regexp_replace(printf('%.2f', {c}), '0+$', ''), '\\.$', '')"


_ZONED = """{kind}_trips t left join zones p on t.PULocationID = p.zone_id left join zones d on t.DOLocationID = d.zone_id"""
_PU_POINT = "concat('POINT (', cast(p.lon as varchar), ' ', cast(p.lat as varchar), ')')"
_DO_POINT = "concat('POINT (', cast(d.lon as varchar), ' ', cast(d.lat as varchar), ')')"
_SEGMENT = (
    "concat('LINESTRING (', cast(p.lon as varchar), ' ', cast(p.lat as varchar), ', ',"
    " cast(d.lon as varchar), ' ', cast(d.lat as varchar), ')')"
)
_ROUTE_POINTS = f"""pts as (select l_orderkey, cast(p.lon as varchar) || ' ' || cast(p.lat as varchar) as xy,
    row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, p.lon, p.lat) - 1 as place
  from {_ZONED.format(kind='yellow')})"""
_MESSY = "concat(p_name, '@', p_brand, '.\"v\"', p_partkey)"
_PATH = f"concat({_MESSY}, case when p_partkey % 3 > 0 then '.parquet' else '' end)"


def _with_routes(sql: str) -> str:
    full = with_ctes(f"select * from yellow_trips, zones")
    head = full[: full.rindex("select * from yellow_trips")]
    return f"{head.rstrip()}, {_ROUTE_POINTS} {sql}"


def _stats_sql() -> str:
    return " union all ".join(
        f"select '{c}' as attribute, count({c}) as non_null, cast(min({c}) as varchar) as min_value,"
        f" cast(max({c}) as varchar) as max_value, count(distinct {c}) as distinct_values from raw_yellow"
        for c in STATS_YELLOW
    )


_YELLOW_COLUMNS = f"* exclude ({YK})"
_GREEN_COLUMNS = "* exclude (o_orderkey)"
_GREEN_FEATURES = """VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, store_and_fwd_flag, RatecodeID, PULocationID,
  DOLocationID, passenger_count, trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee,
  improvement_surcharge, total_amount, payment_type, trip_type, congestion_surcharge, cbd_congestion_fee"""
_YELLOW_FEATURES = """VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID,
  store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
  improvement_surcharge, total_amount, congestion_surcharge, Airport_fee, cbd_congestion_fee"""

_SQL = {
    "vendor_fare_summary": f"""select {_case('VendorID', 'vendor', 2)} as vendor, {_BAND} as fare_band,
        count(*) as trips, sum(total_amount) as total_amount, cast(sum(minutes) as bigint) as total_minutes,
        avg(minutes) as avg_minutes
      from (select *, {_minutes('tpep_pickup_datetime', 'tpep_dropoff_datetime')} as minutes from yellow_trips
            where {_VALID['yellow']}) v group by 1, 2""",
    "read_yellow": f"""select {_YELLOW_COLUMNS} replace (case when l_orderkey % 2 = 1 then cbd_congestion_fee end
        as cbd_congestion_fee) from yellow_trips""",
    "read_green": f"""select {_GREEN_COLUMNS} replace (case when o_orderkey % 2 = 1 then cbd_congestion_fee end
        as cbd_congestion_fee) from green_trips""",
    "read_kinds": """select count(*) as trips, count(*) as origins,
        cast(count(*) filter (o_orderkey % 2 = 1) * 0.75 as double) as fees,
        cast(sum(passenger_count) as double) as passengers from green_trips""",
    "feature_files": f"""select cast(lpep_pickup_datetime as date) as pickup_date, count(*) as n_features,
        count({_PU_POINT}) as n_points, min({_PU_POINT}) as first_geom
      from raw_green t left join zones p on t.PULocationID = p.zone_id
      where lpep_pickup_datetime >= timestamp '1997-01-01 00:00:00' group by 1""",
    "zone_files": f"select o_orderkey, p.lon as pu_lon, p.lat as pu_lat from {_ZONED.format(kind='green')}",
    "document_files": f"select {_GREEN_COLUMNS} from green_trips",
    "sample_files": """select 'sampled' as what, count(*) // 3 as rows, true as same_columns from orders
      union all select 'strange', 0, true""",
    "ingest_quarantine": """select 'green' as kind, 'processed' as status, cast(1 as bigint) as files,
        count(*) as records, cast(0 as bigint) as quarantined, cast(0 as bigint) as explained from orders
      union all select null, 'schema_mismatch', 3, 0, 3, 2
      union all select null, 'not_parquet', 1, 0, 1, 0""",
    "coerce_types": """select l_orderkey, l_linenumber, try_cast(l_orderkey * 300007 as integer) as int_value,
        l_orderkey * 300007 > 2147483647 as is_narrowed, cast(l_partkey as double) as double_value,
        cast(l_suppkey as varchar) as text_value, l_quantity as present_value, cast(null as double) as absent_value
      from lineitem""",
    "datetime_parse": """select event_id,
        case event_id % 5 when 0 then date_trunc('second', ts) when 1 then ts when 2 then date_trunc('minute', ts)
        end as from_text,
        ts as from_micros, date_trunc('millisecond', ts) as at_millis from events""",
    "trip_duration": f"""select {YK}, {_minutes('tpep_pickup_datetime', 'tpep_dropoff_datetime')} as minutes,
        {_minutes('tpep_pickup_datetime', "(tpep_dropoff_datetime - interval '30.5 seconds')")} as minutes_shifted
      from yellow_trips""",
    "valid_yellow": f"select {_YELLOW_COLUMNS} from yellow_trips where {_VALID['yellow']}",
    "valid_green": f"select {_GREEN_COLUMNS} from green_trips where {_VALID['green']}",
    "first_violation_yellow": _violation_sql("yellow"),
    "first_violation_green": _violation_sql("green"),
    "violation_report": f"{_report_sql('yellow')} union all {_report_sql('green')}",
    "valid_share": _per_kind(
        "select '{kind}' as kind, count(*) as trips, count(*) filter ({valid}) as valid_trips,"
        " count(*) filter ({valid}) / count(*) as valid_share from {kind}_trips"
    ),
    "street_hail_valid": f"select {_GREEN_COLUMNS} from green_trips where {_VALID['green']} and trip_type = 1",
    "filter_by_attributes": f"""select {_GREEN_COLUMNS} from green_trips where VendorID in (1, 2) and payment_type = 1
        and trip_type = 2 and PULocationID between 1 and 132""",
    "filter_by_ranges": f"""select {_YELLOW_COLUMNS} from yellow_trips
        where tpep_pickup_datetime between timestamp '1996-01-01 00:00:00' and timestamp '1998-12-31 23:59:59'
        and trip_distance between 2 and 10 and fare_amount >= 10 and tip_amount <= 4
        and total_amount between 20 and 60""",
    "retention_30d": f"""select {_GREEN_COLUMNS} from green_trips
        where lpep_pickup_datetime >= timestamp '1998-12-01 00:00:00' - interval 30 day""",
    "decode_vendor": _decoded("yellow", "VendorID", "vendor"),
    "decode_rate": _decoded("yellow", "RatecodeID", "rate"),
    "decode_trip_type": _decoded("green", "trip_type", "trip_type"),
    "decode_payment": _decoded("green", "payment_type", "payment"),
    "decode_flag": _decoded("yellow", "store_and_fwd_flag", "flag"),
    "decode_join": f"""select {YK}, RatecodeID, {_case('RatecodeID', 'rate', 1)} as RatecodeID_name,
        {_case('RatecodeID', 'rate', 2)} as RatecodeID_description from yellow_trips""",
    "code_tostring": f"""select o_orderkey, {_rendered('VendorID', 'vendor')} as vendor,
        {_rendered('RatecodeID', 'rate')} as rate, {_rendered('trip_type', 'trip_type')} as trip_type
      from green_trips""",
    "code_membership": """select o_orderkey, coalesce(VendorID in (1, 2, 6, 7), false) as vendor_known,
        coalesce(RatecodeID in (1, 2, 3, 4, 5, 6, 99), false) as rate_known,
        coalesce(trip_type in (1, 2), false) as trip_type_known,
        coalesce(payment_type between 0 and 6, false) as payment_known,
        coalesce(store_and_fwd_flag in ('Y', 'N'), false) as flag_known from green_trips""",
    "fare_band": f"""select {_BAND} as band,
        case when total_amount > 50 then '#FF0000' when total_amount > 20 then '#FFA500'
          when total_amount <= 20 then '#00FF00' else '#808080' end as colour,
        case when total_amount > 50 then 12 when total_amount > 20 then 10
          when total_amount <= 20 then 8 else 6 end as marker,
        count(*) as trips, sum(total_amount) as total_amount from yellow_trips group by 1, 2, 3""",
    "style_rules": f"""select o_orderkey, {', '.join(f'({c}) as {n}' for n, c in _STYLE.items())},
        case when {_ANY_STYLE} then concat_ws('|', {_MATCHED}) else 'Default' end as matched from green_trips""",
    "style_else": f"""select o_orderkey, payment_type, trip_type, passenger_count from green_trips
        where not ({_ANY_STYLE})""",
    "marker_size": f"select {YK}, total_amount * cast(0.2 as double) + 5 as marker from yellow_trips",
    "passenger_size": f"select {YK}, passenger_count * 3 as marker from yellow_trips",
    "route_width": f"""select {YK}, case when trip_distance < 1 then 1 when trip_distance < 5 then 2
        when trip_distance < 10 then 3 when trip_distance is not null then 4 end as width from yellow_trips""",
    "label_simple": f"select {YK}, cast(total_amount as varchar) as label from yellow_trips",
    "label_full": f"""select {YK}, case when total_amount is not null and passenger_count is not null
        then concat('$', {_amount('total_amount')}, chr(10), cast(trip_distance as varchar), ' mi', chr(10),
          cast(passenger_count as varchar), ' pax') end as label from yellow_trips""",
    "zone_enrich": f"""select {YK}, p.lon as pu_lon, p.lat as pu_lat, d.lon as do_lon, d.lat as do_lat
      from {_ZONED.format(kind='yellow')}""",
    "point_features": f"""select o_orderkey, {_PU_POINT} as pickup_geom, {_DO_POINT} as dropoff_geom
      from {_ZONED.format(kind='green')}""",
    "line_features": f"select o_orderkey, {_SEGMENT} as geom from {_ZONED.format(kind='green')}",
    "feature_table": f"""select {_PU_POINT} as geom, 4326 as srid, {_GREEN_FEATURES}
      from raw_green t left join zones p on t.PULocationID = p.zone_id""",
    "feature_lines_yellow": f"""select {_SEGMENT} as geom, 4326 as srid, {_YELLOW_FEATURES}
      from raw_yellow t left join zones p on t.PULocationID = p.zone_id
      left join zones d on t.DOLocationID = d.zone_id""",
    "attribute_stats": _stats_sql(),
    "row_counts": " union all ".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in TABLES),
    "doc_json_fields": f"""select o_orderkey, cast(VendorID as varchar) as vendor,
        strftime(lpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S') as pickup, cast(total_amount as varchar) as total,
        cast(passenger_count as varchar) as passengers, cast(({_VALID['green']}) as varchar) as valid,
        cast({_minutes('lpep_pickup_datetime', 'lpep_dropoff_datetime')} as varchar) as minutes
      from green_trips""",
    "doc_read": f"select {_YELLOW_COLUMNS} from yellow_trips",
    "json_round_trip": _per_kind(
        "select '{kind}' as kind, count(*) as trips, cast(0 as bigint) as mismatches from {kind}_trips"
    ),
    "serialization_rate": """select count(*) as trips, count(*) as documents, cast(1 as double) as success_rate
      from yellow_trips""",
    "sample_exact": f"""select o_orderkey, total_amount from green_trips
      order by md5(concat({_keyed('o_orderkey')}, '@42')), o_orderkey limit 500""",
    "sample_large": f"""select {YK}, total_amount from yellow_trips qualify row_number() over (
        order by md5(concat({', '.join(_keyed(c) for c in YK.split(', '))}, '@42')), {YK}) <= (select count(*) // 2 from lineitem)""",
    "first_n": f"select {YK}, fare_amount from yellow_trips order by {YK} limit 5",
    "kind_detect_lenient": """select p_partkey, case p_partkey % 6 when 0 then 'yellow' when 1 then 'green'
        else 'unknown' end as kind from part""",
    "kind_detect_strict": """select p_partkey, case p_partkey % 5 when 0 then 'yellow' when 1 then 'green'
        else 'unknown' end as kind from part""",
    "table_name": f"""select p_partkey,
        case when p_partkey % 3 > 0 then {_MESSY} else concat(p_name, '@', p_brand) end as table_name,
        concat('.', p_brand) as hidden_name,
        case when p_partkey % 3 > 0 then concat({_MESSY}, '_schema_mismatch.parquet')
          else concat(p_name, '@', p_brand, '_schema_mismatch."v"', p_partkey) end as quarantine_name
      from part""",
    "sanitize_names": f"""select p_partkey, lower(regexp_replace({_MESSY}, '[^a-zA-Z0-9_]', '_', 'g')) as table_name,
        regexp_replace({_MESSY}, '[^a-zA-Z0-9_]', '_', 'g') as column_name from part""",
    "quote_identifiers": f"""select p_partkey, concat('"', replace({_MESSY}, '"', '""'), '"') as quoted from part""",
    "pending_files": """select concat('/in/file_', p_partkey, '.parquet') as path, cast(p_size as bigint) as length
      from part where not exists (
        select 1 from ledger l where l.status = 'processed' and l.path = concat('/in/file_', p_partkey, '.parquet'))""",
    "ledger_totals": """select coalesce(k, 'total') as kind, files, files_processed, files_errored, records from (
        select k, count(*) as files, count(*) filter (status = 'processed') as files_processed,
          count(*) filter (status <> 'processed') as files_errored,
          cast(coalesce(sum(records) filter (status = 'processed'), 0) as bigint) as records
        from (select coalesce(kind, 'unknown') as k, * from ledger) l group by rollup (k)) t""",
    "status_totals": """select kind, status, count(*) as files, cast(coalesce(sum(records), 0) as bigint) as records
      from ledger group by kind, status""",
    "ledger_rates": """select time_bucket(interval '1 minute', finished_at) as window_start, kind, count(*) as files,
        cast(coalesce(sum(records), 0) as bigint) as records,
        cast(coalesce(sum(records), 0) as bigint) / 60 as records_per_second from ledger group by 1, 2""",
    "timer_stats": """select kind, count(us) as timed, cast(sum(us) as bigint) / 1e6 as total_seconds,
        max(us) / 1e6 as max_seconds from ledger group by kind""",
    "hourly_trips": """select time_bucket(interval '1 hour', tpep_pickup_datetime) as window_start, VendorID,
        count(*) as trips from yellow_trips group by 1, 2""",
    "stream_hourly": """select time_bucket(interval '1 hour', tpep_pickup_datetime) as window_start, VendorID,
        count(*) as trips from yellow_trips group by 1, 2
      having window_start + interval 1 hour <= (select max(tpep_pickup_datetime) from yellow_trips) - interval 30 day""",
    "bulk_chunks": """select 'yellowtaxi' as index, count(*) as n_docs, 2 * count(*) as n_lines,
        cast(0 as bigint) as oversized from lineitem
      union all select 'greentaxi', count(*), 2 * count(*), 0 from orders""",
    "sink_totals": """select case when user_id % 2 = 0 then 'yellowtaxi' else 'greentaxi' end as index,
        count(*) as operations, count(*) filter (event_type <> 'error') as succeeded,
        count(*) filter (event_type = 'error') as failed,
        cast(sum(floor(value)) filter (event_type <> 'error') as bigint) as documents from events group by 1""",
    "ingest_directory": " union all ".join(
        f"select '{kind}' as kind, 'processed' as status, count(*) as records, count(*) as loaded,"
        f" sum(total_amount) as total_amount from {kind}_trips"
        for kind in ("yellow", "green")
    ),
    "stream_valid_trips": f"""select VendorID, count(*) as trips, sum(fare_amount) as fare_amount from green_trips
      where {_VALID['green']} group by VendorID""",
}
_SQL["narrowing_report"] = (
    "with shown as (select o_orderkey, case when o_orderkey % 10 = 0 then null else passenger_count end as passenger_count,"
    " * exclude (o_orderkey, passenger_count) from green_trips), "
    + "report as ("
    + " union all ".join(
        f"select 'green' as kind, '{name}' as rule, count(*) as trips from shown where not ({ok})" for name, ok in _GREEN_OK.items()
    )
    + " union all select 'green', 'narrowing', count(*) from shown where o_orderkey % 10 = 0)"
    " select * from report where trips > 0"
)
_SQL["footer_counts"] = _SQL["row_counts"]

ORACLE: dict[str, str] = {name: with_ctes(sql) for name, sql in _SQL.items()}
for _name, _segments in (("route_lines", 10000), ("route_line_parts", 4)):
    ORACLE[_name] = _with_routes(
        f"""select l_orderkey, part_no, cast(count(*) as integer) as n_points,
      case when count(*) > 1 and count(xy) = count(*)
        then 'LINESTRING (' || string_agg(xy, ', ' order by place) || ')' end as geom
    from pts join (select l_orderkey,
        unnest(range(0, greatest(1, cast(ceil((count(*) - 1) / {_segments}.0) as bigint)))) as part_no
      from pts group by l_orderkey) parts using (l_orderkey)
    where place between part_no * {_segments} and (part_no + 1) * {_segments}
    group by l_orderkey, part_no"""
    )
