"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes, coerce, names, rules, style
from ..functions.geometry import point_wkt, segment_wkt
from ..operators import documents, features, metrics, quality, sampling, selection
from ..operators.layout import spread
from ..schemas import GREEN, YELLOW
from ..session import ensure_checkpoint_dir, scratch_dir
from ..sinks.bulk import bulk_chunks
from ..sinks.ingest_sinks import TripTables
from ..sources import files, footers
from ..sources.trips import read_any, read_documents, read_trips, read_zones, typed_trips
from ..streaming.ingest import IngestConfig, run_once
from ..streaming.ledger import pending_files
from ..streaming.trips import stream_trips, windowed_counts
from .testbed import KEYS, ledger, raw_trips, table, trip_files, zones

AS_OF = datetime(1998, 12, 1)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
STATS_YELLOW = (
    "VendorID PULocationID DOLocationID payment_type trip_distance fare_amount tip_amount total_amount"
    " tpep_pickup_datetime"
).split()


def trips(spark: SparkSession, sf_dir: str, kind: str, keys: bool = False, costly: bool = False, **options) -> DataFrame:
    """Typed trips. ``costly``: in as many partitions as a shuffle has, since the test tables have one row
    group each and documents cost more than moving rows."""
    keep = KEYS[kind] if keys else ()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) if costly else None
    return typed_trips(spread(raw_trips(spark, sf_dir, kind, keys), parts), kind, keep=keep, **options)


def vendor_fare_summary(spark, sf_dir):
    """Flagship: valid yellow trips by vendor and fare band."""
    valid = trips(spark, sf_dir, "yellow", valid_only=True)
    return (
        valid.select(
            codes.decode("VendorID", "vendor").alias("vendor"),
            style.fare_band().alias("fare_band"),
            "total_amount",
            coerce.duration_minutes(YELLOW.pickup, YELLOW.dropoff).alias("minutes"),
        )
        .groupBy("vendor", "fare_band")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("total_amount").alias("total_amount"),
            F.sum("minutes").alias("total_minutes"),
            F.avg("minutes").alias("avg_minutes"),
        )
    )


def _mixed_files(spark, sf_dir, kind):
    """Trip files as a folder gathers them: those of even keys are older, without the congestion fee and
    with passenger counts as doubles, and lie in a nested folder."""
    root, key = scratch_dir(spark, f"read-{kind}"), KEYS[kind][0]
    keyed = raw_trips(spark, sf_dir, kind, keys=True)
    new, old = (keyed.where(F.col(key) % 2 == odd).drop(*KEYS[kind]) for odd in (1, 0))
    new.write.parquet(f"{root}/trips")
    old = old.drop("cbd_congestion_fee").withColumn("passenger_count", F.col("passenger_count").cast("double"))
    old.write.parquet(f"{root}/trips/older")
    return f"{root}/trips"


def read_yellow(spark, sf_dir):
    return read_trips(spark, _mixed_files(spark, sf_dir, "yellow"), "yellow")


def read_green(spark, sf_dir):
    return read_trips(spark, _mixed_files(spark, sf_dir, "green"), "green")


def read_kinds(spark, sf_dir):
    """Rows as the kind-agnostic reader gives them, and how many it can tell apart by origin. Files differ in
    columns and in types."""
    return read_any(spark, _mixed_files(spark, sf_dir, "green"), with_origin=True).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_distinct("source_file", "source_row").alias("origins"),
        F.sum("cbd_congestion_fee").alias("fees"),
        F.sum("passenger_count").alias("passengers"),
    )


def coerce_types(spark, sf_dir):
    wide = F.col("l_orderkey") * F.lit(300007)
    df = table(spark, sf_dir, "lineitem")
    return df.select(
        "l_orderkey",
        "l_linenumber",
        coerce.to_int(wide).alias("int_value"),
        coerce.is_narrowed(wide).alias("is_narrowed"),
        coerce.to_double("l_partkey").alias("double_value"),
        coerce.to_str("l_suppkey").alias("text_value"),
        coerce.optional(df, "L_QUANTITY", "double").alias("present_value"),
        coerce.optional(df, "airport_fee", "double").alias("absent_value"),
    )


def datetime_parse(spark, sf_dir):
    stamp = F.col("ts").cast("string")
    text = (
        F.when(F.col("event_id") % 5 == 0, F.substring(stamp, 1, 19))
        .when(F.col("event_id") % 5 == 1, F.translate(stamp, " ", "T"))
        .when(F.col("event_id") % 5 == 2, F.translate(F.substring(stamp, 1, 16), " ", "T"))
        .when(F.col("event_id") % 5 == 3, F.concat(F.lit("on "), stamp))
    )
    micros = coerce.epoch_micros("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        coerce.to_datetime(text, T.StringType(), strict=False).alias("from_text"),
        coerce.to_datetime(micros, T.LongType()).alias("from_micros"),
        coerce.to_millis_precision("ts").alias("at_millis"),
    )


def trip_duration(spark, sf_dir):
    yellow = trips(spark, sf_dir, "yellow", keys=True)
    shifted = F.col(YELLOW.dropoff) - F.expr("INTERVAL '30.5' SECOND")
    return yellow.select(
        *KEYS["yellow"],
        coerce.duration_minutes(YELLOW.pickup, YELLOW.dropoff).alias("minutes"),
        coerce.duration_minutes(F.col(YELLOW.pickup), shifted).alias("minutes_shifted"),
    )


def valid_yellow(spark, sf_dir):
    return trips(spark, sf_dir, "yellow", valid_only=True)


def valid_green(spark, sf_dir):
    return trips(spark, sf_dir, "green", valid_only=True)


def _violations(spark, sf_dir, kind):
    return trips(spark, sf_dir, kind, keys=True).select(
        *KEYS[kind],
        rules.is_valid(kind).alias("is_valid"),
        rules.first_violation(kind).alias("violation"),
        F.array_join(rules.violations(kind), ",").alias("violations"),
    )


def first_violation_yellow(spark, sf_dir):
    return _violations(spark, sf_dir, "yellow")


def first_violation_green(spark, sf_dir):
    return _violations(spark, sf_dir, "green")


def violation_report(spark, sf_dir):
    reports = [quality.violation_report(trips(spark, sf_dir, kind), kind) for kind in ("yellow", "green")]
    return reports[0].unionByName(reports[1])


def narrowing_report(spark, sf_dir):
    """Violations of trips some of whose passenger counts are beyond 32 bits."""
    count = F.when(F.col("o_orderkey") % 10 == 0, F.lit(3_000_000_000)).otherwise(F.col("passenger_count"))
    raw = raw_trips(spark, sf_dir, "green", keys=True).withColumn("passenger_count", count)
    return quality.violation_report(typed_trips(raw, "green", flag_narrowing=True), "green")


def valid_share(spark, sf_dir):
    shares = [
        quality.valid_share(trips(spark, sf_dir, kind), kind).select(F.lit(kind).alias("kind"), "*")
        for kind in ("yellow", "green")
    ]
    return shares[0].unionByName(shares[1])


def street_hail_valid(spark, sf_dir):
    return trips(spark, sf_dir, "green", criteria={"trip_type": 1}, valid_only=True)


def filter_by_attributes(spark, sf_dir):
    criteria = {"vendor": [1, 2], "payment": 1, "trip_type": 2, "pickup_zone": list(range(1, 133))}
    return typed_trips(raw_trips(spark, sf_dir, "green"), "green", criteria=criteria)


def filter_by_ranges(spark, sf_dir):
    criteria = {
        "pickup_time": (datetime(1996, 1, 1), datetime(1998, 12, 31, 23, 59, 59)),
        "distance": (2.0, 10.0),
        "fare": (10.0, None),
        "tip": (None, 4.0),
        "total": (20.0, 60.0),
    }
    return typed_trips(raw_trips(spark, sf_dir, "yellow"), "yellow", criteria=criteria)


def retention_30d(spark, sf_dir):
    return selection.expire(trips(spark, sf_dir, "green"), GREEN.pickup, as_of=AS_OF)


def _decoded(df, column, code_set):
    named = any(row[1] is not None for row in codes.CODE_SETS[code_set])
    fields = ("name", "description") if named else ("description",)
    return (
        df.groupBy(F.col(column).alias("code"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select("code", "trips", *[codes.decode("code", code_set, f).alias(f) for f in fields])
    )


def decode_vendor(spark, sf_dir):
    return _decoded(trips(spark, sf_dir, "yellow"), "VendorID", "vendor")


def decode_rate(spark, sf_dir):
    return _decoded(trips(spark, sf_dir, "yellow"), "RatecodeID", "rate")


def decode_trip_type(spark, sf_dir):
    return _decoded(trips(spark, sf_dir, "green"), "trip_type", "trip_type")


def decode_payment(spark, sf_dir):
    return _decoded(trips(spark, sf_dir, "green"), "payment_type", "payment")


def decode_flag(spark, sf_dir):
    return _decoded(trips(spark, sf_dir, "yellow"), "store_and_fwd_flag", "flag")


def decode_join(spark, sf_dir):
    joined = codes.decode_join(trips(spark, sf_dir, "yellow", keys=True), "RatecodeID", "rate")
    return joined.select(*KEYS["yellow"], "RatecodeID", "RatecodeID_name", "RatecodeID_description")


def code_tostring(spark, sf_dir):
    return trips(spark, sf_dir, "green", keys=True).select(
        "o_orderkey",
        codes.render_code("VendorID", "vendor").alias("vendor"),
        codes.render_code("RatecodeID", "rate").alias("rate"),
        codes.render_code("trip_type", "trip_type").alias("trip_type"),
    )


def code_membership(spark, sf_dir):
    return trips(spark, sf_dir, "green", keys=True).select(
        "o_orderkey",
        codes.is_code("VendorID", "vendor").alias("vendor_known"),
        codes.is_code("RatecodeID", "rate").alias("rate_known"),
        codes.is_code("trip_type", "trip_type").alias("trip_type_known"),
        codes.is_code("payment_type", "payment").alias("payment_known"),
        codes.is_code("store_and_fwd_flag", "flag").alias("flag_known"),
    )


def fare_band(spark, sf_dir):
    return (
        trips(spark, sf_dir, "yellow")
        .select(
            style.fare_band().alias("band"),
            style.fare_colour().alias("colour"),
            style.fare_size().alias("marker"),
            "total_amount",
        )
        .groupBy("band", "colour", "marker")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("total_amount"))
    )


def style_rules(spark, sf_dir):
    flags = style.rule_flags()
    return trips(spark, sf_dir, "green", keys=True).select(
        "o_orderkey",
        *[flag.alias(name.lower().replace(" ", "_")) for name, flag in flags.items()],
        F.array_join(style.matched_rules(), "|").alias("matched"),
    )


def style_else(spark, sf_dir):
    return trips(spark, sf_dir, "green", keys=True).filter(style.is_else()).select(
        "o_orderkey", "payment_type", "trip_type", "passenger_count"
    )


def marker_size(spark, sf_dir):
    return trips(spark, sf_dir, "yellow", keys=True).select(*KEYS["yellow"], style.marker_size().alias("marker"))


def passenger_size(spark, sf_dir):
    return trips(spark, sf_dir, "yellow", keys=True).select(*KEYS["yellow"], style.passenger_size().alias("marker"))


def route_width(spark, sf_dir):
    return trips(spark, sf_dir, "yellow", keys=True).select(*KEYS["yellow"], style.route_width().alias("width"))


def label_simple(spark, sf_dir):
    return trips(spark, sf_dir, "yellow", keys=True).select(*KEYS["yellow"], style.total_label().alias("label"))


def label_full(spark, sf_dir):
    return trips(spark, sf_dir, "yellow", keys=True).select(*KEYS["yellow"], style.trip_label().alias("label"))


def zone_enrich(spark, sf_dir):
    joined = features.with_zones(trips(spark, sf_dir, "yellow", keys=True), zones(spark))
    return joined.select(*KEYS["yellow"], "pu_lon", "pu_lat", "do_lon", "do_lat")


def point_features(spark, sf_dir):
    joined = features.with_zones(trips(spark, sf_dir, "green", keys=True), zones(spark))
    return joined.select(
        "o_orderkey",
        point_wkt("pu_lon", "pu_lat").alias("pickup_geom"),
        point_wkt("do_lon", "do_lat").alias("dropoff_geom"),
    )


def line_features(spark, sf_dir):
    joined = features.with_zones(trips(spark, sf_dir, "green", keys=True), zones(spark))
    return joined.select("o_orderkey", segment_wkt("pu_lon", "pu_lat", "do_lon", "do_lat").alias("geom"))


def _route_points(spark, sf_dir):
    joined = features.with_zones(trips(spark, sf_dir, "yellow", keys=True), zones(spark))
    return joined.select(*KEYS["yellow"], F.col("pu_lon").alias("lon"), F.col("pu_lat").alias("lat"))


def route_lines(spark, sf_dir):
    """Routes through the pickup zones of the trips of one order, in line order."""
    ties = ("l_partkey", "l_suppkey")
    return features.route_lines(_route_points(spark, sf_dir), ["l_orderkey"], "l_linenumber", ties).drop("srid")


def route_line_parts(spark, sf_dir):
    """The same routes in parts of four segments, the positions with gaps in between."""
    points = _route_points(spark, sf_dir).withColumn("seq", F.col("l_linenumber") * 9_000)
    ties = ("l_partkey", "l_suppkey")
    return features.route_lines(points, ["l_orderkey"], "seq", ties, part_points=4).drop("srid")


def feature_table(spark, sf_dir):
    return features.to_features(raw_trips(spark, sf_dir, "green"), "green", zones(spark))


def feature_lines_yellow(spark, sf_dir):
    return features.to_features(raw_trips(spark, sf_dir, "yellow"), "yellow", zones(spark), geometry="line")


def attribute_stats(spark, sf_dir):
    return features.attribute_stats(raw_trips(spark, sf_dir, "yellow"), STATS_YELLOW, exact=True)


def feature_files(spark, sf_dir):
    """Features through the date-partitioned layout and back: rows per date, read with a pruned date range."""
    root = scratch_dir(spark, "features")
    features.write_features(feature_table(spark, sf_dir), "green", root)
    stored = spark.read.parquet(root).where(F.col("pickup_date") >= F.lit("1997-01-01").cast("date"))
    return stored.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("n_features"), F.count("geom").alias("n_points"), F.min("geom").alias("first_geom")
    )


def zone_files(spark, sf_dir):
    """Zones read from a file, joined to pickups."""
    root = scratch_dir(spark, "zones")
    zones(spark).withColumn("zone_id", F.col("zone_id").cast("bigint")).write.parquet(f"{root}/zones")
    joined = features.with_zones(trips(spark, sf_dir, "green", keys=True), read_zones(spark, f"{root}/zones"))
    return joined.select("o_orderkey", "pu_lon", "pu_lat")


def document_files(spark, sf_dir):
    """Trip documents written as lines of text and read back."""
    root = scratch_dir(spark, "documents")
    documents.to_documents(trips(spark, sf_dir, "green", costly=True), "green").write.text(f"{root}/docs")
    return read_documents(spark, f"{root}/docs", "green")


def sample_files(spark, sf_dir):
    """A sample of a file set, written as files: exact size, rows of the source, its columns."""
    root = scratch_dir(spark, "sample")
    trip_files(spark, sf_dir, "green").write.parquet(f"{root}/in")
    n = table(spark, sf_dir, "orders").count() // 3
    sampling.sample_parquet(spark, f"{root}/in", f"{root}/sample", n)
    source = spark.read.parquet(f"{root}/in")
    sample = spark.read.parquet(f"{root}/sample")
    strange = sample.exceptAll(source)
    counts = sample.agg(F.count(F.lit(1)).alias("rows"), F.lit("sampled").alias("what")).unionByName(
        strange.agg(F.count(F.lit(1)).alias("rows"), F.lit("strange").alias("what"))
    )
    return counts.withColumn("same_columns", F.lit(sample.schema == source.schema))


def row_counts(spark, sf_dir):
    return metrics.row_counts({name: table(spark, sf_dir, name) for name in TABLES})


def footer_counts(spark, sf_dir):
    return footers.table_rows(spark, sf_dir)


def doc_json_fields(spark, sf_dir):
    docs = documents.to_documents(
        trips(spark, sf_dir, "green", keys=True, costly=True), "green", include_derived=True, keep=("o_orderkey",)
    )
    paths = {
        "vendor": "$.VendorID",
        "pickup": "$.lpep_pickup_datetime",
        "total": "$.total_amount",
        "passengers": "$.passenger_count",
        "valid": "$.valid",
        "minutes": "$.tripDurationMinutes",
    }
    return docs.select("o_orderkey", *[F.get_json_object("doc", p).alias(n) for n, p in paths.items()])


def doc_read(spark, sf_dir):
    return documents.from_documents(documents.to_documents(trips(spark, sf_dir, "yellow", costly=True), "yellow"), "yellow")


def json_round_trip(spark, sf_dir):
    results = [
        documents.round_trip_mismatches(trips(spark, sf_dir, kind, costly=True), kind).select(F.lit(kind).alias("kind"), "*")
        for kind in ("yellow", "green")
    ]
    return results[0].unionByName(results[1])


def serialization_rate(spark, sf_dir):
    return documents.serialization_rate(trips(spark, sf_dir, "yellow", costly=True), "yellow")


def sample_exact(spark, sf_dir):
    keyed = trips(spark, sf_dir, "green", keys=True)
    return sampling.sample_exact(keyed, 500, KEYS["green"]).select("o_orderkey", "total_amount")


def sample_large(spark, sf_dir):
    """Half of all yellow trips."""
    keyed = trips(spark, sf_dir, "yellow", keys=True)
    n = table(spark, sf_dir, "lineitem").count() // 2
    return sampling.sample_exact(keyed, n, KEYS["yellow"]).select(*KEYS["yellow"], "total_amount")


def first_n(spark, sf_dir):
    keyed = trips(spark, sf_dir, "yellow", keys=True)
    return sampling.first_rows(keyed, 5, KEYS["yellow"]).select(*KEYS["yellow"], "fare_amount")


def kind_detect_lenient(spark, sf_dir):
    yellow, green = YELLOW.file_schema.names, GREEN.file_schema.names
    variants = [
        yellow,
        green,
        [c for c in yellow if c != YELLOW.dropoff],
        [c for c in green if c != "trip_type"],
        [*yellow, GREEN.pickup],
    ]
    columns = F
    for i, variant in enumerate(variants):
        columns = columns.when(F.col("p_partkey") % 6 == i, F.array(*[F.lit(c) for c in variant]))
    columns = columns.otherwise(F.array("p_name", "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", footers.kind_from_columns(columns).alias("kind"))


def kind_detect_strict(spark, sf_dir):
    yellow = footers.schema_fingerprint(YELLOW.file_schema)
    variant = F.col("p_partkey") % 5
    value = (
        F.when(variant == 0, F.lit(yellow))
        .when(variant == 1, F.lit(footers.schema_fingerprint(GREEN.file_schema)))
        .when(variant == 2, F.lit(yellow.replace("passenger_count:bigint", "passenger_count:double")))
        .when(variant == 3, F.concat(F.lit(yellow), F.lit(","), "p_name", F.lit(":string:true")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", footers.kind_from_fingerprint(value).alias("kind"))


def _messy_name():
    return F.concat("p_name", F.lit("@"), "p_brand", F.lit('."v"'), F.col("p_partkey"))


def table_name(spark, sf_dir):
    path = F.concat(F.lit("/data/in/"), _messy_name(), F.when(F.col("p_partkey") % 3 > 0, F.lit(".parquet")).otherwise(""))
    hidden = F.concat(F.lit("/data/."), "p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        names.derive_table_name(path).alias("table_name"),
        names.derive_table_name(hidden).alias("hidden_name"),
        names.quarantine_name(names.file_name(path), F.lit("schema_mismatch")).alias("quarantine_name"),
    )


def sanitize_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        names.sanitize_table_name(_messy_name()).alias("table_name"),
        names.sanitize_column_name(_messy_name()).alias("column_name"),
    )


def quote_identifiers(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", names.quote_identifier(_messy_name()).alias("quoted"))


def pending_query(spark, sf_dir):
    """Files named after parts, of which those named after successful events are done."""
    listing = table(spark, sf_dir, "part").select(
        F.concat(F.lit("/in/file_"), "p_partkey", F.lit(".parquet")).alias("path"),
        F.col("p_size").cast("bigint").alias("length"),
    )
    return pending_files(listing, ledger(spark, sf_dir).filter(F.col("status") == "processed"))


def ledger_totals(spark, sf_dir):
    return metrics.ledger_totals(ledger(spark, sf_dir))


def status_totals(spark, sf_dir):
    return metrics.status_totals(ledger(spark, sf_dir))


def ledger_rates(spark, sf_dir):
    return metrics.ledger_rates(ledger(spark, sf_dir))


def timer_stats(spark, sf_dir):
    return metrics.timer_stats(ledger(spark, sf_dir))


def hourly_trips(spark, sf_dir):
    return windowed_counts(trips(spark, sf_dir, "yellow"), YELLOW.pickup, "1 hour", by=("VendorID",))


def bulk_requests(spark, sf_dir):
    chunks = None
    for kind, spec in (("yellow", YELLOW), ("green", GREEN)):
        part = bulk_chunks(documents.to_documents(trips(spark, sf_dir, kind, costly=True), kind), spec.index)
        chunks = part if chunks is None else chunks.unionByName(part)
    lines = F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit("")))
    return chunks.groupBy("index").agg(
        F.sum("n_docs").alias("n_docs"),
        F.sum(lines.cast("bigint")).alias("n_lines"),
        F.count_if(F.col("n_docs") > 1000).alias("oversized"),
    )


def sink_totals(spark, sf_dir):
    results = table(spark, sf_dir, "events").selectExpr(
        "case when user_id % 2 = 0 then 'yellowtaxi' else 'greentaxi' end as index",
        "cast(event_id as string) as chunk_id",
        "cast(floor(value) as bigint) as n_docs",
        "event_type <> 'error' as ok",
    )
    return metrics.sink_totals(results)


def _kept(result: DataFrame, root: str) -> DataFrame:
    """The few rows of a report, checkpointed, so that the folder they came from can go."""
    ensure_checkpoint_dir(result.sparkSession)
    result = result.checkpoint()
    files.delete_tree(result.sparkSession, root)
    return result


def ingest_directory(spark, sf_dir):
    """Trip files of both kinds through the ingestion stream: ledger against loaded tables."""
    root = scratch_dir(spark, "ingest")
    for kind in ("yellow", "green"):
        # As the input is split, its first part can be without rows, of which Spark writes a file: one of unknown kind.
        trip_files(spark, sf_dir, kind).hint("rebalance").write.mode("append").parquet(f"{root}/in")
    tables = TripTables(f"{root}/tables", typed=False)
    cfg = IngestConfig(
        input_dir=f"{root}/in",
        processed_dir=f"{root}/processed",
        error_dir=f"{root}/error",
        ledger_dir=f"{root}/ledger",
        checkpoint_dir=f"{root}/checkpoint",
        sink=tables,
        mode="strict",
        max_files_per_trigger=1000,
    )
    recorded = metrics.status_totals(run_once(spark, cfg)).select("kind", "status", "records")
    loaded = None
    for kind in ("yellow", "green"):
        part = tables.read(spark, kind).agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("loaded"), F.sum("total_amount").alias("total_amount")
        )
        loaded = part if loaded is None else loaded.unionByName(part)
    return _kept(recorded.join(loaded, "kind", "full"), root)


def ingest_quarantine(spark, sf_dir):
    """A folder with good files and every kind of bad one: what is loaded, and why the others are not."""
    root = scratch_dir(spark, "quarantine")
    inbox = f"{root}/in"
    trip_files(spark, sf_dir, "green").coalesce(1).write.parquet(inbox)
    table(spark, sf_dir, "part").coalesce(1).write.mode("append").parquet(inbox)
    unreadable = table(spark, sf_dir, "region").select(F.concat(F.lit("no parquet "), "r_name").alias("value"))
    unreadable.coalesce(1).write.mode("append").text(inbox)
    files.write_bytes(spark, f"{inbox}/zero.parquet", b"")
    files.write_bytes(spark, f"{inbox}/torn.parquet", b"PAR1 and no footer")
    tables = TripTables(f"{root}/tables")
    cfg = IngestConfig(inbox, f"{root}/processed", f"{root}/error", f"{root}/ledger", f"{root}/checkpoint", tables)
    book = run_once(spark, cfg)
    moved = files.listing_frame(spark, f"{root}/error").select(names.file_name("path").alias("moved"))
    target = names.quarantine_name("file_name", "status")
    report = (
        book.join(moved, target == F.col("moved"), "left")
        .groupBy("kind", "status")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
            F.count("moved").alias("quarantined"),
            F.count("error").alias("explained"),
        )
    )
    return _kept(report, root)


def stream_valid_trips(spark, sf_dir):
    """Trip files through the continuous reader, the validity filter and a Parquet sink."""
    root = scratch_dir(spark, "stream")
    trip_files(spark, sf_dir, "green").write.parquet(f"{root}/in")
    valid = selection.keep_valid(stream_trips(spark, f"{root}/in", "green"), "green")
    query = (
        valid.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    query.awaitTermination()
    out = spark.read.schema(GREEN.trip_schema).parquet(f"{root}/out")
    report = out.groupBy("VendorID").agg(F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fare_amount"))
    return _kept(report, root)


def stream_hourly(spark, sf_dir):
    """Hourly trips by a stream with a 30-day watermark: the windows that it has closed."""
    root = scratch_dir(spark, "hourly")
    trip_files(spark, sf_dir, "yellow").write.parquet(f"{root}/in")
    counts = windowed_counts(stream_trips(spark, f"{root}/in", "yellow"), YELLOW.pickup, "1 hour", by=("VendorID",))
    query = (
        counts.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    query.awaitTermination()
    return _kept(spark.read.schema(counts.schema).parquet(f"{root}/out"), root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        vendor_fare_summary,
        read_yellow,
        read_green,
        coerce_types,
        datetime_parse,
        trip_duration,
        valid_yellow,
        valid_green,
        first_violation_yellow,
        first_violation_green,
        violation_report,
        valid_share,
        street_hail_valid,
        filter_by_attributes,
        filter_by_ranges,
        retention_30d,
        decode_vendor,
        decode_rate,
        decode_trip_type,
        decode_payment,
        decode_flag,
        decode_join,
        code_tostring,
        code_membership,
        fare_band,
        style_rules,
        style_else,
        marker_size,
        passenger_size,
        route_width,
        label_simple,
        label_full,
        zone_enrich,
        point_features,
        line_features,
        route_lines,
        route_line_parts,
        feature_table,
        feature_lines_yellow,
        attribute_stats,
        row_counts,
        footer_counts,
        doc_json_fields,
        doc_read,
        json_round_trip,
        serialization_rate,
        sample_exact,
        sample_large,
        first_n,
        kind_detect_lenient,
        kind_detect_strict,
        table_name,
        sanitize_names,
        quote_identifiers,
        ledger_totals,
        status_totals,
        ledger_rates,
        timer_stats,
        hourly_trips,
        sink_totals,
        ingest_directory,
        ingest_quarantine,
        stream_valid_trips,
        stream_hourly,
        narrowing_report,
        read_kinds,
        feature_files,
        zone_files,
        document_files,
        sample_files,
    )
}
QUERIES["pending_files"] = pending_query
QUERIES["bulk_chunks"] = bulk_requests
