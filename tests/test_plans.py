"""Shapes of the registered plans: where rows are shuffled and where Python runs."""

import pytest

import __spark_entry__ as entry_points
from tripflow.plans.catalog import QUERIES
from conftest import SF, plan_of

AGGREGATES = {
    "vendor_fare_summary", "violation_report", "valid_share", "decode_vendor", "decode_rate", "decode_trip_type",
    "decode_payment", "decode_flag", "fare_band", "route_lines", "route_line_parts", "attribute_stats", "row_counts",
    "json_round_trip", "serialization_rate", "ledger_totals", "status_totals", "ledger_rates", "timer_stats",
    "hourly_trips", "sink_totals", "bulk_chunks", "ingest_directory", "stream_valid_trips", "narrowing_report",
    "ingest_quarantine", "stream_hourly", "feature_files", "read_kinds", "sample_files",
}
# Redistribution of a scan of few row groups.
SPREAD = {"doc_json_fields", "doc_read", "json_round_trip", "serialization_rate", "bulk_chunks"}
BROADCAST = {"zone_enrich", "point_features", "line_features", "feature_table", "feature_lines_yellow", "route_lines"}
BROADCAST |= {"route_line_parts", "decode_join", "pending_files", "zone_files"}
# Points of a route are ranked; minima of texts and differences of row sets are sorted.
SORTED = {"route_lines", "route_line_parts", "feature_files", "sample_files"}
PYTHON = {"bulk_chunks", "footer_counts"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ("MapInArrow" in plan or "MapInPandas" in plan) == (name in PYTHON)
    shuffles = plan.count("Exchange hashpartitioning") + plan.count("Exchange RoundRobin") + plan.count("Exchange Single")
    assert shuffles == 0 or name in AGGREGATES | SPREAD
    assert "BroadcastExchange" not in plan or name in BROADCAST
    assert "Sort [" not in plan or name in SORTED


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entry_points.queries()["decode_rate"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint>" in plan
    plan = plan_of(entry_points.queries()["fare_band"](spark, SF))
    assert "l_shipdate" not in plan.split("ReadSchema:")[1]
