"""Plan checks for every registered relational query: what the planner chose
must be what we want at scale, not just give the right rows."""

import re

import pytest

from aerolens.plans import catalog
from conftest import SF_SMALL

FITTED = {"feature_vectors", "vector_summary", "model_comparison", "perceptron_scores"}
# Files are written and headers read, or a sorted frame is written for its positions.
WRITTEN = {"flights_from_files", "stored_table", "flights_in_order"}
RELATIONAL = sorted(set(catalog.queries()) - FITTED - WRITTEN)
LINEITEM_COLUMNS = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"}

# Queries whose plan may gather rows into one partition, and why that is bounded.
SINGLE_PARTITION_OK = {
    "parts_of_day_share": "share window over the four aggregated day parts",
}


def plan_text(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_plan_shape(spark, name):
    plan = plan_text(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    for python in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert python not in plan, f"{name}: Python in the hot path ({python})"
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # A global aggregate gathers one partial row per task: bounded.
            partial_below = "partial_" in lines[i + 1]
            assert partial_below or name in SINGLE_PARTITION_OK, (
                f"{name}: single-partition exchange over unaggregated rows"
            )
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans, f"{name}: no parquet scan found"
    for scan in scans:
        cols = {c.split("#")[0] for c in scan.split(",")}
        if cols & LINEITEM_COLUMNS:
            assert cols <= LINEITEM_COLUMNS, f"{name}: lineitem scan reads {cols}"


@pytest.mark.parametrize("name", [n for n in RELATIONAL if n not in {
    "null_percentages", "null_percentages_per_year", "flights_shape", "drop_trailing_columns",
    "drop_named_columns", "union_by_name_years", "located_by_shuffle"}])
def test_lookup_joins_are_broadcast(spark, name):
    plan = plan_text(spark, name)
    if "LeftOuter" in plan:
        assert "SortMergeJoin" not in plan.split("LeftOuter")[0].splitlines()[-1]
        assert "BroadcastHashJoin" in plan


def test_aggregates_are_partial_before_the_shuffle(spark):
    plan = plan_text(spark, "top_states_per_year")
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")  # partial is below
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name, scans", [
    ("top_states_per_year", 1),
    ("delay_box_summary", 1),     # histogram shuffle reused by every branch
    ("outlier_histogram", 1),
    ("delay_outliers", 1),        # the outlier rows come from the histogram too
    ("report_aggregates", 1),     # all reports' measures from one scan
])
def test_lineitem_scans_after_exchange_reuse(spark, name, scans):
    df = catalog.queries()[name](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", final)) == scans


@pytest.mark.parametrize("name, shuffles", [
    ("enriched_flights", 0),        # broadcast lookups, no shuffle of flights
    ("top_origins", 1),             # partial -> final aggregate
    ("top_states_per_year", 2),     # aggregate, then the (aggregated) window
    ("report_aggregates", 1),       # every report's measures, one shuffle
    ("stratified_split_counts", 1),  # the split is a filter on a hash
])
def test_hash_shuffles_after_planning(spark, name, shuffles):
    df = catalog.queries()[name](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The lookup's own aggregate over the customers is counted apart.
    lookup = len(re.findall(r"Exchange hashpartitioning\(_?groupingexpression|Exchange hashpartitioning\(key", final))
    assert final.count("Exchange hashpartitioning") - lookup == shuffles


@pytest.mark.parametrize("name", RELATIONAL)
def test_building_a_query_runs_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    group = f"building-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        catalog.queries()[name](spark, SF_SMALL)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name, order", [
    ("flights_per_month", ["Year", "Month"]),
    ("top_destination_states_per_year", ["Year", "-Number", "DestinationState"]),
    ("top_states_per_year", ["Year", "-Number", "DestinationState"]),
    ("top_origins", ["-Number", "ORIGIN"]),
])
def test_reports_come_sorted(spark, name, order):
    """The presentation order of a report."""
    got = [r.asDict() for r in catalog.queries()[name](spark, SF_SMALL).collect()]
    key = [tuple((-r[c[1:]] if c[0] == "-" else (r[c] is not None, r[c])) for c in order) for r in got]
    assert len(key) > 1 and key == sorted(key)
