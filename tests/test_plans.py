"""Physical plans of the registered queries keep to the rules for large data."""

import re

import pytest

import __spark_entry__ as entry
from gate import query_checks, query_loads, query_reads, query_store

FOLDER = "/root/testdata/sf0.001"
# These write files and run whole loads when built.
RUN_JOBS = {
    "stage_csv", "list_files", "load_files", "load_files_gold", "validate_only", "bulk_load", "bulk_load_again",
    "retry_failed", "stream_load", "stream_load_two_files", "read_exchange_lists", "update_exchanges", "update_exchanges_after",
    "backup_exchanges", "symbol_list", "load_errors", "intraday_range", "refresh_gold", "refresh_all",
    "coverage_by_loads", "prices_looked_up", "compacted_prices", "stage_csv_quotes", "load_with_unreadable_file", "stream_load_one_by_one", "load_quality_log",
}
WAREHOUSE = {n: q for g in (query_reads, query_checks, query_loads, query_store) for n, q in g.QUERIES.items()}
LAZY = sorted(set(WAREHOUSE) - RUN_JOBS)
# A window over the at most 1024 chunk sizes of an id range, or one row per partition.
CHUNK_SIZES = {
    "number_rows", "assigned_ids", "upsert_assets", "upsert_assets_in_order", "make_batches", "detect_outliers_overall",
}


@pytest.fixture(scope="module")
def plans(spark):
    return {n: WAREHOUSE[n](spark, FOLDER)._jdf.queryExecution().executedPlan().toString() for n in LAZY}


def test_no_python_in_any_plan(plans):
    assert not [n for n, p in plans.items() if re.search(r"Python|InPandas|MapInArrow", p)]


def test_no_cross_joins(plans):
    assert not [n for n, p in plans.items() if re.search(r"CartesianProduct|BroadcastNestedLoopJoin", p)]


def fact_scans(plan, table):
    """Scans of a table in the plan as first made; adaptive execution only drops some."""
    return len(re.findall(rf"Scan parquet [^\n]*/{table}\.parquet", plan.split("== Initial Plan ==")[-1]))


def test_facts_are_read_no_more_than_needed(plans):
    assert fact_scans(plans["daily_returns_history"], "lineitem") == fact_scans(plans["build_gold_history"], "lineitem") == 3
    assert fact_scans(plans["latest_prices_history"], "lineitem") == 3
    assert fact_scans(plans["detect_outliers_overall"], "orders") == 1
    assert fact_scans(plans["detect_outliers"], "events") == fact_scans(plans["build_gold"], "events")


def test_no_window_gathers_everything_in_one_task(plans):
    pattern = re.compile(r"Window \[.*\n[^\n]*(?:Sort[^\n]*\n[^\n]*)?Exchange SinglePartition")
    assert {n for n, p in plans.items() if pattern.search(p)} <= CHUNK_SIZES


def test_gold_keeps_the_best_row_before_the_shuffle(plans):
    for name in ("build_gold", "build_gold_history", "upsert_prices"):
        assert "row_number(), 1, Partial" in plans[name]


def test_point_queries_push_their_filter_and_prune_columns(spark, tmp_path):
    from pricehouse.fixtures import Warehouse
    from pricehouse.plans.marts import recent_price_changes
    from pricehouse.plans.queries import latest_prices, prices
    from pricehouse.plans.store import publish, read_published

    path = str(tmp_path / "gold")
    publish(spark, path, query_reads.gold_of(Warehouse(spark, FOLDER)))
    gold = read_published(spark, path)
    plan = prices(gold, ["U000000001"], "2024-01-05", "2024-01-06")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*price_date[^\]]*symbol", plan)
    assert re.search(r"PartitionFilters: \[[^\]]*price_year[^\]]*2024", plan)
    plan = recent_price_changes(gold, "2024-01-20", 5)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*price_year[^\]]*2024", plan)
    plan = latest_prices(gold)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "open_price" not in plan


def test_every_query_has_an_oracle_and_a_unique_name():
    groups = [query_reads.QUERIES, query_checks.QUERIES, query_loads.QUERIES, query_store.QUERIES]
    assert len(WAREHOUSE) == sum(len(g) for g in groups)
    assert set(WAREHOUSE) <= set(entry.queries()) and set(WAREHOUSE) <= set(entry.oracle_sql())
