"""Shape of the physical plans: no Python in the rows' way, no all-pairs joins, filters at the scan."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gridloom.catalog.queries import REGISTERED
from gridloom.catalog import inputs
from gridloom.operators import compare as cmp
from gridloom.operators import grid as g
from gridloom.operators import parts as pt
from gridloom.operators import report as rp
from gridloom.operators.common import materialise
from gridloom.plans.profiles import APPREHENSIONS
from gridloom.session import scratch_path
from gridloom.sources.sinks import sink_parts

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_plan_has_no_forbidden_operator(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.fixture(scope="module")
def stored_grid(spark, sf_dir):
    return materialise(inputs.grid(spark, sf_dir), "test-grid")


def test_header_search_reads_the_top_rows_only(stored_grid):
    text = plan(g.header_rows(stored_grid, APPREHENSIONS.header_terms))
    assert "LessThanOrEqual(row_number,100)" in text


def test_sheet_inventory_reads_two_columns(stored_grid):
    assert "ReadSchema: struct<source_file:string,source_sheet:string>" in plan(g.grid_sheet_inventory(stored_grid))


def test_rows_are_standardised_without_a_shuffle(spark, stored_grid):
    inventory = g.column_inventory(stored_grid, g.header_rows(stored_grid, APPREHENSIONS.header_terms))
    canonical = inventory.withColumn("canonical_name", F.col("clean_column"))
    layouts = materialise(g.sheet_layouts(canonical, ["age"]), "test-layouts")
    text = plan(g.standardize_part(stored_grid, layouts, ["age"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        big = g.standardize_part(stored_grid, layouts, ["age"])
        assert "SortMergeJoin" in plan(big) or "ShuffledHashJoin" in plan(big)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_excluded_parts_are_pruned(spark, sf_dir):
    path = scratch_path(spark, "exclude")
    sink_parts(inputs.parts(spark, sf_dir), path)
    text = plan(pt.parts_exclude(spark.read.parquet(path), ["0004_part_1995.xlsx"]))
    assert "NOT (part_file" in text.split("PartitionFilters")[1]


def test_stack_audit_reads_no_column(spark, sf_dir):
    path = scratch_path(spark, "audit")
    sink_parts(inputs.parts(spark, sf_dir), path)
    assert "ReadSchema: struct<>" in plan(pt.stack_audit(spark.read.parquet(path)))


def test_pair_comparison_shuffles_once(spark, sf_dir):
    a, b = inputs.pair(spark, sf_dir)
    text = plan(cmp.pair_match_summary(a, b, ["source_file", "date_text", "int_text"]))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_monthly_counts_push_the_day_to_the_scan(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").withColumn("source_file", F.col("o_orderstatus"))
    text = plan(rp.monthly_counts_by_source(orders, F.col("o_orderdate").cast("date")))
    assert "GreaterThanOrEqual(o_orderdate,2020-01-01T00:00)" in text.split("PushedFilters")[1]
    assert "o_custkey" not in text


def test_range_bounds_are_scalar_subqueries(spark, sf_dir):
    text = plan(entry.queries()["monthly_in_range"](spark, sf_dir))
    assert "Subquery" in text


@pytest.mark.parametrize("name", ["part_summary", "part_single_source", "non_empty_columns", "daily_counts", "audit_all"])
def test_row_level_aggregation_does_not_sort(spark, sf_dir, name):
    assert "SortAggregate" not in plan(entry.queries()[name](spark, sf_dir))


def test_converted_dates_are_converted_once(spark, sf_dir):
    text = entry.queries()["release_monthly_counts"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in text.splitlines() if line.strip(" :+-").startswith("Filter") and len(line) > 2000]


def test_numbering_of_lists_sorts_keys_alone(spark, sf_dir):
    text = entry.queries()["collapse_multivalue"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in text and "Sort" not in text
