"""All steps of a release, twice; and the checks between them."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.operators.common import CheckFailed
from gridloom.plans import validation
from gridloom.plans.profiles import APPREHENSIONS
from gridloom.session import scratch_path
from gridloom.sources import published, sinks
from test_release import grid_of

HEADER = ["Apprehension Date", "Age", "Gender", "Citizenship"]
BENCHMARKED = dataclasses.replace(APPREHENSIONS, benchmark_component="MAIN", reporting_start="2024-01-01")


def rows(*days):
    return [HEADER, *([d, "20", "F", "X"] for d in days)]


SHEETS = {("A.xlsx", "all"): rows("2024-01-01", "2024-01-01", "45294", "2024-02-20", "2023-12-31"), ("B.xlsx", "jan"): rows("2024-01-01", "2024-01-03")}
MORE = {("C.xlsx", "feb"): rows("2024-02-01", "2024-02-05")}


def test_a_release_and_the_next(spark):
    root = scratch_path(spark, "release")
    benchmark = spark.createDataFrame(
        [("r1", dt.date(2024, 3, 1), "FY2024", m, "MAIN", n) for m, n in (("Dec", 1), ("Jan", 5), ("Feb", 9))],
        "benchmark_id string, release_date date, fiscal_year_text string, month_abbreviation string, component string, encounter_count long",
    )
    done = validation.run_release(grid_of(spark, SHEETS), BENCHMARKED, root, benchmark)
    assert {(r.part_file, r.n_rows, str(r.min_date), str(r.max_date)) for r in done.metadata.collect()} == {
        ("0001_a_all", 5, "2023-12-31", "2024-02-20"), ("0002_b_jan", 2, "2024-01-01", "2024-01-03")}
    summary = done.overlaps.summary.first()
    assert (summary.smaller_file, summary.larger_file, summary.days_compared, summary.differing_days) == ("0002_b_jan", "0001_a_all", 3, 1)
    assert done.overlaps.daily.count() == 3
    assert {(str(r.month_start), r.final_count, r.status) for r in done.cross_reference.collect()} == {
        ("2023-12-01", 1, "exact match"), ("2024-01-01", 5, "exact match"), ("2024-02-01", 1, "difference")}
    assert {(r.source_file, str(r.month_start), r.n) for r in done.reports.monthly.collect()} == {("A.xlsx", "2024-01-01", 3), ("A.xlsx", "2024-02-01", 1), ("B.xlsx", "2024-01-01", 2)}
    assert {(r.part_number, str(r.week_start)) for r in done.reports.latest_weeks.collect()} == {("0001", "2024-02-19"), ("0002", "2024-01-01")}
    order = published.read_published(spark, f"{root}/column_order")
    assert order.where("state = 'missing' AND column = 'arrest_date'").count() == 1 and order.where("state = 'extra'").count() > 0

    again = validation.run_release(grid_of(spark, {**SHEETS, **MORE}), BENCHMARKED, root)
    assert again.final.count() == 9 and again.cross_reference is None
    assert {r.part_file for r in again.metadata.collect()} == {"0001_a_all", "0002_b_jan", "0003_c_feb"}
    assert again.overlaps.pairs.count() == 2 and published.current(spark, f"{root}/parts").version == 2
    assert published.read_published(spark, f"{root}/final", version=1).count() == 7  # the version before can still be read


def test_parts_of_two_sources_stop_the_release(spark):
    path = scratch_path(spark, "mixed")
    mixed = spark.createDataFrame([("p", "a.xlsx", "s", "1"), ("p", "b.xlsx", "s", "2")], "part_file string, source_file string, source_sheet string, age string")
    sinks.sink_parquet(mixed, path, ["part_file"])
    with pytest.raises(CheckFailed, match="more than one source"):
        validation.describe_parts(spark, path, APPREHENSIONS, scratch_path(spark, "metadata"))


def test_a_table_without_dates_and_a_kind_without_benchmark_are_told(spark):
    with pytest.raises(CheckFailed, match="apprehension_date"):
        validation.event_date(spark.range(1).withColumn("age", F.lit(1)), APPREHENSIONS.monthly_date_columns)
    with pytest.raises(CheckFailed, match="component"):
        validation.cross_reference(spark.range(1), spark.range(1), APPREHENSIONS, "")
