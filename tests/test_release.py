"""Sheets to published table, and a second run that adds a file."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators.common import CheckFailed
from gridloom.plans import release
from gridloom.plans.profiles import APPREHENSIONS
from gridloom.session import scratch_path
from gridloom.sources import readers, sinks


def grid_of(spark, sheets):
    rows = [(f, s, i, cells) for (f, s), sheet in sheets.items() for i, cells in enumerate(sheet, 1)]
    return spark.createDataFrame(rows, "source_file string, source_sheet string, row_number long, cells array<string>")


FIRST = {
    ("Release Q1.xlsx", "FY24 Q1"): [
        ["Title"], ["APP_DT_TIME", "APP AGE", "Gender", "Citizenship", "LATITUDE"],
        ["45292.25", "34.0", "M", "X", "(b)(7)(E)"], ["APP_DT_TIME", "APP AGE", "GENDER", "", ""], ["45293", "x", "F", "Y", "31.5"],
    ],
    ("Release Q1.xlsx", "Notes"): [["nothing here"]],
}
SECOND = {("Another.xlsx", "S"): [["Apprehension Date", "Age", "Sector", "Citizenship"], ["2024-04-01", "20", "RGV", "Z"]]}


def test_release_from_grid_to_typed_table(spark):
    parts, stacked, final = (scratch_path(spark, n) for n in ("parts", "stacked", "final"))
    failed = scratch_path(spark, "failed")
    ledger = release.build_parts(grid_of(spark, FIRST), APPREHENSIONS, parts, failed_path=failed)
    assert [r.source_sheet for r in spark.read.parquet(failed).collect()] == ["Notes"]
    assert [r.part_file for r in ledger.collect()] == ["0001_release_q1_fy24_q1"]
    more = release.build_parts(grid_of(spark, {**FIRST, **SECOND}), APPREHENSIONS, parts, ledger)
    assert [r.part_file for r in more.collect()] == ["0002_another_s"]

    with pytest.raises(CheckFailed, match="profiled"):
        release.build_parts(grid_of(spark, FIRST), APPREHENSIONS, parts, ledger)
    known = {k: v for k, v in FIRST.items() if k[1] != "Notes"}
    assert release.build_parts(grid_of(spark, known), APPREHENSIONS, parts, ledger).isEmpty()

    rows = release.stack_parts(grid_of(spark, FIRST), parts, stacked, APPREHENSIONS)
    assert rows.count() == 3
    typed = release.finish(rows, APPREHENSIONS, final)
    kinds = dict(typed.dtypes)
    assert (kinds["apprehension_datetime"], kinds["apprehension_date"], kinds["age"]) == ("timestamp_ntz", "date", "int")
    first = typed.where("gender = 'M'").first()
    assert (str(first.apprehension_datetime), first.age, first.latitude, first.latitude_redacted) == ("2024-01-01 06:00:00", 34, None, True)
    assert typed.where("part_file = '0002_another_s'").first().arrest_sector == "RGV"
    assert typed.columns.index("apprehension_datetime") < typed.columns.index("citizenship") < typed.columns.index("source_file")


def test_conflicting_columns_stop_the_release(spark):
    grid = grid_of(spark, {("a.xlsx", "s"): [["Age", "APP AGE", "Gender", "Citizenship"], ["1", "2", "M", "X"]]})
    with pytest.raises(CheckFailed, match="canonical"):
        release.build_parts(grid, APPREHENSIONS, scratch_path(spark, "conflict"))


def test_nothing_profiled_stops_the_release(spark):
    with pytest.raises(CheckFailed):
        release.build_parts(grid_of(spark, {("a.xlsx", "s"): [["x"]]}), APPREHENSIONS, scratch_path(spark, "none"))


def test_rebuilding_a_part_replaces_it_alone(spark):
    path = scratch_path(spark, "replace")
    part = lambda name, n: spark.range(n).select(F.lit(name).alias("part_file"), F.col("id").cast("string").alias("v"))
    sinks.sink_parts(part("p1", 3).unionAll(part("p2", 2)), path)
    sinks.sink_parts(part("p1", 5), path)
    counts = readers.scan_parts_union_by_name(spark, path).groupBy("part_file").count()
    assert sorted(tuple(r) for r in counts.collect()) == [("p1", 5), ("p2", 2)]


def test_release_without_a_required_column_is_refused(spark):
    path = scratch_path(spark, "csv")
    sinks.sink_csv(spark.createDataFrame([("2020", 1)], "`Fiscal Year` string, n int"), path)
    with pytest.raises(CheckFailed, match="Component"):
        readers.csv_scan_typed(spark, [("r", "2024-01-01", path)], {"Fiscal Year": "fy", "Component": "component"})


@pytest.mark.parametrize("missing", ["", "NA"])
def test_csv_round_trip_keeps_missing_apart_from_empty(spark, missing):
    path = scratch_path(spark, "nulls")
    rows = {1: None, 2: "", 3: "x", 4: 'say "a, b"', 5: "\\N", 6: "back\\"}
    sinks.sink_csv(spark.createDataFrame(list(rows.items()), "i int, v string"), path, missing)
    back = readers.read_csv(spark, path, "i int, v string", missing)
    assert dict(tuple(r) for r in back.collect()) == rows
