"""Cases off the beaten path: late headers, long part numbers, odd dates and spaces, repeated headers, lost counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.functions.dates import parse_date_ladder
from gridloom.functions.text import clean_names, has_data, squish
from gridloom.operators import benchmark as bm
from gridloom.operators import crosswalk as cw
from gridloom.operators import grid as g
from gridloom.operators import overlap as ov
from gridloom.operators import report as rp
from gridloom.operators.common import CheckFailed
from gridloom.session import scratch_path
from gridloom.sources import readers, sinks

GRID = "source_file string, source_sheet string, row_number long, cells array<string>"


def test_a_header_below_the_usual_rows_is_profiled(spark):
    rows = [("f", "s", i, ["", "", ""]) for i in range(1, 150)] + [("f", "s", 150, ["Age", "Gender", "Citizenship"]), ("f", "s", 151, ["1", "M", "X"])]
    grid = spark.createDataFrame(rows, GRID)
    headers = g.header_rows(grid, ["age", "gender", "citizenship"], max_rows=200)
    assert [r.header_row for r in headers.collect()] == [150]
    assert [r.clean_column for r in g.column_inventory(grid, headers).orderBy("cell_position").collect()] == ["age", "gender", "citizenship"]


def test_repeated_headers_over_doubled_columns_are_dropped(spark):
    rows = [("f", "s", 1, ["Age", "Age", "Sex"]), ("f", "s", 2, ["1", "2", "M"]), ("f", "s", 3, ["Age", "Age", ""]), ("f", "s", 4, ["Age", "3", "F"])]
    grid = spark.createDataFrame(rows, GRID)
    inventory = g.column_inventory(grid, g.header_rows(grid, ["age", "sex"]), with_base_name=True)
    assert [r.clean_column for r in inventory.orderBy("cell_position").collect()] == ["age", "age_2", "sex"]
    layouts = g.sheet_layouts(inventory.withColumn("canonical_name", F.col("clean_column")), ["age"])
    assert sorted(r.row_number for r in g.repeat_header_drop(grid, layouts).collect()) == [2, 4]


def test_part_numbers_of_any_length(spark):
    metadata = spark.createDataFrame([("1000_a.parquet", "a", "s"), ("10001_b.parquet", "b", "s")], "part_file string, source_file string, source_sheet string")
    day = dt.date(2024, 1, 8)
    weekly = spark.createDataFrame([("a", "s", day, 1), ("b", "s", day, 2)], "source_file string, source_sheet string, week_start date, n long")
    latest = rp.latest_week_per_part(rp.weekly_with_part(weekly, metadata), "2024-01-01")
    assert sorted(r.part_number for r in latest.collect()) == ["1000", "10001"]
    ranges = metadata.withColumns({"min_date": F.lit(day), "max_date": F.lit(day), "n_rows": F.lit(1)})
    assert sorted(r.part_label for r in rp.coverage_timeline(ranges).collect()) == ["a", "b"]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-01-05 1/2", dt.date(2024, 1, 5)), ("2024-01-05 (see 3/4)", dt.date(2024, 1, 5)), ("1/5/2024 2024-02-02", dt.date(2024, 1, 5)),
        (" 45123", dt.date(2023, 7, 16)), ("45123 ", dt.date(2023, 7, 16)), (" ", None), ("12-2024", None),
    ],
)
def test_dates_are_read_by_their_beginning(spark, text, day):
    assert spark.createDataFrame([(text,)], "t string").select(parse_date_ladder(F.col("t")).alias("d")).first().d == day


def test_unicode_white_space_is_blank(spark):
    df = spark.createDataFrame([(" ",), ("  　",), ("a  b ",), (None,), ("​",)], "t string")
    assert [tuple(r) for r in df.select(has_data(F.col("t")), squish(F.col("t"))).collect()] == [(False, ""), (False, ""), (True, "a b"), (False, None), (True, "​")]


RELEASES = "benchmark_id string, release_date date, fiscal_year_text string, month_abbreviation string, component string, encounter_count long"


def test_benchmark_stops_on_unknown_months_and_counts_missing_as_none(spark):
    day = dt.date(2024, 1, 1)
    frame = lambda *rows: spark.createDataFrame([("r", day, "FY2024", m, "MAIN", n) for m, n in rows], RELEASES)
    with pytest.raises(CheckFailed, match="not recognised"):
        bm.benchmark_checked(frame(("Jan", 1), ("Smarch", 2)), "MAIN")
    with pytest.raises(CheckFailed, match="no benchmark release|No benchmark release"):
        bm.benchmark_checked(frame(("Jan", 1)), "OTHER")
    latest = bm.benchmark_latest(bm.fiscal_to_calendar(bm.benchmark_checked(frame(("Jan", None), ("Jan", None)), "MAIN")))
    ours = spark.createDataFrame([(dt.date(2024, 1, 1), 3)], "month_start date, final_count long")
    row = bm.cross_reference(latest, ours).first()
    assert (row.benchmark_count, row.status, row.percent_difference) == (0, bm.DIFFERENT, None)


def test_delimited_text_keeps_line_breaks_and_spaces(spark):
    rows = [(1, "a\nb", "next"), (2, "  padded ", "x"), (3, 'q "quoted", c', None), (4, "", "\r\n")]
    path = scratch_path(spark, "csv")
    schema = "i int, v string, w string"
    sinks.sink_csv(spark.createDataFrame(rows, schema), path)
    assert sorted(map(tuple, readers.read_csv(spark, path, schema).collect())) == rows


def test_parts_are_few_files_and_a_rebuild_removes_stale_ones(spark, tmp_path):
    path = str(tmp_path / "parts")
    many = spark.range(0, 4000, 1, 16).select(F.concat(F.lit("p"), F.col("id") % 7).alias("part_file"), "id")
    sinks.sink_parts(many, path)
    assert len(list((tmp_path / "parts").rglob("part-*.parquet"))) <= 14
    sinks.sink_parts(many.where("part_file = 'p1'"), path)
    assert spark.read.parquet(path).count() == 4000
    sinks.sink_parts(many.where("part_file = 'p1'"), path, replace_all=True)
    assert [r.part_file for r in spark.read.parquet(path).select("part_file").distinct().collect()] == ["p1"]


def test_ranges_to_the_end_of_the_calendar(spark):
    rows = [("a", dt.date(2020, 1, 1), dt.date(9999, 12, 31)), ("b", dt.date(2021, 5, 5), dt.date(9999, 12, 30)), ("c", dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    metadata = spark.createDataFrame(rows, "part_file string, min_date date, max_date date")
    blocks = metadata.select(F.size(ov.blocks_of_range(F.col("min_date"), F.col("max_date"))).alias("n"))
    assert max(r.n for r in blocks.collect()) <= 2 * ov.LEVELS
    pairs = ov.contained_pairs(metadata)
    assert sorted((r.smaller_file, r.larger_file) for r in pairs.collect()) == [("a", "c"), ("b", "a"), ("b", "c")]
    counts = spark.createDataFrame([("a", dt.date(2022, 1, 1), 2), ("b", dt.date(2022, 1, 1), 2), ("c", dt.date(2020, 2, 2), 1)], "part_file string, event_date date, daily_count long")
    summary = {(r.smaller_file, r.larger_file): r for r in ov.pair_summary(pairs, counts).collect()}
    assert summary["b", "a"].all_daily_counts_match and summary["b", "a"].days_compared == (rows[1][2] - rows[1][1]).days + 1
    assert summary["a", "c"].differing_days == 2 and summary["a", "c"].maximum_absolute_daily_difference == 2


def test_rules_with_quotes(spark):
    rules = cw.rules_frame(spark, {"o'clock": ("it's", "a\\b"), "plain": ()})
    assert sorted(map(tuple, rules.collect())) == [("a\\b", "o'clock"), ("it's", "o'clock")]
    assert cw.rules_frame(spark, {}).count() == 0


def test_names_as_two_passes_give_them(spark):
    texts = ["ABc aBCd ABCdEf", "a%b#c", "9lives", "", " _x_ ", "ÀÉ\"q'", "XMLHttpRequest2Go", "__", " Name (s) "]
    expected = ["a_bc_a_b_cd_ab_cd_ef", "a_percent_b_number_c", "x9lives", "x", "x", "a_eq", "xml_http_request2go", "x", "name_s"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", clean_names(F.col("t")).alias("n"))
    assert [r.n for r in rows.orderBy("i").collect()] == expected
