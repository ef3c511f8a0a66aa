"""Monthly counts against an external benchmark that is itself published in overlapping releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridloom.functions.convert import to_integer
from gridloom.functions.dates import calendar_year, fiscal_year, month_start
from gridloom.functions.text import parse_number
from gridloom.operators.common import CheckFailed, keep_first, materialise, require_empty

# Month abbreviations in calendar order, and the outcomes of a monthly comparison.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
MISSING_FROM_FINAL = "missing from final"
MISSING_FROM_BENCHMARK = "missing from benchmark"
EXACT = "exact match"
DIFFERENT = "difference"


def month_number(abbreviation: Column) -> Column:
    """1 to 12 for a month abbreviation in any case, NULL for anything else."""
    place = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.upper(abbreviation))
    return F.nullif(place, F.lit(0)).cast("int")


def benchmark_union(releases: DataFrame, component: str) -> DataFrame:
    """One component of all releases with its fiscal year and month as numbers.

    ``releases`` holds ``benchmark_id, release_date, fiscal_year_text, month_abbreviation, component,
    encounter_count``; months not recognised stay NULL for :func:`benchmark_invalid_months`.
    """
    return releases.where(F.col("component") == component).select(
        "benchmark_id",
        "release_date",
        to_integer(parse_number(F.col("fiscal_year_text")).cast("string")).alias("fiscal_year"),
        month_number(F.col("month_abbreviation")).alias("fiscal_month"),
        "month_abbreviation",
        "encounter_count",
    )


def benchmark_checked(releases: DataFrame, component: str) -> DataFrame:
    """:func:`benchmark_union`; raises on a month that is not known, and if no release has the component.

    The rows of one component are stored, a few for each month, and both checks are observed on the way: ``releases``
    is evaluated once.
    """
    seen = Observation()
    rows = benchmark_union(releases, component)
    rows = materialise(rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("fiscal_month").isNull()).alias("unknown")), "benchmark-rows")
    found = seen.get
    if found["unknown"]:
        require_empty(benchmark_invalid_months(rows), "Benchmark months are not recognised.")
    if not found["rows"]:
        raise CheckFailed(f"No benchmark release has the component {component}.")
    return rows


def benchmark_invalid_months(rows: DataFrame) -> DataFrame:
    """Rows whose month abbreviation is unknown; must be empty."""
    return rows.where(F.col("fiscal_month").isNull())


def fiscal_to_calendar(rows: DataFrame) -> DataFrame:
    """Adds ``calendar_year`` and ``month_start``: October to December lie in the calendar year before."""
    year = calendar_year(F.col("fiscal_year"), F.col("fiscal_month"))
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.col("fiscal_month").cast("string"), F.lit("1"))
    known = F.col("fiscal_year").isNotNull() & F.col("fiscal_month").isNotNull()
    return rows.withColumn("calendar_year", year).withColumn("month_start", F.when(known, text.try_cast("date")))


def benchmark_latest(rows: DataFrame) -> DataFrame:
    """Monthly totals per release, 0 where all counts are missing, then per month the total of the newest release.

    Only release-by-month totals meet the window, so its groups are as small as the number of releases.
    """
    totals = rows.groupBy("benchmark_id", "release_date", "fiscal_year", "fiscal_month", "month_start").agg(
        F.coalesce(F.sum("encounter_count"), F.lit(0)).alias("benchmark_count")
    )
    return keep_first(totals, ["month_start"], [F.desc("release_date"), F.desc("benchmark_id")])


def monthly_in_range(events: DataFrame, event_date: Column, benchmark: DataFrame) -> DataFrame:
    """Rows per month, within the months the benchmark spans.

    The two bounds are scalar subqueries: they run first and the range reaches the scan as a filter.
    """
    first = benchmark.agg(F.min("month_start").alias("d")).scalar()
    last = benchmark.agg(F.last_day(F.max("month_start")).alias("d")).scalar()
    return (
        events.where(event_date.between(first, last))
        .groupBy(month_start(event_date).alias("month_start"))
        .agg(F.count("*").alias("final_count"))
    )


def cross_reference(benchmark: DataFrame, monthly: DataFrame) -> DataFrame:
    """Both monthly series side by side with their difference and a verdict. Months are the only rows here."""
    ours, theirs = F.col("final_count"), F.col("benchmark_count")
    month = F.col("month_start")
    difference = ours - theirs
    status = (
        F.when(ours.isNull(), F.lit(MISSING_FROM_FINAL))
        .when(theirs.isNull(), F.lit(MISSING_FROM_BENCHMARK))
        .when(difference == 0, F.lit(EXACT))
        .otherwise(F.lit(DIFFERENT))
    )
    return benchmark.join(monthly, "month_start", "full_outer").select(
        F.coalesce("fiscal_year", fiscal_year(month)).alias("fiscal_year"),
        F.coalesce("fiscal_month", F.month(month)).alias("fiscal_month"),
        "month_start",
        "final_count",
        "benchmark_count",
        difference.alias("difference"),
        F.abs(difference).alias("absolute_difference"),
        F.when(theirs != 0, F.lit(100.0) * difference / theirs).alias("percent_difference"),
        (difference == 0).alias("exact_match"),
        status.alias("status"),
    )


def cross_reference_summary(comparison: DataFrame) -> DataFrame:
    status = F.col("status")
    return comparison.agg(
        F.count("*").alias("months_compared"),
        F.count_if(F.col("exact_match")).alias("exact_matches"),
        F.count_if(status == DIFFERENT).alias("differing_months"),
        F.count_if(status.isin(MISSING_FROM_FINAL, MISSING_FROM_BENCHMARK)).alias("missing_months"),
        F.max("absolute_difference").alias("largest_absolute_difference"),
    )
