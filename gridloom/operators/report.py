"""Counts by source over months and weeks, and the coverage table behind a timeline chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.dates import month_start, week_start
from gridloom.operators.common import keep_first
from gridloom.operators.overlap import coverage_contained_flag


def event_date_of(columns: Sequence[str]) -> Column:
    """First present of typed date or timestamp columns, as a date."""
    return F.coalesce(*[F.col(c).cast("date") for c in columns])


def monthly_counts_by_source(events: DataFrame, event_date: Column, since: str = "2020-01-01", count: str = "n", stored_date: bool = True) -> DataFrame:
    """Rows per source file and month since a day; counted on the map side first.

    A date that is stored, or a cast of a stored one, is compared at the scan. One that rows are converted to first is
    not (``stored_date=False``): Spark would convert each row for the comparison and again for the month. Rows are then
    counted by day, and days left out as months are added up.
    """
    first = F.lit(since).cast("date")
    if stored_date:
        dated = events.where(event_date >= first)
        return dated.groupBy("source_file", month_start(event_date).alias("month_start")).agg(F.count("*").alias(count))
    days = events.groupBy("source_file", event_date.alias("_day")).agg(F.count("*").alias("_n"))
    kept = F.sum(F.when(F.col("_day") >= first, F.col("_n"))).alias(count)
    return days.groupBy("source_file", month_start(F.col("_day")).alias("month_start")).agg(kept).where(F.col(count).isNotNull())


def weekly_counts_by_source(events: DataFrame, event_date: Column, count: str = "n") -> DataFrame:
    """Rows per source file, sheet and week from Monday; undated rows left out."""
    return (
        events.where(event_date.isNotNull())
        .groupBy("source_file", "source_sheet", week_start(event_date).alias("week_start"))
        .agg(F.count("*").alias(count))
    )


def part_lookup(metadata: DataFrame, by_file: bool = False) -> DataFrame:
    """Part number, the digits before the first underscore of the part file, by file and sheet (or by file alone)."""
    keys = ["source_file"] if by_file else ["source_file", "source_sheet"]
    return metadata.select(*keys, F.regexp_extract("part_file", "^([0-9]+)_", 1).alias("part_number")).distinct()


def weekly_with_part(weekly: DataFrame, metadata: DataFrame, by_file: bool = False) -> DataFrame:
    """Weekly counts with their part number.

    ``by_file`` joins on the file alone, so a file of several sheets repeats each count once per sheet.
    """
    keys = ["source_file"] if by_file else ["source_file", "source_sheet"]
    return weekly.join(part_lookup(metadata, by_file), keys, "left").orderBy("part_number", "week_start", "source_file", "source_sheet")


def latest_week_per_part(weekly: DataFrame, since: str) -> DataFrame:
    """The last week of each part since a day, one row per part."""
    recent = weekly.where(F.col("week_start") >= F.lit(since).cast("date"))
    return keep_first(recent, ["part_number"], [F.desc("week_start"), "source_file", "source_sheet"])


def coverage_timeline(metadata: DataFrame) -> DataFrame:
    """Part label, range, rows and containment, latest start first."""
    label = F.regexp_replace(F.regexp_replace("part_file", r"\.parquet$", ""), r"^[0-9]+_", "")
    return (
        coverage_contained_flag(metadata)
        .select(label.alias("part_label"), "min_date", "max_date", "n_rows", "contained")
        .orderBy(F.desc("min_date"), "part_label")
    )
