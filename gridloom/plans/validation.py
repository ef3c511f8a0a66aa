"""What follows a published release: metadata of its parts, overlaps, the external benchmark, reports; and all steps in order.

Every step publishes its tables under one root, so that each can be read, and run again, by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from gridloom.operators import benchmark as bm
from gridloom.operators import overlap as ov
from gridloom.operators import parts as pt
from gridloom.operators import report as rp
from gridloom.operators.common import CheckFailed, materialise, require_empty
from gridloom.operators.typed import column_order_report
from gridloom.plans import release
from gridloom.plans.spec import DatasetProfile
from gridloom.sources.published import current, read_published
from gridloom.sources.sinks import sink_parquet


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` published at ``path`` and read back."""
    sink_parquet(df, path)
    return read_published(df.sparkSession, path)


def event_date(final: DataFrame, columns: Sequence[str]) -> Column:
    """The first of ``columns`` that a row has, of those that the table has at all."""
    known = [c for c in columns if c in final.columns]
    if not known:
        raise CheckFailed(f"The table has none of the date columns {', '.join(columns)}.")
    return rp.event_date_of(known)


def describe_parts(spark: SparkSession, parts_path: str, profile: DatasetProfile, path: str) -> DataFrame:
    """Rows, date range and populated columns of each published part, published in turn. Raises if a part mixes sources."""
    parts = read_published(spark, parts_path)
    require_empty(pt.part_single_source(parts), "Parts contain more than one source file or sheet.")
    return stored(pt.part_summary(parts, profile.part_date_columns), path)


@dataclass(frozen=True)
class Overlaps:
    pairs: DataFrame
    daily: DataFrame
    summary: DataFrame


def validate_overlaps(final: DataFrame, metadata: DataFrame, profile: DatasetProfile, root: str) -> Overlaps:
    """Parts within other parts, their daily counts as runs of days, and how far these agree."""
    pairs = stored(ov.contained_pairs(metadata), f"{root}/contained_pairs")
    counts = materialise(ov.daily_counts(final, event_date(final, profile.monthly_date_columns), pairs), "daily-counts")
    daily = stored(ov.daily_intervals(pairs, counts), f"{root}/daily_intervals")
    return Overlaps(pairs, daily, stored(ov.pair_summary(pairs, counts), f"{root}/pair_summary"))


def cross_reference(final: DataFrame, releases: DataFrame, profile: DatasetProfile, root: str) -> DataFrame:
    """Monthly counts against the newest benchmark of each month, and their summary."""
    if profile.benchmark_component is None:
        raise CheckFailed(f"No benchmark component is known for {profile.kind}.")
    dated = bm.fiscal_to_calendar(bm.benchmark_checked(releases, profile.benchmark_component))
    latest = materialise(bm.benchmark_latest(dated), "benchmark")
    monthly = bm.monthly_in_range(final, event_date(final, profile.monthly_date_columns), latest)
    found = stored(bm.cross_reference(latest, monthly), f"{root}/cross_reference")
    sink_parquet(bm.cross_reference_summary(found), f"{root}/cross_reference_summary")
    return found


@dataclass(frozen=True)
class Reports:
    monthly: DataFrame
    weekly: DataFrame
    latest_weeks: DataFrame
    timeline: DataFrame


def report(final: DataFrame, metadata: DataFrame, profile: DatasetProfile, root: str) -> Reports:
    """Counts by month and by week and part, the last week of each part, and the coverage of all parts."""
    monthly = rp.monthly_counts_by_source(final, event_date(final, profile.monthly_date_columns), profile.reporting_start)
    weeks = rp.weekly_counts_by_source(final, event_date(final, profile.weekly_date_columns))
    weekly = stored(rp.weekly_with_part(weeks, metadata), f"{root}/weekly")
    return Reports(
        stored(monthly, f"{root}/monthly"), weekly,
        stored(rp.latest_week_per_part(weekly, profile.reporting_start), f"{root}/latest_weeks"),
        stored(rp.coverage_timeline(metadata), f"{root}/timeline"),
    )


@dataclass(frozen=True)
class Release:
    final: DataFrame
    metadata: DataFrame
    overlaps: Overlaps
    reports: Reports
    cross_reference: DataFrame | None


def run_release(grid: DataFrame, profile: DatasetProfile, root: str, benchmark: DataFrame | None = None, rebuild: bool = False, **header_options) -> Release:
    """All steps from sheets to reports under ``root``. Sheets that are parts already are not built again, but with ``rebuild``.

    What the wanted column order lacks and what it does not name is published as ``column_order``.
    """
    spark, parts = grid.sparkSession, f"{root}/parts"
    known = None if rebuild or current(spark, parts) is None else release.committed_ledger(spark, parts)
    release.build_parts(grid, profile, parts, known, f"{root}/failed", **header_options)
    metadata = describe_parts(spark, parts, profile, f"{root}/parts_metadata")
    stacked = release.stack_parts(grid, parts, f"{root}/stacked", profile)
    sink_parquet(column_order_report(stacked, profile.table.order), f"{root}/column_order")
    final = release.finish(stacked, profile, f"{root}/final")
    overlaps, reports = validate_overlaps(final, metadata, profile, root), report(final, metadata, profile, root)
    return Release(final, metadata, overlaps, reports, None if benchmark is None else cross_reference(final, benchmark, profile, root))
