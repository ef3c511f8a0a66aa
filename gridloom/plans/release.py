"""From grids to a typed table: the operators in the order a release goes through them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import crosswalk as cw
from gridloom.operators import grid as g
from gridloom.operators import parts as p
from gridloom.operators.common import CheckFailed, materialise, require_empty
from gridloom.operators.typed import typed_table
from gridloom.plans.spec import DatasetProfile
from gridloom.session import scratch_path
from gridloom.sources import published
from gridloom.sources.footers import footer_counts
from gridloom.sources.sinks import sink_parquet


@dataclass(frozen=True)
class GridProfile:
    """What profiling a set of sheets finds."""

    sheets: DataFrame
    headers: DataFrame
    inventory: DataFrame
    failed: DataFrame


def profile_grid(grid: DataFrame, profile: DatasetProfile, **header_options) -> GridProfile:
    """Sheets, header rows, columns with canonical names, and sheets set aside for review."""
    sheets = g.grid_sheet_inventory(grid)
    headers = g.header_rows(grid, profile.header_terms, **header_options)
    rules = cw.rules_frame(grid.sparkSession, profile.crosswalk)
    inventory = cw.crosswalk_apply(g.column_inventory(grid, headers, with_base_name=True), rules)
    return GridProfile(sheets, headers, inventory, g.failed_sheets(sheets, headers))


def canonical_columns(inventory: DataFrame) -> list[str]:
    """The canonical schema: distinct canonical names, sorted. Runs a job that returns names only."""
    return sorted(row[0] for row in inventory.select("canonical_name").distinct().collect())


def standardized(grid: DataFrame, profiled: GridProfile, columns: Sequence[str]) -> DataFrame:
    """All sheets as rows of the canonical text schema. The layouts are computed and stored first."""
    layouts = materialise(g.sheet_layouts(profiled.inventory, columns), "layouts")
    return g.standardize_part(grid, layouts, columns)


LEDGER = "ledger"


def committed_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The parts under ``path``: ``ordinal, source_file, source_sheet, part_file, n_rows, columns``, kept with their manifest."""
    found = published.current(spark, path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/{found.tables[LEDGER]}") if found else None


LEDGER_SCHEMA = "ordinal bigint, source_file string, source_sheet string, part_file string, n_rows bigint, columns array<string>"


def build_parts(
    grid: DataFrame,
    profile: DatasetProfile,
    path: str,
    ledger: DataFrame | None = None,
    failed_path: str | None = None,
    **header_options,
) -> DataFrame:
    """Write the sheets not in ``ledger`` as parts under ``path``; returns the names given to them.

    ``ledger`` is :func:`committed_ledger`; its sheets are left out before anything else is read, as are those of parts
    published since it was read. Without one all parts are built anew. Parts have the columns of the whole crosswalk:
    those of new sheets and of all parts before. ``header_options`` go to the header search. Sheets without a header
    are written to ``failed_path`` for review.

    Parts and ledger become visible together, when all are written. Raises, and changes nothing, when no new sheet has
    a header, two columns of a sheet would take one canonical name, a sheet has no part although it has rows, or
    another writer has published parts meanwhile and so taken the same numbers.
    """
    spark = grid.sparkSession
    base = published.current(spark, path)
    known = committed_ledger(spark, path) if ledger is not None else None
    if ledger is not None:
        for sheets in (ledger, known):
            grid = grid if sheets is None else grid.join(sheets.select(*g.SHEET), g.SHEET, "left_anti")
        numbers = ["ordinal", *g.SHEET]
        ledger = ledger.select(*numbers) if known is None else ledger.select(*numbers).union(known.select(*numbers)).distinct()
    rules = cw.rules_frame(spark, profile.crosswalk)
    profiled = profile_grid(grid, profile, **header_options)
    inventory = materialise(profiled.inventory, "column_inventory")
    if failed_path is not None:
        sink_parquet(profiled.failed, failed_path, mode="append")
    if inventory.isEmpty():
        if not grid.isEmpty():
            raise CheckFailed("No sheet was profiled.")
        return p.part_naming(inventory.select(*g.SHEET), ledger)
    require_empty(
        cw.crosswalk_conflicts(inventory.drop("canonical_name"), rules), "Columns of one sheet share a canonical name."
    )
    before = [c for c in base.schema.names if c not in p.PART_KEYS] if base and known is not None else []
    columns = sorted({*canonical_columns(inventory), *before})
    named = materialise(p.part_naming(inventory.select(*g.SHEET).distinct(), ledger), "named")
    layouts = g.sheet_layouts(inventory, columns).join(named.select(*g.SHEET, "part_file"), g.SHEET)
    rows = g.standardize_part(grid, materialise(layouts, "layouts"), columns, keep=["part_file"])
    staged = published.stage(rows.hint("rebalance", F.col("part_file")), path, ["part_file"])
    try:
        written = stored_counts(spark, path, staged.run)
        require_empty(unwritten(named, written, profiled, inventory, grid), "Sheets with rows have no part.")
        added = named.join(written, "part_file", "left").join(sheet_columns(inventory), g.SHEET)
        added = added.select("ordinal", *g.SHEET, "part_file", F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"), "columns")
        folder = f"{published.MANIFESTS}/{LEDGER}-{staged.run}"
        (added if known is None else known.unionByName(added)).write.parquet(f"{path}/{folder}")
        published.commit(spark, path, staged, base, append=known is not None, tables={LEDGER: folder})
    except Exception:
        published.discard(spark, path, staged)
        raise
    return named


def stored_counts(spark: SparkSession, path: str, run: str) -> DataFrame:
    """Rows of each part of a run, from its footers, as a frame of this session."""
    at = scratch_path(spark, "part-counts")
    footer_counts(spark, path, ["part_file"], [run]).write.parquet(at)
    return spark.read.schema("part_file string, n_rows bigint").parquet(at)


def sheet_columns(inventory: DataFrame) -> DataFrame:
    """Canonical names of each sheet's columns; a list as long as a sheet is wide."""
    return inventory.groupBy(*g.SHEET).agg(F.array_sort(F.collect_set("canonical_name")).alias("columns"))


def unwritten(named: DataFrame, written: DataFrame, profiled: GridProfile, inventory: DataFrame, grid: DataFrame) -> DataFrame:
    """Named sheets without a part that have rows below their header. Only sheets without a part are looked at."""
    missing = named.join(written, "part_file", "left_anti").join(inventory.select(*g.SHEET, "header_row").distinct(), g.SHEET)
    below = grid.join(missing.select(*g.SHEET, "part_file", "header_row"), g.SHEET).where(F.col("row_number") > F.col("header_row"))
    layouts = g.sheet_layouts(inventory, []).select(*g.SHEET, "named")
    kept = below.join(layouts, g.SHEET).where(~g.repeats_header(F.col("cells"), F.col("named"), 2))
    return kept.groupBy("part_file").agg(F.count("*").alias("rows_not_written"))


def stack_parts(grid: DataFrame, path: str, stacked_path: str, profile: DatasetProfile, columns: Sequence[str] | None = None) -> DataFrame:
    """Stack the published parts, leave out listed ones, and check that no row was lost.

    The schema comes from the parts' manifest and the expected number of rows from their ledger, so neither the parts'
    footers nor their rows are read for it. With ``columns`` only these, and the parts' provenance, are stacked.
    """
    spark = grid.sparkSession
    kept = None if columns is None else [*p.PART_KEYS, *(c for c in columns if c not in p.PART_KEYS)]
    parts = p.parts_exclude(published.read_published(spark, path, kept), profile.excluded_parts)
    expected = p.parts_exclude(committed_ledger(spark, path), profile.excluded_parts).agg(F.sum("n_rows")).first()[0] or 0
    staged = published.stage(parts, stacked_path)
    if staged.rows != expected:
        published.discard(spark, stacked_path, staged)
        raise CheckFailed(f"{staged.rows} stacked rows differ from the {expected} of all parts.")
    published.commit(spark, stacked_path, staged, published.current(spark, stacked_path))
    return published.read_published(spark, stacked_path)


def finish(stacked: DataFrame, profile: DatasetProfile, path: str) -> DataFrame:
    """Type the stacked table and publish it, with the number of values in each column."""
    sink_parquet(typed_table(stacked, profile.table), path, profile=True)
    return published.read_published(stacked.sparkSession, path)
