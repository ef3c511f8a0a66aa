"""Messy sheets as grids: ``source_file, source_sheet, row_number, cells ARRAY<STRING>``, a row per sheet row."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.text import clean_names, file_name, has_data, normalise_cell, squish
from gridloom.operators.common import keep_first

SHEET = ["source_file", "source_sheet"]
HEADER_SEARCH_ROWS = 100
NO_HEADER = "No likely header row found."


def header_pattern(terms: Sequence[str], whole_words: bool = False, literal_terms: bool = False) -> str:
    """One pattern over cleaned cell text.

    Cells are compared after name cleaning, so blanks and slashes in a term become underscores;
    ``literal_terms`` leaves the terms as they are, in which case a term with a blank never matches.
    """
    if not literal_terms:
        terms = [re.sub(r"[ /]+", "_", term.lower()) for term in terms]
    joined = "|".join(terms)
    return f"(^|_)({joined})(_|$)" if whole_words else joined


def grid_sheet_inventory(grid: DataFrame) -> DataFrame:
    """All sheets except those of lock files. Reads the two name columns only."""
    return (
        grid.where(~file_name(F.col("source_file")).startswith("~$"))
        .select(file_name(F.col("source_file")).alias("file_name"), *SHEET)
        .distinct()
    )


def header_rows(grid: DataFrame, terms: Sequence[str], min_matches: int = 3, max_rows: int = HEADER_SEARCH_ROWS, **pattern) -> DataFrame:
    """Per sheet with a header, the first row with enough header-like cells.

    Only the top rows are read (the row filter reaches the scan), and one number per sheet and task is
    shuffled.
    """
    regex = header_pattern(terms, **pattern)
    matches = F.size(F.filter("cells", lambda cell: F.coalesce(clean_names(squish(cell)).rlike(regex), F.lit(False))))
    return (
        grid.where((F.col("row_number") <= max_rows) & (matches >= min_matches))
        .groupBy(*SHEET)
        .agg(F.min("row_number").alias("header_row"))
    )


def header_detect(grid: DataFrame, terms: Sequence[str], **options) -> DataFrame:
    """Every sheet with its header row, NULL where none was found."""
    return grid_sheet_inventory(grid).select(*SHEET).join(header_rows(grid, terms, **options), SHEET, "left")


def failed_sheets(sheets: DataFrame, headers: DataFrame) -> DataFrame:
    """Sheets without a header: an output to review, not an exception."""
    found = headers.where(F.col("header_row").isNotNull())
    return sheets.join(found, SHEET, "left_anti").withColumn("error_message", F.lit(NO_HEADER))


def populated_positions(grid: DataFrame) -> DataFrame:
    """Per sheet, the cell positions (from 1) with any non-blank value. Tasks send one row per position."""
    cells = grid.select(*SHEET, F.posexplode("cells").alias("pos", "cell"))
    return cells.where(has_data(F.col("cell"))).select(*SHEET, (F.col("pos") + 1).alias("position")).distinct()


def column_inventory(grid: DataFrame, headers: DataFrame, with_base_name: bool = False) -> DataFrame:
    """One row per named column of each sheet.

    A named header cell is itself a value, so dropping blank headers also drops every empty column.
    Repeated names get a numeric suffix. ``cell_position`` counts all cells from 1, ``column_position``
    only the kept ones. ``with_base_name`` adds the name without suffix. Windows here span one header row, whose
    width a spreadsheet bounds. Header rows may be anywhere; the last of them bounds the rows that are read.
    """
    last = headers.agg(F.max("header_row").alias("d")).scalar()
    header_cells = (
        grid.where(F.col("row_number") <= last)
        .join(headers.where(F.col("header_row").isNotNull()), SHEET)
        .where(F.col("row_number") == F.col("header_row"))
        .select(*SHEET, "header_row", F.posexplode("cells").alias("pos", "cell"))
        .select(*SHEET, "header_row", "pos", squish(F.col("cell")).alias("raw_column"))
        .where(has_data(F.col("raw_column")))
        .withColumn("base_name", clean_names(F.col("raw_column")))
    )
    sheet = Window.partitionBy(*SHEET)
    repeat = F.row_number().over(Window.partitionBy(*SHEET, "base_name").orderBy("pos"))
    return (
        header_cells.withColumn("repeat", repeat)
        .withColumn("column_position", F.row_number().over(sheet.orderBy("pos")))
        .select(
            file_name(F.col("source_file")).alias("file_name"),
            *SHEET,
            "header_row",
            (F.col("header_row") - 1).alias("rows_to_skip"),
            F.count("*").over(sheet).alias("ncol"),
            "raw_column",
            F.when(F.col("repeat") > 1, F.concat_ws("_", "base_name", "repeat")).otherwise(F.col("base_name")).alias("clean_column"),
            *(["base_name"] if with_base_name else []),
            "column_position",
            (F.col("pos") + 1).alias("cell_position"),
        )
    )


def unseen_files(grid: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rows of files the inventory does not know.

    ``inventory`` is meant to be a stored table: then its size is known, and rows need no shuffle while
    the list of files can be broadcast.
    """
    return grid.join(inventory.select("source_file").distinct(), "source_file", "left_anti")


def merge_inventory(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old and new entries, one per key; an old entry wins."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    return keep_first(both, list(keys), ["_age"]).drop("_age")


def sheet_layouts(inventory: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per sheet: header row, its named columns, and for each of ``columns`` the cell index (from 0).

    ``inventory`` carries ``canonical_name``. A layout is bounded by the width of a sheet. Rows that repeat the header
    repeat it as it stands there, so cells are compared with names without suffix.
    """
    base = F.col("base_name") if "base_name" in inventory.columns else F.col("clean_column")
    named = F.collect_list(F.struct((F.col("cell_position") - 1).alias("index"), base.alias("name")))
    places = F.map_from_entries(F.collect_list(F.struct("canonical_name", F.col("cell_position") - 1)))
    wanted = F.array(*[F.lit(c) for c in columns])
    return (
        inventory.groupBy(*SHEET)
        .agg(F.first("header_row").alias("header_row"), named.alias("named"), places.alias("places"))
        .select(*SHEET, "header_row", "named", F.transform(wanted, lambda c: F.try_element_at("places", c)).alias("indexes"))
    )


def repeats_header(cells: Column, named: Column, threshold: int) -> Column:
    def equal(column: Column) -> Column:
        # Most cells are not even near their header: the name's first word is looked for before the cell is normalised.
        cell = F.get(cells, column["index"])
        near = F.contains(F.lower(cell), F.substring_index(column["name"], "_", 1))
        return F.coalesce(near & (normalise_cell(cell) == column["name"]), F.lit(False))

    same = F.filter(named, equal)
    return F.size(same) >= threshold


def repeat_header_drop(grid: DataFrame, layouts: DataFrame, threshold: int = 2) -> DataFrame:
    """Data rows below the header, without rows that repeat at least ``threshold`` of their headers.

    The layouts hold one row per sheet and are meant to be a stored table (see :func:`materialise`). Spark
    broadcasts them when their size allows, so rows stay where they are; beyond that it sort-merges, and
    adaptive skew handling splits a sheet that holds much of the data.
    """
    return (
        grid.join(layouts, SHEET)
        .where(F.col("row_number") > F.col("header_row"))
        .where(~repeats_header(F.col("cells"), F.col("named"), threshold))
    )


def standardize_part(grid: DataFrame, layouts: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Sheet rows as text columns: provenance first, then ``columns`` in order, absent ones NULL.

    One map-side projection per row: each column is a lookup by index, with no pivot or shuffle.
    ``keep`` names further columns of ``layouts`` or ``grid`` to carry along, such as ``part_file``.
    """
    rows = repeat_header_drop(grid, layouts)
    values = [F.get("cells", F.get("indexes", F.lit(i))).cast("string").alias(c) for i, c in enumerate(columns)]
    return rows.select(*keep, file_name(F.col("source_file")).alias("source_file"), "source_sheet", *values)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """``df`` without columns that hold no value at all. Runs one job that returns a single row of flags."""
    flags = df.agg(*[F.bool_or(has_data(F.col(f"`{c}`").cast("string"))).alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if flags[c]])
