"""Parts: naming, the incremental ledger, per-part metadata, exclusion, stacking audits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.dates import parse_date_ladder
from gridloom.functions.text import clean_names, file_stem, has_data
from gridloom.operators.common import PROVENANCE, materialise, with_ordinal
from gridloom.operators.grid import SHEET

PART_KEYS = ("part_file", *PROVENANCE)


def pending_sheets(sheets: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sheets not yet built into a part."""
    return sheets.join(ledger.select(*SHEET), SHEET, "left_anti")


def part_naming(sheets: DataFrame, ledger: DataFrame | None = None, order: Sequence[str] = tuple(SHEET)) -> DataFrame:
    """Sheets with ``ordinal`` and ``part_file``: the ordinal on at least four digits, cleaned file and sheet.

    With a ``ledger`` only new sheets are named, numbered after the highest known ordinal, so existing
    names never move. Runs a job (see :func:`with_ordinal`).
    """
    new = sheets if ledger is None else pending_sheets(sheets, ledger)
    numbered = with_ordinal(new, list(order), "ordinal")
    if ledger is not None:
        highest = ledger.agg(F.coalesce(F.max("ordinal"), F.lit(0)).alias("m"))
        numbered = numbered.withColumn("ordinal", F.col("ordinal") + highest.scalar())
    digits = F.col("ordinal").cast("string")
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    name = F.concat_ws("_", padded, clean_names(file_stem(F.col("source_file"))), clean_names(F.col("source_sheet")))
    return numbered.withColumn("part_file", name)


def parts_check(expected: DataFrame, written: DataFrame) -> DataFrame:
    """Number of sheets expected against number of parts present."""
    parts = written.select("part_file").distinct().agg(F.count("*").alias("n"))
    counts = expected.agg(F.count("*").alias("expected_parts")).withColumn("written_parts", parts.scalar())
    return counts.withColumn("complete", F.col("expected_parts") == F.col("written_parts"))


def data_columns(parts: DataFrame) -> list[str]:
    return [c for c in parts.columns if c not in PART_KEYS]


def part_single_source(parts: DataFrame) -> DataFrame:
    """Parts with more than one source file or sheet; empty when all is well."""
    sources = parts.groupBy(*PART_KEYS).agg(F.count("*").alias("n_rows"))
    return (
        sources.groupBy("part_file")
        .agg(F.count("*").alias("n_sources"), F.sum("n_rows").alias("n_rows"))
        .where(F.col("n_sources") > 1)
    )


def _column_flags(columns: Sequence[str]) -> list[Column]:
    return [F.bool_or(has_data(F.col(c))).alias(f"_has_{c}") for c in columns]


def _names_with_data(columns: Sequence[str]) -> Column:
    present = F.array_compact(F.array(*[F.when(F.col(f"_has_{c}"), F.lit(c)) for c in columns]))
    return F.array_sort(present)


def _preferred(date_columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(F.col(f"_has_{c}"), F.lit(c)) for c in date_columns])


def non_empty_columns(parts: DataFrame) -> DataFrame:
    """Per part: how many columns hold data, and which."""
    columns = data_columns(parts)
    names = _names_with_data(columns)
    return (
        parts.groupBy("part_file").agg(*_column_flags(columns))
        .select("part_file", F.size(names).alias("n_non_empty_cols"), F.array_join(names, " | ").alias("non_empty_cols"))
    )


def preferred_date_column(parts: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Per part, the first of ``date_columns`` with any value; chosen for the whole part."""
    known = [c for c in date_columns if c in parts.columns]
    return parts.groupBy("part_file").agg(*_column_flags(known)).select("part_file", _preferred(known).alias("date_column"))


def part_summary(parts: DataFrame, date_columns: Sequence[str], parse: Callable[[Column], Column] = parse_date_ladder) -> DataFrame:
    """Rows, date column, date range and populated columns of each part, in one aggregation.

    Every measure combines on the map side in a hash table, so a part with much of the data is no heavier
    to shuffle. Source file and sheet are keys: a part has one of each (see :func:`part_single_source`).
    """
    columns = data_columns(parts)
    known = [c for c in date_columns if c in parts.columns]
    dates = parts.select(*parts.columns, *[parse(F.col(c)).alias(f"_date_{c}") for c in known])
    ranges = [f(f"_date_{c}").alias(f"_{f.__name__}_{c}") for c in known for f in (F.min, F.max)]
    measured = dates.groupBy(*PART_KEYS).agg(
        F.count("*").alias("n_rows"),
        *_column_flags(columns),
        *ranges,
    )
    names = _names_with_data(columns)

    def of_preferred(prefix: str) -> Column:
        chosen = F.lit(None).cast("date")
        for c in reversed(known):
            chosen = F.when(F.col("date_column") == c, F.col(f"_{prefix}_{c}")).otherwise(chosen)
        return chosen

    date_column = _preferred(known) if known else F.lit(None).cast("string")
    return (
        measured.withColumn("date_column", date_column)
        .select(
            "part_file", "source_file", "source_sheet", "n_rows", "date_column",
            of_preferred("min").alias("min_date"),
            of_preferred("max").alias("max_date"),
            F.size(names).alias("n_non_empty_cols"),
            F.array_join(names, " | ").alias("non_empty_cols"),
        )
    )


def with_date_range(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("min_date").isNotNull() & F.col("max_date").isNotNull())


def same_date_range_members(metadata: DataFrame) -> DataFrame:
    """Parts that share their exact range with another part, one row each: the form to work on."""
    ranges = with_date_range(metadata).select("min_date", "max_date", "part_file", "n_rows")
    shared = ranges.groupBy("min_date", "max_date").agg(F.count("*").alias("n_parts")).where("n_parts > 1")
    return ranges.join(shared, ["min_date", "max_date"])


def same_date_ranges(metadata: DataFrame) -> DataFrame:
    """Groups of parts with one range, their names and sizes as display text.

    The text lists every part of the group, so a row is as long as the group; use
    :func:`same_date_range_members` where groups may be large.
    """
    shown = F.concat("part_file", F.lit(" [rows: "), F.col("n_rows").cast("string"), F.lit("]"))
    return (
        with_date_range(metadata)
        .groupBy("min_date", "max_date")
        .agg(F.count("*").alias("n_parts"), F.array_join(F.array_sort(F.collect_list(shown)), " | ").alias("files_and_rows"))
        .where(F.col("n_parts") > 1)
    )


def fingerprints(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per part, ``n_rows`` and two sums of row hashes over ``columns``: equal for parts with the same rows in any order, copies
    counted. Sums combine before the shuffle, so a part of any size is one row of each task."""
    values = [F.col(f"`{c}`") for c in columns]
    # A hash alone passes over nulls; which columns are null is hashed with them.
    nulls = F.concat(*[F.when(v.isNull(), F.lit("1")).otherwise(F.lit("0")) for v in values])
    hashed = [F.sum(F.xxhash64(F.lit(seed), nulls, *values).cast("decimal(38,0)")).alias(f"sum_{seed}") for seed in (1, 2)]
    return parts.groupBy("part_file").agg(F.count("*").alias("n_rows"), *hashed)


def equal_parts(parts: DataFrame, columns: Sequence[str], metadata: DataFrame | None = None) -> DataFrame:
    """``part_file, equal_to, n_rows``: parts with the very rows of another, and the first of those by name (a part with
    itself is no row). With ``metadata`` only parts of one date range are compared.

    Parts meet by their :func:`fingerprints`, never in pairs; those that do are confirmed row by row, each against the
    first of its group, in one aggregation of the rows of such parts alone.
    """
    prints = fingerprints(parts, columns)
    keys = ["n_rows", "sum_1", "sum_2"]
    if metadata is not None:
        prints, keys = prints.join(with_date_range(metadata).select("part_file", "min_date", "max_date"), "part_file"), [*keys, "min_date", "max_date"]
    prints = materialise(prints, "fingerprints")
    groups = prints.groupBy(*keys).agg(F.min("part_file").alias("equal_to"), F.count("*").alias("n_parts")).where("n_parts > 1")
    members = materialise(prints.join(groups, keys).select("part_file", "equal_to", "n_rows"), "equal-members")
    rows = parts.select("part_file", *columns).join(members, "part_file")
    copies = rows.groupBy("equal_to", "part_file", *columns).agg(F.count("*").alias("_n"))
    # Parts of a group are equal if each of their rows is in all of them, as many times.
    sizes = members.groupBy("equal_to").agg(F.count("*").alias("_parts"))
    same = copies.groupBy("equal_to", *columns).agg(F.count("*").alias("_in"), F.min("_n").alias("_least"), F.max("_n").alias("_most"))
    doubtful = same.join(sizes, "equal_to").where((F.col("_in") != F.col("_parts")) | (F.col("_least") != F.col("_most"))).select("equal_to").distinct()
    # Groups in which hashes alone agree: a part goes if a row of it is not in the first one as many times.
    inside = copies.join(doubtful, "equal_to")
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    inside = inside.select("equal_to", "part_file", "_n", row.alias("_row"))
    first = inside.where("part_file = equal_to").select(F.col("equal_to").alias("_of"), F.col("_row").alias("_same"), F.col("_n").alias("_first"))
    met = inside.join(first, (F.col("equal_to") == F.col("_of")) & F.col("_row").eqNullSafe(F.col("_same")), "left")
    apart = met.where(~F.col("_n").eqNullSafe(F.col("_first"))).select("part_file").distinct()
    return members.where("part_file <> equal_to").join(apart, "part_file", "left_anti")


def parts_exclude(parts: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Parts without a hand-kept list of part files; the filter prunes partitions, so nothing is deleted."""
    return parts.where(~F.col("part_file").isin(*excluded)) if excluded else parts


def exclusions_absent(parts: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Listed part files that are not there to begin with."""
    listed = parts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(p) for p in excluded])).alias("part_file"))
    present = parts.where(F.col("part_file").isin(*excluded)).select("part_file").distinct()
    return listed.join(present, "part_file", "left_anti")


def stack_audit(parts: DataFrame) -> DataFrame:
    """Rows per part. No data column is read."""
    return parts.groupBy("part_file").agg(F.count("*").alias("n_rows"))


def stack_reconcile(audit: DataFrame, stacked: DataFrame) -> DataFrame:
    """Stacked row count against the sum over parts."""
    return reconcile_counts(audit, stacked.agg(F.count("*").alias("n_rows")))


def reconcile_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Two tables of ``n_rows``, by part or in one row, against each other."""
    found = actual.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    sums = expected.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("expected_rows")).withColumn("actual_rows", found.scalar())
    return sums.withColumn("ok", F.col("expected_rows") == F.col("actual_rows"))
