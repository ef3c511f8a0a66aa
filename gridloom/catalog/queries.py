"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``, one per operator of the inventory."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import functions as fn
from gridloom.catalog import inputs
from gridloom.catalog.inputs import RAW_SPEC, table
from gridloom.operators import benchmark as bm
from gridloom.operators import compare as cmp
from gridloom.operators import crosswalk as cw
from gridloom.operators import grid as g
from gridloom.operators import links as lk
from gridloom.operators import lists as ls
from gridloom.operators import overlap as ov
from gridloom.operators import parts as pt
from gridloom.operators import report as rp
from gridloom.operators import typed as ty
from gridloom.operators.common import materialise
from gridloom.plans import release, validation
from gridloom.plans.profiles import APPREHENSIONS
from gridloom.session import scratch_path
from gridloom.sources import footers, published, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

# Parameters of the queries below; the SQL twins spell the same values.
LINK_SITES = r"\.com/|\.net/"
LINK_TERMS = ("the", "de", "in")
TOO_SPECIFIC = ("ing", "tion", "ment")
SINCE = "1997-01-01"
CONFLICTING_RULES = {"person": ("app_age", "gender"), "age": ("age",)}
WIDE_COLUMNS = ["age", "citizenship", "entry_status", "gender", "nationality"]
EXCLUDED_PARTS = ["0004_part_1995.xlsx", "0099_part_2090.xlsx"]
PREVIEW_ROWS = 50
DATE_PREFERENCE = ("flag_date", "stamp_text", "date_text")


def register(function: Query) -> Query:
    REGISTERED[function.__name__] = function
    return function


# ---- sources, scans, sinks


def _links(spark, sf):
    return lk.link_extract(table(spark, sf, "pages"))


def _classified(links):
    return lk.link_classify(links, "text", LINK_TERMS, TOO_SPECIFIC, LINK_SITES)


def _link_generations(spark, sf):
    """Links of the pages under ``/en/`` as already known, links of all pages as current."""
    pages = table(spark, sf, "pages")
    known = lk.link_extract(pages.where(F.col("url").contains("/en/")))
    return _classified(known), _classified(lk.link_extract(pages))


@register
def link_extract(spark, sf):
    return _links(spark, sf)


@register
def link_classify(spark, sf):
    return _classified(_links(spark, sf))


@register
def link_new(spark, sf):
    known, current = _link_generations(spark, sf)
    return lk.link_new(current, known).select("full_url", "text", "download_class")


@register
def link_manual_review_count(spark, sf):
    known, current = _link_generations(spark, sf)
    return lk.manual_review_count(lk.link_new(current, known))


@register
def link_inventory_update(spark, sf):
    known, current = _link_generations(spark, sf)
    return lk.link_inventory_update(known, current)


@register
def link_filter_simple(spark, sf):
    return lk.link_filter_simple(_links(spark, sf), "the", LINK_SITES)


@register
def grid_sheet_inventory(spark, sf):
    return g.grid_sheet_inventory(inputs.grid(spark, sf))


@register
def scan_parts_union_by_name(spark, sf):
    """Parts published with differing columns, read back as one table."""
    parts = inputs.parts(spark, sf)
    even = F.regexp_extract("source_file", "([0-9]+)", 1).cast("int") % 2 == 0
    path = scratch_path(spark, "parts")
    sinks.sink_parquet(parts.where(even), path, ["part_file"])
    sinks.sink_parquet(parts.where(~even).drop("flag_text"), path, ["part_file"], mode="append")
    return readers.scan_parts_union_by_name(spark, path)


@register
def scan_projected(spark, sf):
    events = readers.scan_projected(spark, f"{sf}/events.parquet", ["ts", "event_type"])
    return events.groupBy("event_type", fn.week_start(F.col("ts").cast("date")).alias("week_start")).agg(
        F.count("*").alias("event_count")
    )


BENCHMARK_COLUMNS = {
    "Fiscal Year": "fiscal_year_text",
    "Month (abbv)": "month_abbreviation",
    "Component": "component",
    "Title of Authority": "title_of_authority",
    "Encounter Type": "encounter_type",
    "Encounter Count": "encounter_count",
}


@register
def csv_scan_typed(spark, sf):
    """Benchmark releases written as delimited text, titles with quotes and line breaks, read back in one scan with tags."""
    month, component = F.col("month_abbreviation"), F.col("component")
    titles = {"title_of_authority": F.concat(F.lit('Title "'), month, F.lit('",\nas amended')), "encounter_type": F.when(component == "MAIN", F.lit(""))}
    rows = inputs.benchmark_releases(spark, sf).withColumns(titles)
    releases, headers = [], list(BENCHMARK_COLUMNS)
    for name, day, order in (("r1", "2000-01-01", headers), ("r2", "2001-01-01", headers[::-1])):
        path = scratch_path(spark, name)
        sinks.sink_csv(rows.where(F.col("benchmark_id") == name).select(*[F.col(BENCHMARK_COLUMNS[h]).alias(h) for h in order]), path)
        releases.append((name, day, path))
    return readers.csv_scan_typed(spark, releases, BENCHMARK_COLUMNS, {"encounter_count": fn.to_integer(F.col("encounter_count"))})


@register
def sink_parquet(spark, sf):
    path = scratch_path(spark, "typed")
    sinks.sink_parquet(ty.typed_table(inputs.raw(spark, sf), RAW_SPEC), path)
    return published.read_published(spark, path)


@register
def published_profile(spark, sf):
    """The profile that a table is published with; the second half of the records comes in a run of its own."""
    path, typed = scratch_path(spark, "profiled"), ty.typed_table(inputs.raw(spark, sf), RAW_SPEC)
    late = F.crc32("record_id") % 2 == 1
    sinks.sink_parquet(typed.where(~late), path, profile=True)
    sinks.sink_parquet(typed.where(late), path, mode="append", profile=True)
    return published.published_profile(spark, path)


@register
def sink_csv(spark, sf):
    path = scratch_path(spark, "weekly")
    weekly = rp.weekly_counts_by_source(inputs.events(spark, sf), F.col("event_date"))
    sinks.sink_csv(weekly, path)
    return readers.read_csv(spark, path, weekly.schema)


@register
def table_profile(spark, sf):
    return ty.table_profile(ty.typed_table(inputs.raw(spark, sf), RAW_SPEC))


@register
def table_preview(spark, sf):
    return ty.preview(ty.typed_table(inputs.raw(spark, sf), RAW_SPEC), PREVIEW_ROWS)


# ---- profiling grids


@register
def clean_names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fn.clean_names(F.col("text")).alias("clean_name"))


@register
def header_detect(spark, sf):
    return g.header_detect(inputs.grid(spark, sf), APPREHENSIONS.header_terms)


@register
def drop_empty_columns(spark, sf):
    return g.populated_positions(inputs.grid(spark, sf))


def _inventory(grid):
    return g.column_inventory(grid, g.header_rows(grid, APPREHENSIONS.header_terms))


@register
def column_inventory(spark, sf):
    return _inventory(inputs.grid(spark, sf))


@register
def failed_sheets(spark, sf):
    grid = inputs.grid(spark, sf)
    return g.failed_sheets(g.grid_sheet_inventory(grid), g.header_rows(grid, APPREHENSIONS.header_terms))


INVENTORY_KEYS = ["source_file", "source_sheet", "raw_column", "column_position"]


def _known_files(df):
    """The first generation: files before ``file_3``."""
    return df.where(F.col("source_file") < "file_3")


@register
def profile_incremental(spark, sf):
    """An inventory of the first files, brought up to date by profiling the unseen files alone."""
    grid = inputs.grid(spark, sf)
    old = materialise(_inventory(_known_files(grid)).withColumn("generation", F.lit("old")), "inventory")
    new = _inventory(g.unseen_files(grid, old)).withColumn("generation", F.lit("new"))
    return g.merge_inventory(old, new, INVENTORY_KEYS)


@register
def distinct_columns(spark, sf):
    return cw.distinct_columns(materialise(_inventory(inputs.grid(spark, sf)), "inventory"))


# ---- crosswalk and standardisation


def _rules(spark):
    return cw.rules_frame(spark, APPREHENSIONS.crosswalk)


def _distinct_columns(grid):
    return cw.distinct_columns(materialise(_inventory(grid), "inventory")).select("clean_column", "raw_column", "n_files")


@register
def crosswalk_apply(spark, sf):
    return cw.crosswalk_apply(_distinct_columns(inputs.grid(spark, sf)), _rules(spark))


@register
def crosswalk_lost(spark, sf):
    """Columns that a crosswalk made from the first two columns of each sheet does not list."""
    inventory = materialise(_inventory(inputs.grid(spark, sf)), "inventory")
    earlier = inventory.where(F.col("column_position") <= 2)
    crosswalk = cw.crosswalk_apply(earlier.select("clean_column", "raw_column").distinct(), _rules(spark))
    return cw.crosswalk_lost(cw.distinct_columns(inventory).select("clean_column", "raw_column", "n_files"), crosswalk)


@register
def crosswalk_collapsed(spark, sf):
    return cw.crosswalk_collapsed(cw.crosswalk_apply(_distinct_columns(inputs.grid(spark, sf)), _rules(spark)))


@register
def crosswalk_conflicts(spark, sf):
    return cw.crosswalk_conflicts(_inventory(inputs.grid(spark, sf)), cw.rules_frame(spark, CONFLICTING_RULES))


def _layouts(spark, grid):
    return materialise(g.sheet_layouts(cw.crosswalk_apply(_inventory(grid), _rules(spark)), WIDE_COLUMNS), "layouts")


@register
def repeat_header_drop(spark, sf):
    grid = inputs.grid(spark, sf)
    kept = g.repeat_header_drop(grid, _layouts(spark, grid))
    return kept.select("source_file", "source_sheet", "row_number", F.array_join("cells", "|", "").alias("cells_text"))


@register
def standardize_part(spark, sf):
    grid = inputs.grid(spark, sf)
    return g.standardize_part(grid, _layouts(spark, grid), WIDE_COLUMNS)


@register
def part_naming(spark, sf):
    return pt.part_naming(g.grid_sheet_inventory(inputs.grid(spark, sf)))


@register
def parts_incremental(spark, sf):
    """First files as already built parts; the rest named after them."""
    sheets = g.grid_sheet_inventory(inputs.grid(spark, sf))
    ledger = pt.part_naming(_known_files(sheets))
    return ledger.unionByName(pt.part_naming(sheets, ledger)).select("source_file", "source_sheet", "ordinal", "part_file")


@register
def parts_built(spark, sf):
    """Parts of the first files, then those of all others, each run published with the ledger of all parts so far."""
    grid, path = materialise(inputs.grid(spark, sf), "grid"), scratch_path(spark, "parts")
    release.build_parts(_known_files(grid), APPREHENSIONS, path)
    release.build_parts(grid, APPREHENSIONS, path, release.committed_ledger(spark, path))
    ledger = release.committed_ledger(spark, path)
    return ledger.select("source_file", "source_sheet", "ordinal", "part_file", "n_rows", F.array_join("columns", "|").alias("columns"))


@register
def parts_check(spark, sf):
    """Parts built for the sheets that have a header, against all sheets."""
    grid = inputs.grid(spark, sf)
    written = pt.part_naming(_inventory(grid).select("source_file", "source_sheet").distinct())
    return pt.parts_check(g.grid_sheet_inventory(grid), written)


# ---- part metadata


@register
def parse_date_ladder(spark, sf):
    raw = inputs.raw(spark, sf)
    return raw.select(
        "record_id",
        fn.parse_date_ladder(F.col("date_text")).alias("event_date"),
        fn.parse_date_ladder(F.col("stamp_text")).alias("stamp_date"),
        fn.parse_date_ladder(F.concat(F.lit("\u00a0"), "date_text", F.lit("\u2003(see 3/4)"))).alias("noted_date"),
        fn.parse_date_ladder(F.concat(F.lit("\u00a0"), "date_text", F.lit("\u2003"))).alias("spaced_date"),
    )


@register
def non_empty_columns(spark, sf):
    return pt.non_empty_columns(inputs.parts(spark, sf))


def _dated_parts(spark, sf):
    """Parts with a column of dates that only even years fill, preferred over the others."""
    return inputs.parts(spark, sf).withColumn("flag_date", F.when(F.col("flag_text").isNotNull(), F.col("date_text")))


@register
def preferred_date_column(spark, sf):
    return pt.preferred_date_column(_dated_parts(spark, sf), DATE_PREFERENCE)


@register
def part_summary(spark, sf):
    return pt.part_summary(_dated_parts(spark, sf), DATE_PREFERENCE)


@register
def part_single_source(spark, sf):
    """Parts named wrongly, by flag where there is one: such a part mixes source files."""
    mixed = inputs.parts(spark, sf).withColumn("part_file", F.coalesce("flag_text", F.col("part_file")))
    return pt.part_single_source(mixed)


def _event_metadata(spark, sf):
    """Part metadata as a stored table: several plans read it more than once."""
    return materialise(pt.part_summary(inputs.events(spark, sf), ["event_date"], parse=lambda c: c), "metadata")


@register
def same_date_ranges(spark, sf):
    return pt.same_date_ranges(_event_metadata(spark, sf))


@register
def equal_parts(spark, sf):
    """Yearly parts, those of even years released again under another name, those of every third year with rows missing."""
    parts = inputs.parts(spark, sf)
    year = F.substring("source_file", 6, 4).cast("int")
    renamed = lambda df, mark: df.withColumn("part_file", F.concat("part_file", F.lit(mark)))
    thinner = parts.where((year % 3 == 0) & (F.crc32("record_id") % 50 != 0))
    every = parts.unionAll(renamed(parts.where(year % 2 == 0), "_again")).unionAll(renamed(thinner, "_thinner"))
    return pt.equal_parts(every, [c for c in every.columns if c != "part_file"])


@register
def same_date_range_members(spark, sf):
    return pt.same_date_range_members(_event_metadata(spark, sf))


# ---- pair comparison

COMPARED = ["source_file", "source_sheet", "date_text", "stamp_text", "flag_text", "int_text"]


@register
def pair_shared_columns(spark, sf):
    return cmp.pair_shared_columns(*inputs.pair(spark, sf))


@register
def rows_only_in_a(spark, sf):
    return cmp.rows_only_in_a(*inputs.pair(spark, sf), COMPARED)


@register
def rows_only_in_b(spark, sf):
    return cmp.rows_only_in_b(*inputs.pair(spark, sf), COMPARED)


@register
def pair_match_summary(spark, sf):
    return cmp.pair_match_summary(*inputs.pair(spark, sf), COMPARED)


@register
def pair_columns_only(spark, sf):
    return cmp.pair_columns_only(*inputs.pair(spark, sf))


@register
def pair_value_diff(spark, sf):
    return cmp.pair_value_diff(*inputs.pair(spark, sf), COMPARED)


@register
def pair_multiset_equal(spark, sf):
    return cmp.pair_multiset_equal(*inputs.pair(spark, sf), COMPARED)


# ---- stacking


@register
def parts_exclude(spark, sf):
    return pt.parts_exclude(inputs.parts(spark, sf), EXCLUDED_PARTS)


@register
def parts_exclude_absent(spark, sf):
    return pt.exclusions_absent(inputs.parts(spark, sf), EXCLUDED_PARTS)


def _published_parts(spark, sf):
    path = scratch_path(spark, "parts")
    sinks.sink_parquet(inputs.parts(spark, sf).hint("rebalance", F.col("part_file")), path, ["part_file"])
    return path


@register
def stack_audit(spark, sf):
    """From the parts' footers."""
    return footers.published_counts(spark, _published_parts(spark, sf), ["part_file"])


@register
def stack_reconcile(spark, sf):
    """The audit of all parts against a stack that left one out, both from footers."""
    parts, stack = _published_parts(spark, sf), scratch_path(spark, "stack")
    sinks.sink_parquet(pt.parts_exclude(readers.scan_parts_union_by_name(spark, parts), EXCLUDED_PARTS), stack)
    counting = footers.counting_session(spark)
    return pt.reconcile_counts(footers.published_counts(counting, parts, ["part_file"]), footers.published_counts(counting, stack))


# ---- cleaning and typing


@register
def column_order(spark, sf):
    return ty.column_order(inputs.raw(spark, sf), RAW_SPEC.order)


@register
def clean_text(spark, sf):
    raw = inputs.raw(spark, sf)
    return raw.select("record_id", *[fn.clean_text(F.col(c)).alias(c) for c in RAW_SPEC.order if c in raw.columns])


def _converted(spark, sf, convert, columns):
    raw = inputs.raw(spark, sf)
    cleaned = raw.select("record_id", *[fn.clean_text(F.col(c)).alias(c) for c in columns])
    return cleaned.select("record_id", *[convert(F.col(c)).alias(c) for c in columns])


def _register_conversion(name, convert, columns):
    REGISTERED[name] = partial(_converted, convert=convert, columns=columns)


_register_conversion("to_datetime", fn.to_datetime, ["stamp_text", "date_text"])
_register_conversion("to_date", fn.to_date, ["date_text", "stamp_text"])
_register_conversion("to_date_us", partial(fn.to_date, us_dates=True), ["date_text", "stamp_text"])
_register_conversion("to_time", fn.to_time, ["time_text", "stamp_text", "date_text"])
_register_conversion("to_logical", fn.to_logical, ["flag_text"])
_register_conversion("to_integer", fn.to_integer, ["int_text", "ratio_text"])
_register_conversion("to_double", fn.to_double, ["ratio_text", "int_text"])


@register
def redaction_flag(spark, sf):
    raw = inputs.raw(spark, sf)
    flagged = ["date_text", "stamp_text", "flag_text", "time_text"]
    return raw.select("record_id", *[fn.redaction_flag(F.col(c)).alias(f"{c}_redacted") for c in flagged])


@register
def typed_table(spark, sf):
    return ty.typed_table(inputs.raw(spark, sf), RAW_SPEC)


@register
def typed_table_wide(spark, sf):
    """The full column list of a release, every column of a kind filled with the dirty text of that kind."""
    raw, spec = inputs.raw(spark, sf), APPREHENSIONS.table
    return ty.typed_table(raw.select("record_id", *[F.col(inputs.TEXT_OF_KIND[spec.kind(c)]).alias(c) for c in spec.order]), spec)


@register
def drop_empty_columns_table(spark, sf):
    """A release whose second note is empty throughout."""
    return g.drop_empty_columns(inputs.pair(spark, sf)[0])


def _register_audit(name, audit):
    REGISTERED[name] = lambda spark, sf: audit(inputs.raw(spark, sf), RAW_SPEC)


for _name in ("audit_datetime", "audit_date", "audit_time", "audit_logical", "audit_numeric", "audit_all"):
    _register_audit(_name, getattr(ty, _name))


# ---- overlap validation


@register
def contained_pairs(spark, sf):
    return ov.contained_pairs(_event_metadata(spark, sf))


@register
def event_date_coalesced(spark, sf):
    columns = ["date_text", "stamp_text"]
    return inputs.raw(spark, sf).select("record_id", fn.first_event_date(columns).alias("event_date"))


def _pairs_and_counts(spark, sf):
    events = inputs.events(spark, sf)
    pairs = ov.contained_pairs(_event_metadata(spark, sf))
    return pairs, ov.daily_counts(events, F.col("event_date"), pairs)


@register
def daily_counts(spark, sf):
    return _pairs_and_counts(spark, sf)[1]


@register
def date_spine(spark, sf):
    return ov.date_spine(_pairs_and_counts(spark, sf)[0])


@register
def daily_intervals(spark, sf):
    return ov.daily_intervals(*_pairs_and_counts(spark, sf))


@register
def containing_pairs_cut(spark, sf):
    """Date ranges of the orders of 600 groups of customers, blocks cut into small pieces."""
    day = F.col("o_orderdate").cast("date")
    groups = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 600).cast("string").alias("part_file"))
    metadata = groups.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.count("*").alias("n_rows"))
    return ov.containing_pairs(materialise(metadata, "metadata"), piece=32).select("smaller_file", "larger_file")


@register
def daily_comparison(spark, sf):
    return ov.daily_comparison(*_pairs_and_counts(spark, sf))


@register
def pair_summary(spark, sf):
    summary = ov.pair_summary(*_pairs_and_counts(spark, sf))
    return summary.withColumn("percent_days_matching", F.round("percent_days_matching", 6))


# ---- benchmark cross reference


def _benchmark(spark, sf):
    return bm.fiscal_to_calendar(bm.benchmark_checked(inputs.benchmark_releases(spark, sf), "MAIN"))


@register
def benchmark_union(spark, sf):
    return bm.benchmark_union(inputs.benchmark_releases(spark, sf), "MAIN")


@register
def fiscal_to_calendar(spark, sf):
    return _benchmark(spark, sf)


@register
def benchmark_invalid_months(spark, sf):
    """The months of one quarter, misspelt."""
    releases = inputs.benchmark_releases(spark, sf)
    month = F.col("month_abbreviation")
    misspelt = F.when(month.isin("Jan", "Feb", "Mar"), F.concat(month, F.lit("x"))).otherwise(month)
    return bm.benchmark_invalid_months(bm.benchmark_union(releases.withColumn("month_abbreviation", misspelt), "MAIN"))


@register
def benchmark_latest(spark, sf):
    return bm.benchmark_latest(_benchmark(spark, sf))


def _latest(spark, sf):
    """One row per month, stored: its bounds and its rows are both needed."""
    return materialise(bm.benchmark_latest(_benchmark(spark, sf)), "benchmark")


def _monthly_in_range(spark, sf, benchmark):
    orders = table(spark, sf, "orders").where("o_orderpriority <> '5-LOW'")
    return bm.monthly_in_range(orders, F.col("o_orderdate").cast("date"), benchmark)


@register
def monthly_in_range(spark, sf):
    return _monthly_in_range(spark, sf, _latest(spark, sf))


def _cross_reference(spark, sf):
    latest = _latest(spark, sf)
    return bm.cross_reference(latest, _monthly_in_range(spark, sf, latest))


@register
def cross_reference(spark, sf):
    return _cross_reference(spark, sf).withColumn("percent_difference", F.round("percent_difference", 6))


@register
def cross_reference_summary(spark, sf):
    return bm.cross_reference_summary(_cross_reference(spark, sf))


# ---- reporting


@register
def monthly_counts_by_source(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "source_file")
    return rp.monthly_counts_by_source(orders, F.col("o_orderdate").cast("date"), SINCE, "order_count")


def _weekly(spark, sf):
    return rp.weekly_counts_by_source(inputs.events(spark, sf), F.col("event_date"), "event_count")


@register
def weekly_counts_by_source(spark, sf):
    return _weekly(spark, sf)


@register
def weekly_with_part(spark, sf):
    return rp.weekly_with_part(_weekly(spark, sf), _event_metadata(spark, sf))


@register
def weekly_with_part_by_file(spark, sf):
    return rp.weekly_with_part(_weekly(spark, sf), _event_metadata(spark, sf), by_file=True)


@register
def latest_week_per_part(spark, sf):
    weekly = rp.weekly_with_part(_weekly(spark, sf), _event_metadata(spark, sf))
    return rp.latest_week_per_part(weekly, "2024-01-01")


@register
def coverage_contained_flag(spark, sf):
    flagged = ov.coverage_contained_flag(_yearly_metadata(spark, sf))
    return flagged.select("part_file", "min_date", "max_date", "contained")


def _yearly_metadata(spark, sf):
    """Date ranges of order parts by year, and by customer segment within the years."""
    orders = table(spark, sf, "orders").withColumn("event_date", F.col("o_orderdate").cast("date"))
    yearly = orders.select(
        F.concat(((F.year("event_date") - 1990) * 2500).cast("string"), F.lit("_year.parquet")).alias("part_file"),
        "event_date",
    )
    customers = orders.select(F.concat(F.lit("0100_customer_"), F.col("o_custkey").cast("string")).alias("part_file"), "event_date")
    metadata = yearly.unionAll(customers).groupBy("part_file").agg(
        F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"), F.count("*").alias("n_rows")
    )
    return materialise(metadata, "metadata")


@register
def coverage_timeline(spark, sf):
    return rp.coverage_timeline(_yearly_metadata(spark, sf))


# ---- older operators


def _order_flags(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderpriority")
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("charge"),
    )
    return orders.join(items, "order_key")


@register
def collapse_multivalue(spark, sf):
    folded = ls.collapse_multivalue(_order_flags(spark, sf), "charge", order="line")
    return folded.select(
        "identifier", "order_key", "o_orderpriority",
        F.size("charge_list").alias("n_charges"),
        F.array_join("charge_list", ",", "-").alias("charge_list"),
    )


@register
def collapse_multivalue_split(spark, sf):
    """Lists begun anew every three lines."""
    folded = ls.collapse_multivalue(_order_flags(spark, sf), "charge", order="line", group_id=None, split_every=3)
    return folded.select("order_key", "o_orderpriority", "list_part", F.array_join("charge_list", ",", "-").alias("charge_list"))


@register
def list_to_text(spark, sf):
    folded = ls.collapse_multivalue(_order_flags(spark, sf), "charge", order="line", group_id=None)
    return folded.select("order_key", ls.list_to_text(F.col("charge_list")).alias("charge"))


@register
def tagged_union_cutoff(spark, sf):
    orders = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    first = orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    second = orders.select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("o_orderdate"), "o_totalprice")
    return ls.tagged_union_cutoff([
        ls.TaggedFrame("part1.xlsx", first, day <= F.lit("1997-12-31").cast("date"), {"o_orderdate": day}),
        ls.TaggedFrame("part2.xlsx", second, None, {"o_orderdate": fn.parse_date_ladder(F.col("o_orderdate"))}),
    ])


# ---- whole paths


@register
def release_monthly_counts(spark, sf):
    """Dirty text to typed table, and monthly counts by source; only the columns of the date are read and typed."""
    typed = ty.typed_table(inputs.raw(spark, sf), RAW_SPEC)
    date = rp.event_date_of(["stamp_text", "date_text"])
    return rp.monthly_counts_by_source(typed, date, SINCE, "record_count", stored_date=False)


@register
def release_overlaps(spark, sf):
    """Sheets through all steps of a release: parts, metadata, stack, typed table, overlaps and reports, each published."""
    done = validation.run_release(inputs.dated_grid(spark, sf), APPREHENSIONS, scratch_path(spark, "release"))
    return done.overlaps.summary.select("smaller_file", "larger_file", "days_compared", "matching_days", "smaller_records_in_range", "larger_records_in_range")


@register
def release_grid_to_typed(spark, sf):
    """Sheets to typed table: header search, crosswalk, standardisation and typing in one plan."""
    grid = inputs.grid(spark, sf)
    profiled = release.profile_grid(grid, APPREHENSIONS)
    typed = ty.typed_table(release.standardized(grid, profiled, WIDE_COLUMNS), APPREHENSIONS.table)
    return typed.groupBy("source_file", "gender", "citizenship").agg(
        F.count("*").alias("n_rows"), F.sum("age").alias("total_age"), F.count("nationality").alias("n_nationality")
    )
