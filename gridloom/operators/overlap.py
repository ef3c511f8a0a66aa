"""Overlapping releases: which part's range contains another's, and whether their daily counts agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.common import materialise, spread, with_ordinal
from gridloom.operators.parts import with_date_range

# Blocks of days have lengths of powers of two; the longest holds every day of the calendar, years 1 to 9999.
LEVELS = 23
#: Days that a task writes out of a run at once.
DAYS_PER_STEP = 3660
PAIR_COLUMNS = [
    "smaller_file", "smaller_min_date", "smaller_max_date", "larger_file", "larger_min_date", "larger_max_date",
]


def day_number(c: Column) -> Column:
    return F.date_diff(c, F.lit("0001-01-01").cast("date")).cast("bigint") + 1


def blocks_of_range(first: Column, last: Column) -> Column:
    """The fewest aligned blocks of days that make up a range: two per level at most, however long it is."""
    begin, end = day_number(first), day_number(last) + 1
    places = []
    for level in range(LEVELS):
        low, high = F.shiftright(begin + ((1 << level) - 1), level), F.shiftright(end, level)
        block = lambda at: F.struct(F.lit(level).alias("level"), at.alias("at"))  # noqa: E731, B023
        places.append(F.when((low < high) & (low % 2 == 1), block(low)))
        places.append(F.when((low < high) & (high % 2 == 1), block(high - 1)))
    return F.filter(F.array(*places), lambda p: p.isNotNull())


def blocks_of_day(day: Column) -> Column:
    """The block of each level that holds a day."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(day_number(day), k).alias("at")) for k in range(LEVELS)])


#: Starts and ranges of a block that one piece of work compares; also the number of parts that need no blocks.
PIECE = 2048


def _all_in_one(day: Column) -> Column:
    """The longest block alone, which holds every day."""
    return F.array(F.struct(F.lit(LEVELS).alias("level"), F.shiftright(day_number(day), LEVELS).alias("at")))


def _ends(smaller: DataFrame, larger: DataFrame) -> DataFrame:
    """Per block and end day, how many starts and ranges end there: ``level, at, end, s, l``."""
    one, none = F.lit(1).alias("n"), F.lit(0)
    sides = smaller.select("level", "at", F.col("smaller_max_date").alias("end"), one.alias("s"), none.alias("l")).unionAll(
        larger.select("level", "at", "larger_max_date", none, one)
    )
    return sides.groupBy("level", "at", "end").agg(F.sum("s").alias("s"), F.sum("l").alias("l"))


def _pieces(ends: DataFrame, piece: int) -> tuple[DataFrame, DataFrame]:
    """How blocks with many starts and ranges are cut: ``places`` (slice of each end day) and ``grid`` (the pairs of slices that
    can hold a pair, and into how many parts either side of them is dealt).

    Slices are runs of end days with about ``piece`` rows. A start in one and a range in a later one are a pair of the
    result, so what is sent to such a piece is no more than what comes out of it; only within a slice is there anything
    to compare.
    """
    block = ["level", "at"]
    heavy = ends.groupBy(*block).agg(F.sum("s").alias("s"), F.sum("l").alias("l")).where(F.col("s") * F.col("l") > piece * piece).select(*block)
    running = F.sum(F.col("s") + F.col("l")).over(Window.partitionBy(*block).orderBy("end").rowsBetween(Window.unboundedPreceding, -1))
    places = ends.join(heavy, block).withColumn("slice", F.floor(F.coalesce(running, F.lit(0)) / piece))
    slices = places.groupBy(*block, "slice").agg(F.sum("s").alias("s"), F.sum("l").alias("l"))
    here = slices.where("s > 0").select(*block, F.col("slice").alias("low"), F.ceil(F.col("s") / piece).alias("parts_smaller"))
    there = slices.where("l > 0").select(*block, F.col("slice").alias("high"), F.ceil(F.col("l") / piece).alias("parts_larger"))
    return places.select(*block, "end", "slice"), here.join(there, block).where("low <= high")


def containing_pairs(metadata: DataFrame, piece: int = PIECE) -> DataFrame:
    """Ordered pairs in which the larger part's range covers the smaller's; equal ranges once, by name.

    A covering part holds the day on which the covered one begins, so exactly one of its blocks of days does: the
    parts meet in an equi-join on blocks, each pair once. A range of any length is a few dozen blocks at most. Few
    parts meet in one block. A block with more starts and ranges than ``piece`` squared comparisons allow is cut by end
    days into pieces that hold as much each: the work is in proportion to the parts and the pairs found. Runs a job that
    counts parts and, with many, one that looks for such blocks.
    """
    ranges = with_date_range(metadata).select("part_file", "min_date", "max_date")
    named = lambda prefix: [F.col(c).alias(f"{prefix}_{c.replace('part_', '')}") for c in ranges.columns]
    few = ranges.limit(piece + 1).count() <= piece
    of_start, of_range = (_all_in_one(F.col("min_date")),) * 2 if few else (blocks_of_day(F.col("min_date")), blocks_of_range(F.col("min_date"), F.col("max_date")))
    smaller, larger = ranges.select(*named("smaller"), F.inline(of_start)), ranges.select(*named("larger"), F.inline(of_range))
    if few:
        return _covering(smaller, larger, ["level", "at"])
    block = ["level", "at"]
    places, grid = (materialise(t, "pair-pieces") for t in _pieces(_ends(smaller, larger), piece))
    if grid.isEmpty():
        return _covering(smaller, larger, block)
    cut = grid.select(*block).distinct()
    light = _covering(smaller.join(cut, block, "left_anti"), larger.join(cut, block, "left_anti"), block)
    there = places.select(*(F.col(c).alias(f"_{c}") for c in places.columns))

    def in_pieces(rows: DataFrame, side: str, other: str, of_slice: str) -> DataFrame:
        """Rows of one side in all pieces of their slice. They are dealt by name, each deal to every one of the other side's."""
        here = (F.col("level") == F.col("_level")) & (F.col("at") == F.col("_at")) & (F.col(f"{side}_max_date") == F.col("_end"))
        met = rows.join(there, here).withColumn(of_slice, F.col("_slice")).join(grid, [*block, of_slice])
        dealt = F.pmod(F.xxhash64(f"{side}_file"), F.col(f"parts_{side}")).alias(f"deal_{side}")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"parts_{other}") - 1)).alias(f"deal_{other}")
        return met.select(*(f"{side}_{c}" for c in ("file", "min_date", "max_date")), *block, "low", "high", dealt, every)

    one, two = in_pieces(smaller, "smaller", "larger", "low"), in_pieces(larger, "larger", "smaller", "high")
    return light.unionAll(_covering(one, two, [*block, "low", "high", "deal_smaller", "deal_larger"]))


def _covering(smaller: DataFrame, larger: DataFrame, keys: list[str]) -> DataFrame:
    covers = (F.col("larger_max_date") >= F.col("smaller_max_date")) & (F.col("larger_min_date") <= F.col("smaller_min_date"))
    wider = (F.col("larger_min_date") < F.col("smaller_min_date")) | (F.col("larger_max_date") > F.col("smaller_max_date"))
    return (
        smaller.join(larger, keys)
        .where((F.col("smaller_file") != F.col("larger_file")) & covers)
        .where(wider | (F.col("smaller_file") < F.col("larger_file")))
        .select(*PAIR_COLUMNS)
    )


def contained_pairs(metadata: DataFrame) -> DataFrame:
    """:func:`containing_pairs` numbered by range and name. Runs a job (see :func:`with_ordinal`)."""
    order = ["smaller_min_date", "smaller_max_date", "smaller_file", "larger_min_date", "larger_max_date", "larger_file"]
    return with_ordinal(containing_pairs(metadata), order, "pair_id").select("pair_id", *PAIR_COLUMNS)


def daily_counts(parts: DataFrame, event_date: Column, pairs: DataFrame | None = None) -> DataFrame:
    """Rows per part and day, undated rows left out; with ``pairs``, of the paired parts only.

    The rows are counted before the join with the pairs, so only day counts meet it.
    """
    counts = (
        parts.select("part_file", event_date.alias("event_date"))
        .where(F.col("event_date").isNotNull())
        .groupBy("part_file", "event_date")
        .agg(F.count("*").alias("daily_count"))
    )
    if pairs is None:
        return counts
    paired = pairs.select(F.col("smaller_file").alias("part_file")).union(pairs.select("larger_file")).distinct()
    return counts.join(paired, "part_file", "left_semi")


def _days_with_rows(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """``pair_id, event_date, s, l``: days of the smaller range on which either part of a pair has rows, and how many."""
    days, none = counts.select("part_file", "event_date", "daily_count"), F.lit(0).cast("bigint")
    seen = []
    for side in ("smaller", "larger"):
        one = pairs.join(days.withColumnRenamed("part_file", f"{side}_file"), f"{side}_file")
        one = one.where(F.col("event_date").between(F.col("smaller_min_date"), F.col("smaller_max_date")))
        here, there = (F.col("daily_count"), none) if side == "smaller" else (none, F.col("daily_count"))
        seen.append(one.select("pair_id", "event_date", here.alias("s"), there.alias("l")))
    return seen[0].unionAll(seen[1]).groupBy("pair_id", "event_date").agg(F.sum("s").alias("s"), F.sum("l").alias("l"))


def daily_intervals(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """The smaller range of each pair as runs of days with equal counts: ``pair_id, from_date, to_date, smaller_daily_count,
    larger_daily_count``.

    A range costs as many rows as it has days with rows, and one for each stretch without, however long: days without
    rows on either side are one run. A window here spans the days of a pair that have rows.
    """
    day = lambda c, n: F.date_add(c, n)
    ordered = Window.partitionBy("pair_id").orderBy("event_date")
    ends = pairs.select("pair_id", "smaller_min_date", "smaller_max_date")
    rows = _days_with_rows(pairs, counts)
    # The day after the range stands for its end: a stretch without rows lies before each row of this table.
    rows = rows.unionAll(pairs.select("pair_id", day(F.col("smaller_max_date"), 1), F.lit(None).cast("bigint"), F.lit(None).cast("bigint")))
    placed = rows.withColumn("before", F.lag("event_date").over(ordered)).join(ends, "pair_id")
    gap_from = F.coalesce(day(F.col("before"), 1), F.col("smaller_min_date"))
    none = F.lit(0).cast("bigint")
    run = lambda first, last, s, l: F.struct(first.alias("from_date"), last.alias("to_date"), s.alias("s"), l.alias("l"))  # noqa: E731, E741
    gap = F.when(gap_from < F.col("event_date"), run(gap_from, day(F.col("event_date"), -1), none, none))
    own = F.when(F.col("s").isNotNull(), run(F.col("event_date"), F.col("event_date"), F.col("s"), F.col("l")))
    runs = placed.select("pair_id", F.inline(F.array_compact(F.array(gap, own))))
    # Neighbours with equal counts are one run.
    before = Window.partitionBy("pair_id").orderBy("from_date")
    changes = (F.lag("s").over(before).isNull() | (F.lag("s").over(before) != F.col("s")) | (F.lag("l").over(before) != F.col("l"))).cast("int")
    numbered = runs.withColumn("change", changes).withColumn("run", F.sum("change").over(before))
    merged = numbered.groupBy("pair_id", "run", "s", "l").agg(F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date"))
    return merged.select("pair_id", "from_date", "to_date", F.col("s").alias("smaller_daily_count"), F.col("l").alias("larger_daily_count"))


def _each_day(runs: DataFrame, first: str, last: str) -> DataFrame:
    """Runs of days written out, one row per day, also a long run by several tasks."""
    years = F.sequence(F.lit(0), F.floor(F.date_diff(last, first) / DAYS_PER_STEP).cast("int"))
    steps = spread(runs.withColumn("_step", F.explode(years)), "_step", *runs.columns)
    begin = F.date_add(F.col(first), F.col("_step") * DAYS_PER_STEP)
    days = F.sequence(begin, F.least(F.col(last), F.date_add(begin, DAYS_PER_STEP - 1)), F.expr("interval 1 day"))
    return steps.withColumn("event_date", F.explode(days)).drop("_step")


def date_spine(pairs: DataFrame) -> DataFrame:
    """One row per pair and day of the smaller range: for export; :func:`daily_intervals` is the form to work on."""
    return _each_day(pairs, "smaller_min_date", "smaller_max_date")


def daily_comparison(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Both parts' counts on every day of the smaller range; no rows count as zero. Runs of days are compared and then
    written out."""
    small, large = F.col("smaller_daily_count"), F.col("larger_daily_count")
    compared = daily_intervals(pairs, counts).withColumns({"count_difference": small - large, "daily_counts_match": small == large})
    days = _each_day(compared, "from_date", "to_date").drop("from_date", "to_date")
    return pairs.join(days, "pair_id").select(
        "pair_id", *PAIR_COLUMNS, "event_date", "smaller_daily_count", "larger_daily_count", "count_difference", "daily_counts_match"
    )


def pair_summary(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Per pair: days compared, matching and differing, records on each side, largest daily difference.

    Made from the days that have rows; all other days of the smaller range match, with none on either side, and are
    only counted. A range of thousands of years costs no more than its rows.
    """
    none = F.lit(0).cast("bigint")
    daily = _days_with_rows(pairs, counts)
    found = daily.groupBy("pair_id").agg(
        F.count_if(F.col("s") != F.col("l")).alias("differing"),
        F.sum("s").alias("s"),
        F.sum("l").alias("l"),
        F.max(F.abs(F.col("s") - F.col("l"))).alias("most"),
    )
    compared = (F.date_diff("smaller_max_date", "smaller_min_date") + 1).cast("bigint")
    zero = lambda c: F.coalesce(F.col(c), none)
    matching = F.col("days_compared") - zero("differing")
    return (
        pairs.join(found, "pair_id", "left")
        .withColumn("days_compared", compared)
        .select(
            "pair_id", *PAIR_COLUMNS, "days_compared",
            matching.alias("matching_days"),
            zero("differing").alias("differing_days"),
            (F.lit(100.0) * matching / F.col("days_compared")).alias("percent_days_matching"),
            zero("s").alias("smaller_records_in_range"),
            zero("l").alias("larger_records_in_range"),
            (zero("s") - zero("l")).alias("total_count_difference"),
            zero("most").alias("maximum_absolute_daily_difference"),
            (zero("differing") == 0).alias("all_daily_counts_match"),
        )
        .orderBy(F.desc("all_daily_counts_match"), F.desc("percent_days_matching"), "smaller_file", "pair_id")
    )


def coverage_contained_flag(metadata: DataFrame) -> DataFrame:
    """Each dated part with ``contained``: some other part covers its range (equal ranges flag both).

    No part is compared with another. A part is covered when, among ranges that begin no later, one
    reaches at least as far: a running maximum over start days says so. Days are first reduced to one row
    per start day, then to one row per year, so the only unpartitioned window spans years, of which a
    date type has 9,999 at most.
    """
    ranges = with_date_range(metadata)
    equal = ranges.groupBy("min_date", "max_date").agg(F.count("*").alias("_same"))
    days = equal.groupBy("min_date").agg(F.max("max_date").alias("_reach")).withColumn("_year", F.year("min_date"))
    before = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    years = days.groupBy("_year").agg(F.max("_reach").alias("_year_reach"))
    earlier_years = years.select("_year", F.max("_year_reach").over(before(Window.orderBy("_year"))).alias("_earlier_years"))
    earlier_days = F.max("_reach").over(before(Window.partitionBy("_year").orderBy("min_date")))
    reach = days.withColumn("_earlier_days", earlier_days).join(earlier_years, "_year").drop("_year")
    covered = (
        F.coalesce(F.greatest("_earlier_days", "_earlier_years") >= F.col("max_date"), F.lit(False))
        | (F.col("_reach") > F.col("max_date"))
        | (F.col("_same") > 1)
    )
    return (
        ranges.join(equal, ["min_date", "max_date"]).join(reach, "min_date")
        .select(*ranges.columns, covered.alias("contained"))
    )
