"""Comparison of two releases of the same records, row by row and column by column.

Everything rests on :func:`row_counts`: both releases are grouped together by the compared columns and
their copies counted. Grouping treats NULL as equal to NULL, combines copies before the shuffle (so a row
repeated a billion times travels once per task), and needs one shuffle where joins would need two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import has_data
from gridloom.operators.common import PROVENANCE, CheckFailed, spread

COPIES_PER_STEP = 4096


def _populated(df: DataFrame) -> DataFrame:
    """``column, has_data`` of every column but provenance; one aggregation, schema-sized output."""
    columns = [c for c in df.columns if c not in PROVENANCE and c != "part_file"]
    flags = df.agg(*[F.bool_or(has_data(F.col(c).cast("string"))).alias(c) for c in columns])
    return flags.unpivot([], columns, "column", "has_data").where("has_data")


def pair_shared_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns populated in both releases."""
    return _populated(a).select("column").join(_populated(b), "column", "left_semi")


def pair_columns_only(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns populated in one release alone: ``column, side``."""
    in_a, in_b = _populated(a), _populated(b)
    only_a = in_a.join(in_b, "column", "left_anti").select("column", F.lit("a").alias("side"))
    only_b = in_b.join(in_a, "column", "left_anti").select("column", F.lit("b").alias("side"))
    return only_a.unionByName(only_b)


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Names of the shared columns, in the order of ``a``. Runs a job that returns names only."""
    names = {row["column"] for row in pair_shared_columns(a, b).collect()}
    if not names:
        raise CheckFailed("The two releases have no shared populated columns to compare.")
    return [c for c in a.columns if c in names]


def row_counts(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each distinct row over ``columns`` with its number of copies in A and in B."""
    side = lambda df, in_a, in_b: df.select(*columns, F.lit(in_a).alias("_a"), F.lit(in_b).alias("_b"))
    both = side(a, 1, 0).unionByName(side(b, 0, 1))
    return both.groupBy(*columns).agg(F.sum("_a").alias("copies_a"), F.sum("_b").alias("copies_b"))


def _repeat(df: DataFrame, copies: str) -> DataFrame:
    """Each row as many times as ``copies`` says, in two steps so that no task writes out all copies of a row."""
    step = F.lit(COPIES_PER_STEP)
    steps = df.withColumn("_step", F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / step))))
    placed = spread(steps, "_step", *[c for c in df.columns if c != copies])
    here = F.least(step, F.col(copies) - F.col("_step") * step)
    return placed.withColumn("_copy", F.explode(F.sequence(F.lit(1), here.cast("int")))).drop("_step", "_copy", copies)


def rows_only_in_a(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of A with no equal row in B over ``columns``; NULL equals NULL, copies are kept."""
    alone = row_counts(a, b, columns).where("copies_b = 0").drop("copies_b")
    return _repeat(alone, "copies_a")


def rows_only_in_b(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    alone = row_counts(a, b, columns).where("copies_a = 0").drop("copies_a")
    return _repeat(alone, "copies_b")


def pair_match_summary(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sizes of both releases, rows found on one side alone, rows of A that match."""
    only = lambda c, other: F.coalesce(F.sum(F.when(F.col(other) == 0, F.col(c))), F.lit(0))
    return (
        row_counts(a, b, columns)
        .agg(
            F.coalesce(F.sum("copies_a"), F.lit(0)).alias("rows_a"),
            F.coalesce(F.sum("copies_b"), F.lit(0)).alias("rows_b"),
            only("copies_a", "copies_b").alias("only_in_a"),
            only("copies_b", "copies_a").alias("only_in_b"),
        )
        .withColumn("matching_a", F.col("rows_a") - F.col("only_in_a"))
        .withColumn("all_match", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0))
    )


def pair_value_diff(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Among unmatched rows, per column: distinct values on one side alone, and whether the sets agree."""
    alone = row_counts(a, b, columns).where("copies_a = 0 or copies_b = 0")
    text = alone.select(*[F.col(c).cast("string").alias(c) for c in columns], (F.col("copies_a") > 0).alias("_in_a"))
    values = text.unpivot(["_in_a"], list(columns), "column", "value")
    present: Column = F.col("value").isNotNull()
    sides = values.groupBy("column", "value").agg(
        F.bool_or(present & F.col("_in_a")).alias("in_a"), F.bool_or(present & ~F.col("_in_a")).alias("in_b")
    )
    return (
        sides.groupBy("column")
        .agg(
            F.count_if(F.col("in_a") & ~F.col("in_b")).alias("values_only_in_a"),
            F.count_if(F.col("in_b") & ~F.col("in_a")).alias("values_only_in_b"),
        )
        .withColumn("identical_unique_values", (F.col("values_only_in_a") == 0) & (F.col("values_only_in_b") == 0))
    )


def pair_multiset_equal(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whether both releases hold every row the same number of times."""
    differing = F.count_if(F.col("copies_a") != F.col("copies_b"))
    return row_counts(a, b, columns).agg(differing.alias("differing_rows")).withColumn("identical", F.col("differing_rows") == 0)
