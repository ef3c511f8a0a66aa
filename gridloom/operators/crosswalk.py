"""Variant column names mapped onto canonical ones. Rules are data: ``clean_column, canonical_name``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.common import first_names, sorted_join
from gridloom.operators.grid import SHEET


def rules_frame(spark: SparkSession, rules: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Rules written as ``canonical -> variants`` as a two-column frame, a literal table of known size."""
    pairs = [(variant, canonical) for canonical, variants in rules.items() for variant in variants]
    if not pairs:
        return spark.range(0).select(F.lit("").alias("clean_column"), F.lit("").alias("canonical_name"))
    rows = [F.struct(F.lit(variant).alias("clean_column"), F.lit(canonical).alias("canonical_name")) for variant, canonical in pairs]
    return spark.range(1).select(F.inline(F.array(*rows)))


def distinct_columns(inventory: DataFrame, examples: int = 5) -> DataFrame:
    """Per (clean, raw) name: number of files using it and the first few file names."""
    keys = ["clean_column", "raw_column"]
    uses = inventory.select(*keys, "file_name").distinct()
    counts = uses.groupBy(*keys).agg(F.count("*").alias("n_files"))
    return counts.join(first_names(uses, keys, "file_name", examples, "example_files"), keys)


def crosswalk_apply(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """``columns`` with its canonical name: by rule, else the clean name itself."""
    mapped = columns.join(rules, "clean_column", "left")
    return mapped.withColumn("canonical_name", F.coalesce("canonical_name", "clean_column"))


def crosswalk_lost(columns: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Columns of the inventory that the crosswalk does not list."""
    return columns.join(crosswalk, ["clean_column", "raw_column"], "left_anti")


def crosswalk_collapsed(crosswalk: DataFrame) -> DataFrame:
    """Canonical names fed by more than one clean name."""
    return (
        crosswalk.select("canonical_name", "clean_column").distinct()
        .groupBy("canonical_name")
        .agg(F.count("*").alias("n_source_columns"), sorted_join("clean_column").alias("source_columns"))
        .where(F.col("n_source_columns") > 1)
        .orderBy(F.desc("n_source_columns"), "canonical_name")
    )


def crosswalk_conflicts(inventory: DataFrame, rules: DataFrame) -> DataFrame:
    """Sheets in which two or more columns would take the same canonical name."""
    return (
        crosswalk_apply(inventory.select(*SHEET, "clean_column").distinct(), rules)
        .groupBy(*SHEET, "canonical_name")
        .agg(sorted_join("clean_column").alias("source_columns"), F.count("*").alias("n_columns"))
        .where(F.col("n_columns") > 1)
    )
