"""Readers: parts with differing columns, projected tables, delimited benchmark releases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from gridloom.sources.delimited import scan_releases
from gridloom.sources.published import current, read_published


def scan_parts_union_by_name(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All parts under ``path`` as one frame, matched by column name, missing columns NULL.

    Parts that were published have their schema in the manifest: no file is opened to find it. Of others, given the
    canonical ``columns`` (all text) none is either; without them Spark merges the footers' schemas in a distributed job.
    """
    if current(spark, path) is not None:
        return read_published(spark, path, columns)
    if columns is not None:
        return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def scan_projected(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns leave the files."""
    return spark.read.parquet(path).select(*columns)


# Stands for "nothing at all" while reading, so that it differs from quoted empty text.
NOTHING = "\u0001"

# A quoted value may hold line breaks, and spaces belong to it. Files are read whole here, so work splits by file.
FAITHFUL = {"header": "true", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema, missing: str = "") -> DataFrame:
    """Delimited text with a header and a known schema, as written by ``sink_csv`` with the same ``missing``.

    With the default, ``""`` is empty text and nothing between two commas is a missing value.
    """
    reader = spark.read.schema(schema).options(**FAITHFUL)
    return reader.option("nullValue", missing or NOTHING).csv(path)


def csv_scan_typed(
    spark: SparkSession,
    releases: Sequence[tuple[str, str, str]],
    required: Mapping[str, str],
    converters: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Delimited releases ``(id, release date, path)`` stacked by name and tagged with id and date, in one scan of all of them.

    Large files are split by bytes, also where quoted values hold line breaks (see :mod:`gridloom.sources.delimited`). Every
    column is read as text, so types do not depend on a guess from the data. ``required`` maps header names to result
    names; a file that lacks one raises. ``converters`` override result columns.
    """
    return scan_releases(spark, releases, required).withColumns(dict(converters or {}))
