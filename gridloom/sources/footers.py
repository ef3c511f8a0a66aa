"""Row counts taken from the footers of parquet files, without reading a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridloom.operators.common import CheckFailed
from gridloom.sources.published import RUN, current, run_folders

#: What makes Spark read parquet by its second interface, which hands counts down to the files' footers.
SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def counting_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts come from footers. Others keep their settings; frames of two
    sessions must not be joined."""
    if all(spark.conf.get(key) == value for key, value in SETTINGS.items()):
        return spark
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session


def footer_counts(spark: SparkSession, path: str, by: Sequence[str] = (), runs: Sequence[str] | None = None) -> DataFrame:
    """Rows under ``path``, or by all its partition columns ``by``, as ``n_rows``; with ``runs``, of those runs of a published table.

    Only footers are opened. Their counts are handed on by partition, so no other columns can be asked for.
    """
    session = counting_session(spark)
    columns = [*([RUN] if runs is not None else []), *by]
    reader = session.read.schema(StructType([StructField(c, StringType()) for c in columns])) if columns else session.read
    rows = reader.option("basePath", path).parquet(*(run_folders(path, runs) if runs is not None else [path]))
    if not by:
        return rows.agg(F.count(F.lit(1)).alias("n_rows"))
    counts = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts if runs is None else counts.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"))


def published_counts(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """:func:`footer_counts` of the present version of a published table."""
    found = current(spark, path)
    if found is None:
        raise CheckFailed(f"Nothing is published at {path}.")
    return footer_counts(spark, path, by, found.runs)
