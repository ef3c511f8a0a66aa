"""Small plan helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import ensure_checkpoint_dir, scratch_path

PROVENANCE = ("source_file", "source_sheet")


class CheckFailed(ValueError):
    """A hard check on the data did not hold."""


def require_empty(df: DataFrame, message: str) -> None:
    """Raise with a few example rows when ``df`` has any row. Runs a job that stops at the first rows."""
    rows = df.take(5)
    if rows:
        raise CheckFailed(f"{message} Examples: {[row.asDict() for row in rows]}")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter is pushed below the shuffle as a per-task limit, so each task sends at most one row
    per key however often a key is repeated.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows hashed by ``keys`` over the session's full number of shuffle partitions.

    For few small rows that are about to multiply: adaptive execution sizes partitions by the bytes it
    sees before they do and would leave them all to one task, unless the number is given.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back. Runs a job.

    For tables that are small next to the rows they will be joined with. A written table has a known
    size, so Spark decides between broadcasting it and a sort-merge join before it plans any shuffle of
    the large side; the size of a frame still to be computed is a guess.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_ordinal(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Number all rows 1, 2, 3, ... in ``order`` without bringing them into one task.

    Rows are range-partitioned and sorted, and each partition's size is added up to give the number at
    which the next one starts; only that list of sizes, one row per partition, meets in one task. The
    sorted rows are checkpointed so that both uses see the same partitions even when executors are lost.
    Runs a job. ``order`` must identify a row for the numbering to be repeatable.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.orderBy(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    starts = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_start"),
    )
    return (
        placed.join(F.broadcast(starts), "_part")  # one row per partition of the sort
        .withColumn(name, F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
        .drop("_part", "_place", "_start")
    )


def first_names(df: DataFrame, keys: Sequence[str], column: str, n: int, name: str, separator: str = " | ") -> DataFrame:
    """Per key, the ``n`` smallest values of ``column`` joined; ``df`` holds each (key, value) once.

    Only ``n`` values per key leave a task, so a key found everywhere costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(column)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= n)
        .groupBy(*keys)
        .agg(F.array_join(F.array_sort(F.collect_list(column)), separator).alias(name))
    )


def sorted_join(column: str | Column, separator: str = " | ") -> Column:
    """Aggregate: the distinct values of a group, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)
