"""Writers. Tables are published by version; parts and delimited text go to plain folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.sources.published import Manifest, publish


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", profile: bool = False) -> Manifest:
    """Snappy parquet, published as the table's next version (see :mod:`gridloom.sources.published`): a write that fails, or is
    still going on, leaves readers the version before. ``mode`` ``append`` adds to that version; ``profile`` keeps the number
    of values of each column with the manifest.

    Partition folders are written by whichever task holds their rows: no shuffle, and a part with much of the
    data stays spread over tasks.
    """
    return publish(df, path, partition_by, append=mode == "append", profile=profile)


def sink_parts(df: DataFrame, path: str, replace_all: bool = False) -> None:
    """Parts under ``part_file=...`` folders; building a part again replaces that part alone, ``replace_all`` removes all
    others. Rows are brought together by part first, so a part is a few files however many tasks held it, and one
    with much of the data is still written by several."""
    (
        df.hint("rebalance", F.col("part_file"))
        .write.option("compression", "snappy")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .mode("overwrite")
        .partitionBy("part_file")
        .parquet(path)
    )


def sink_csv(df: DataFrame, path: str, missing: str = "", mode: str = "overwrite") -> None:
    """Delimited text with a header, quotes doubled; missing values as ``missing``, empty text quoted."""
    writer = df.write.option("header", "true").option("escape", '"').option("emptyValue", '""')
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    writer.option("nullValue", missing).mode(mode).csv(path)
