"""Plan helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.common import materialise
from gridloom.session import ensure_checkpoint_dir


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package when it is run from its source folder, wherever the driver was started.
    On a cluster without that folder the package comes with the job, as by ``--py-files``."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_table(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """A few constant rows as a table, without Python on the executors."""
    structs = [F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names, strict=True))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def total(columns: Sequence[Column]) -> Column:
    """Sum of several columns."""
    out = columns[0]
    for column in columns[1:]:
        out = out + column
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` mentions it, also within lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def by_size(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of about ``most`` bytes of ``column``, so that a task's working memory does not
    follow the length of texts times Arrow's rows per batch. A slice holds one row at least; none is left out."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` of sorted batches, each as a table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            piece = batch.slice(start, stop - start)
            if held and held[0].column(key)[0].as_py() != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected ``edges``: one row ``(node, component)`` per node, ``component`` the smallest
    node it can reach. Nodes and edges stay distributed.

    Alternating large-star and small-star steps: each is one aggregation by node and one join; the number of
    rounds grows with the logarithm of a component's size. A hub's edges never meet in one task: minima are combined
    before the shuffle and the join on the hub is an ordinary one, which adaptive execution splits. Each round is
    checkpointed; the work ends when a round changes nothing.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    sums = None
    while True:
        row = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if row == sums or not row[0]:
            break
        sums = row
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        both = links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        links = large.join(least, "u").select(F.inline(ends)).where("u <> v").distinct().checkpoint()
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def merged(rooted: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``rooted(node, component)`` after more ``links(a, b)``: only the components that these join are worked on."""
    links = links.distinct().checkpoint()
    own = lambda name: rooted.select(F.col("node").alias(name), F.col("component").alias(f"root_{name}"))
    joined = links.join(own("a"), "a", "left").join(own("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    moved = components(joined, "a", "b").select(F.col("node").alias("component"), F.col("component").alias("to"))
    new = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(rooted, "node", "left_anti")
    every = rooted.union(new.select("node", F.col("node").alias("component")))
    return every.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))


__all__ = ["by_size", "components", "ensure_checkpoint_dir", "groups_of", "importable", "let", "literal_table", "materialise", "merged", "table", "total"]
