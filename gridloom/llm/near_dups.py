"""Near duplicates by a multi-index Hamming join of MinHash signatures.

Two texts whose shingle sets have at least the wanted similarity differ in few symbols of their signatures: the
threshold is the smallest number that such a pair exceeds with a chance below one in a thousand million. A signature
is cut into more chunks than half that number, so that by the pigeonhole principle one chunk of the pair differs in one
symbol at most; every chunk is looked up once for each symbol left out. All pairs within the threshold meet in a
bucket; whether they are similar is then decided on their full sets.

A bucket's members are not paired with each other straight away. Each is first checked against one of them, the bucket's
pivot; only where members of a bucket are not yet connected, through whatever links were confirmed, are the pairs
between different components gone through, in blocks of bounded size and inside a task: pairs are never rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm import shingles
from gridloom.llm.common import by_size, components, groups_of, materialise, merged

#: Bytes of text shingled at once.
BLOCK_BYTES = 2 << 20
#: Members of a bucket, or sets, that are compared with as many others in one piece of work.
BLOCK = 1024
SETS = 256
#: Shingles of all sets that a piece of a bucket holds.
SHINGLES = 2_000_000


@dataclass(frozen=True)
class Rule:
    """Texts are linked if ``100 * |A and B| >= percent * |A or B|`` on sets of shingles of ``width`` words."""

    percent: int = 80
    width: int = shingles.WIDTH
    symbols: int = 96
    miss: float = 1e-9

    @cached_property
    def threshold(self) -> int:
        """Smallest number of differing symbols that a pair just similar enough exceeds with a chance below ``miss``."""
        n, p = self.symbols, 1 - self.percent / 100
        within, d = 0.0, -1
        while 1 - within >= self.miss and d < n:
            d += 1
            within += math.comb(n, d) * p**d * (1 - p) ** (n - d)
        return d

    @cached_property
    def chunks(self) -> list[np.ndarray]:
        """So many chunks that a pair within the threshold has one with at most one differing symbol."""
        return np.array_split(np.arange(self.symbols), self.threshold // 2 + 1)

    @cached_property
    def masks(self) -> list[tuple[int, np.ndarray]]:
        """For each lookup its chunk and the symbols it reads: the chunk without one of its symbols."""
        return [(c, chunk[chunk != left]) for c, chunk in enumerate(self.chunks) for left in chunk]

    @cached_property
    def first_mask(self) -> np.ndarray:
        """Of each chunk, the number of its first lookup."""
        return np.cumsum([0] + [len(c) for c in self.chunks[:-1]])

    def links(self, common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int):
        return (100 * common >= self.percent * (a + b - common)) & (common > 0)


def sign(docs: DataFrame, rule: Rule, text: str, doc_id: str) -> DataFrame:
    """One row ``(doc_id, text_hash, n_shingles, node, signature)`` per document; ``node`` names its set, null if that is empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, "text", BLOCK_BYTES):
            values, counts = shingles.shingle_sets(part.column("text"), rule.width)
            nodes, empty = shingles.set_nodes(values, counts).view(np.int64), counts == 0
            signatures = shingles.minhash(values, counts, rule.symbols)
            packed = pa.array([None if e else s.tobytes() for s, e in zip(signatures, empty, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("hash"), pa.array(counts.astype(np.int64)), pa.array(nodes, mask=empty), packed],
                ["doc_id", "text_hash", "n_shingles", "node", "signature"],
            )

    columns = docs.select(F.col(doc_id).cast("bigint").alias("id"), text_hash(F.col(text)).alias("hash"), F.col(text).alias("text"))
    return columns.mapInArrow(work, "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, signature binary")


def text_hash(text: Column) -> Column:
    """Tells rows apart that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def matrix(column: pa.Array, symbols: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), symbols)


def lookups(sets: DataFrame, rule: Rule) -> DataFrame:
    """``(lookup, bucket, node)``: the buckets of each set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sig = batch.column("node"), matrix(batch.column("signature"), rule.symbols).astype(np.uint64)
            for number, (_, read) in enumerate(rule.masks):
                value = np.full(len(sig), number + 1, np.uint64)
                for k in read:
                    value = shingles.mix((value * shingles.PRIME) ^ sig[:, k])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), number, np.int16)), pa.array(value.view(np.int64)), nodes], ["lookup", "bucket", "node"])

    return sets.select("node", "signature").mapInArrow(work, "lookup smallint, bucket bigint, node bigint")


def close_enough(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures are within the threshold and whose set sizes allow the similarity."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance = (matrix(batch.column("s_a"), rule.symbols) != matrix(batch.column("s_b"), rule.symbols)).sum(1)
            yield batch.select(["a", "b"]).filter(pa.array(distance <= rule.threshold))

    fits = 100 * F.least("n_a", "n_b") >= rule.percent * F.greatest("n_a", "n_b")
    return pairs.join(side("a"), "a").join(side("b"), "b").where(fits).mapInArrow(work, "a bigint, b bigint")


def full_sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, rule: Rule, text: str, doc_id: str) -> DataFrame:
    """``(node, members)``: the full sets of ``wanted(node)``, cut anew from the text of one document each."""
    wanted = wanted.join(nodes.select("node", F.col("min_id").alias("_id")), "node").select("_id", F.col("node").alias("_node"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for part in by_size(batches, text, BLOCK_BYTES):
            values, counts = shingles.shingle_sets(part.column(text), rule.width)
            # Rows that repeat an id meet in one task, sorted; of equal ones the first is taken.
            same = shingles.set_nodes(values, counts).view(np.int64) == part.column("_node").to_numpy()
            for i in np.flatnonzero(same):
                same[i] = (name := part.column("_node")[int(i)].as_py()) not in done
                done.add(name)
            ends = np.cumsum(counts)
            sets = [values[e - c : e].tobytes() for e, c, s in zip(ends, counts, same, strict=True) if s]
            yield pa.RecordBatch.from_arrays([part.column("_node").filter(pa.array(same)), pa.array(sets, pa.binary())], ["node", "members"])

    # At any size that matters there are too many to broadcast; joined by merging, small inputs cost what large ones do.
    texts = docs.select(F.col(doc_id).cast("bigint").alias("_id"), text).join(wanted.hint("merge"), "_id").select("_node", text)
    return materialise(texts.mapInArrow(shingle, "node bigint, members binary"), "near-sets")


def confirm(pairs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Links ``(a, b)`` among ``pairs(piece, a, b)``, decided on full sets. ``piece`` names groups of pairs that have few
    sets among them: each set is sent to a group once, and a task holds the sets of one group at a time."""
    needs = pairs.select("piece", F.explode(F.array("a", "b")).alias("node")).distinct()
    nothing = F.lit(None).cast("bigint")
    rows = needs.join(members, "node").select("piece", F.lit(0).alias("kind"), F.col("node").alias("a"), nothing.alias("b"), "members")
    rows = rows.union(pairs.select("piece", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("members")))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, sets = None, {}
        for batch in batches:
            found = []
            for p, kind, a, b, data in zip(*(batch.column(c).to_pylist() for c in ("piece", "kind", "a", "b", "members")), strict=True):
                if p != piece:
                    piece, sets = p, {}
                if kind == 0:
                    sets[a] = np.frombuffer(data, np.uint64)
                    continue
                one, two = sets[a], sets[b]
                if rule.links(len(np.intersect1d(one, two, assume_unique=True)), len(one), len(two)):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "piece").sortWithinPartitions("piece", "kind").mapInArrow(check, "a bigint, b bigint")


def near_pairs(group: pa.Table, rule: Rule, differ) -> Iterator[tuple[int, np.ndarray]]:
    """Of a piece of a bucket, each member on the left with those on the right that ``differ`` tells from it, whose size
    and signature allow the similarity, and for whom this is the first of the buckets in which both meet."""
    node, n, lookup = group.column("node").to_numpy(), group.column("n_shingles").to_numpy(), group.column("lookup")[0].as_py()
    sig = matrix(group.column("signature").combine_chunks(), rule.symbols)
    left, right = (np.flatnonzero(group.column(c).to_numpy()) for c in ("left", "right"))
    same = group.column("same")[0].as_py()
    for i in left:
        j = right[differ(i, right) & ((node[right] > node[i]) if same else True)]
        j = j[100 * np.minimum(n[j], n[i]) >= rule.percent * np.maximum(n[j], n[i])]
        differs = sig[j] != sig[i]
        near = differs.sum(1) <= rule.threshold
        j, differs = j[near], differs[near]
        if not len(j):
            continue
        errors = np.add.reduceat(differs, rule.first_mask, axis=1, dtype=np.int64)
        chunk = np.argmax(errors <= 1, axis=1)
        # The lookup that leaves out the one differing symbol of the first such chunk, or its first symbol.
        inside = np.where(np.arange(rule.symbols) >= rule.first_mask[chunk][:, None], differs, False)
        place = np.where(errors[np.arange(len(j)), chunk] == 1, np.argmax(inside, axis=1), rule.first_mask[chunk])
        yield i, j[place == lookup]


PIECE = "piece bigint, lookup smallint, node bigint, root bigint, left boolean, right boolean, same boolean, n_shingles bigint, signature binary"


def undecided(rows: DataFrame, rule: Rule) -> DataFrame:
    """Of ``rows(PIECE)``, the members of pieces of buckets that have a pair to be checked there: two of different components
    within the threshold. Members, not pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "piece"):
            root, wanted = group.column("root").to_numpy(), np.zeros(len(group), bool)
            for i, j in near_pairs(group, rule, lambda i, right: root[right] != root[i]):  # noqa: B023
                wanted[j] = True
                wanted[i] |= len(j) > 0
            yield from group.filter(pa.array(wanted)).to_batches()

    return rows.mapInArrow(work, PIECE)


def settle(rows: DataFrame, rule: Rule) -> DataFrame:
    """Links ``(a, b)`` between components, from ``rows(PIECE)`` and ``members``, decided on full sets. A piece's pairs are
    gone through one by one; those that links found before have connected are passed over."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "piece"):
            node, root = group.column("node").to_numpy(), group.column("root").to_numpy().copy()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("members").to_pylist()]
            found = []
            for i, near in near_pairs(group, rule, lambda i, right: root[right] != root[i]):  # noqa: B023
                for j in near:
                    if root[i] != root[j] and rule.links(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), len(sets[i]), len(sets[j])):
                        found.append((node[i], node[j]))
                        root[root == root[j]] = root[i]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.mapInArrow(work, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, rule: Rule | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` (size of its set), ``component_id`` (smallest doc_id it can
    reach through links, itself included), ``kept`` (``doc_id = component_id``), and ``cluster`` and ``text_hash``, names of its component (null for an empty set) and text.

    A text of fewer words than a shingle has its whole sequence as one; a null text, or one without words, has an empty
    set and is linked with nothing. Rows of equal sets are linked and worked on as one. Rows that repeat a doc_id get
    a row each, judged by their own text. A row with a null doc_id links nothing, its component is null and it is kept.
    Columns other than the two named are ignored.

    Texts are read twice and are shuffled only if the sets to be confirmed are too many to be broadcast by Spark's own
    threshold. Sets are named by 64-bit hashes.
    """
    rule = rule or Rule()
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = materialise(sign(docs, rule, text, doc_id), "near-signed")
    own = signed.where("node IS NOT NULL AND doc_id IS NOT NULL")
    sets = materialise(own.groupBy("node").agg(F.min("doc_id").alias("min_id"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")), "near-sets")

    # All buckets choose their pivot by one order, so that a group of near copies meets few pivots in all its buckets.
    bucket = Window.partitionBy("bucket", "lookup").orderBy(F.xxhash64("node"), "node")
    met = lookups(sets, rule).select("bucket", "lookup", "node", F.first("node").over(bucket).alias("pivot"))
    met = materialise(met.where("pivot <> node"), "near-met")

    # Every member of a bucket against its pivot.
    stars = met.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = materialise(close_enough(stars, sets, rule), "near-stars")
    many = stars.groupBy("a").agg(F.ceil(F.count("*") / SETS).alias("parts"))
    stars = stars.join(many, "a").select(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts"))).alias("piece"), "a", "b")
    starred = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    rooted = components(confirm(stars, full_sets(starred, docs, sets, rule, text, doc_id), rule), "a", "b")

    # Buckets that still hold several components, other than through the pivot that all were checked against.
    others = met.join(rooted, "node", "left").select("bucket", "lookup", "node", F.coalesce("component", "node").alias("root"))
    others = others.join(sets.select("node", "n_shingles"), "node")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / SHINGLES)).cast("int")
    mixed = others.groupBy("bucket", "lookup").agg(F.min("root").alias("least"), F.max("root").alias("most"), parts.alias("parts"))
    placed = others.join(mixed.where("least < most").drop("least", "most"), ["bucket", "lookup"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    pieces = placed.select(
        F.xxhash64("bucket", "lookup", low, high).alias("piece"), "lookup", "node", "root",
        (F.col("part") == low).alias("left"), (F.col("part") == high).alias("right"), (low == high).alias("same"), "n_shingles",
    ).join(sets.select("node", "signature"), "node").select("piece", "lookup", "node", "root", "left", "right", "same", "n_shingles", "signature")
    rows = materialise(undecided(pieces.repartition(n, "piece").sortWithinPartitions("piece"), rule), "near-rows")
    members = full_sets(rows.select("node").distinct(), docs, sets, rule, text, doc_id)
    links = settle(rows.join(members, "node").repartition(n, "piece").sortWithinPartitions("piece"), rule)
    rooted = merged(rooted, links)

    least = rooted.join(sets.select("node", "min_id"), "node").groupBy("component").agg(F.min("min_id").alias("root_id"))
    moved = rooted.join(least, "component").select("node", "root_id", "component")
    named = sets.select("node", "min_id").join(moved, "node", "left")
    named = named.select("node", F.coalesce("root_id", "min_id").alias("root_id"), F.coalesce("component", "node").alias("cluster"))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.coalesce("root_id", "doc_id"))
    out = signed.select("doc_id", "n_shingles", "node", "text_hash").join(named, "node", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "cluster", "text_hash")
