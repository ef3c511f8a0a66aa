"""A Merkle tree over the rows of a dataset, a proof for each row, and its check.

The place of a row among its source's rows comes from bitmaps, not from sorting rows. Ids are gathered into bitmaps of
64-bit words, empty words left out; each word knows how many rows stand before it, from a directory of popcounts of three
levels, so that no list of words of a whole source is ever in one task. A row's place is its word's count and the
number of bits below its own. Nodes are then made level by level: children meet in an array under the key of their
parent, each in its slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import materialise
from gridloom.operators.common import with_ordinal

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Words of a level of the directory under one entry of the level above, as bits.
LEVEL_BITS = 20


def digest(parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of an array of strings, one after the other."""
    return F.sha2(F.array_join(parts, ""), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of a row: each field as its length in bytes, a colon and the value, or as a dash if it is null."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(part(f) for f in fields)), 256)


def directory(words: DataFrame) -> DataFrame:
    """``words(tree, known, word, bits, n)`` with ``before``: the rows in earlier words of the tree. Each level counts inside
    one entry of the level above: at most 2^20 entries, few at the top."""
    up = lambda level: F.shiftright("word", LEVEL_BITS * level).alias(f"up{level}")
    table, keys = words.select("*", up(1), up(2)), ["tree", "known"]
    earlier = lambda parent, child: F.sum("n").over(Window.partitionBy(*parent).orderBy(*child).rowsBetween(Window.unboundedPreceding, -1))
    one = table.groupBy(*keys, "up1", "up2").agg(F.sum("n").alias("n"))
    two = one.groupBy(*keys, "up2").agg(F.sum("n").alias("n"))
    two = two.select(*keys, "up2", earlier(["tree"], ["known", "up2"]).alias("before2"))
    one = one.select(*keys, "up1", "up2", earlier([*keys, "up2"], ["up1"]).alias("before1"))
    table = table.withColumn("before0", earlier([*keys, "up1"], ["word"]))
    found = table.join(one.join(two, [*keys, "up2"]).drop("up2"), [*keys, "up1"])
    before = F.coalesce("before0", F.lit(0)) + F.coalesce("before1", F.lit(0)) + F.coalesce("before2", F.lit(0))
    return found.select(*keys, "word", "bits", "n", before.alias("before"))


def places(rows: DataFrame) -> DataFrame:
    """``rows(tree, known, at, leaf, copies, …)`` with ``rank``, from 0 in each tree by ``known`` and ``at``; a row for each copy.

    Rows of one ``at`` are told apart by leaf. Only the words in which rows share an id are put in order row by row.
    """
    rows = rows.withColumn("word", F.shiftright("at", 6))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    keys = ["tree", "known", "word"]
    words = materialise(rows.groupBy(*keys).agg(F.bit_or(bit).alias("bits"), F.sum("copies").alias("n")), "merkle-words")
    found = directory(words)
    single = F.col("n") == F.bit_count("bits")
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, CAST(at & 63 AS INT))"))
    alone = rows.join(found.where(single), keys).withColumn("rank", F.col("before") + below)
    inside = Window.partitionBy(*keys).orderBy("at", "leaf").rowsBetween(Window.unboundedPreceding, -1)
    shared = rows.join(found.where(~single), keys).withColumn("first", F.col("before") + F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    shared = shared.select("*", F.explode(F.expr("sequence(first, first + copies - 1)")).alias("rank")).drop("first")
    return alone.unionByName(shared).drop(*keys[1:], "bits", "n", "before", "at", "copies")


def levels_of(most: int) -> int:
    """How many times runs of ``FANOUT`` are made from ``most`` nodes until one is left."""
    n = 0
    while most > 1:
        most, n = -(-most // FANOUT), n + 1
    return n


def left_over(level: int) -> Column:
    """Nodes of a tree of ``size`` leaves on a level."""
    return F.expr(f"(size + {FANOUT**level - 1}L) div {FANOUT**level}L")


def build(nodes: DataFrame, most: int, carried: Sequence[str], label: str) -> list[DataFrame]:
    """The levels of trees from ``nodes(tree, size, rank, hash, …)``: ``(tree, size, rank, hash, slots)``, the lowest first.
    Its slots hold the ``carried`` columns as well. A tree of one node passes through unchanged."""
    out = []
    for level in range(max(1, levels_of(most))):
        keyed = nodes.select("tree", "size", F.expr(f"rank div {FANOUT}").alias("rank"), F.struct(F.expr(f"rank % {FANOUT}").alias("slot"), "hash", *(carried if level == 0 else [])).alias("entry"))
        slots = keyed.groupBy("tree", "size", "rank").agg(F.array_sort(F.collect_list("entry")).alias("slots"))
        parent = F.when(left_over(level) > 1, digest(F.col("slots.hash"))).otherwise(F.col("slots")[0]["hash"])
        nodes = materialise(slots.withColumn("hash", parent), f"merkle-{label}-{level}")
        out.append(nodes)
    return out


def descend(levels: Sequence[DataFrame], top: DataFrame) -> DataFrame:
    """Every leaf of trees with the way up: ``top(tree, path, …)`` gives the way from a tree's root on. A step of ``path``
    has the siblings to the ``left`` and to the ``right``, joined; the first step is the leaf's own."""
    kept = [c for c in top.columns if c not in ("tree", "path")]
    above = top.withColumn("rank", F.lit(0).cast("bigint"))
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level].select("tree", "size", "rank", "slots").join(above, ["tree", "rank"])
        child = nodes.select("tree", "size", "rank", "path", *kept, "slots", F.posexplode("slots").alias("i", "entry"))
        side = lambda start, length: F.array_join(F.slice("slots.hash", start, length), "")
        step = F.array(F.struct(side(F.lit(1), F.col("i")).alias("left"), side(F.col("i") + 2, F.lit(FANOUT)).alias("right")))
        path = F.when(left_over(level) > 1, F.concat(step, "path")).otherwise(F.col("path")).alias("path")
        above = child.select("tree", (F.col("rank") * FANOUT + F.col("entry.slot")).alias("rank"), path, *kept, "entry")
        if level:
            above = above.drop("entry")
    return above


def proof(path: Column) -> Column:
    """Hash of all siblings on a path, from the leaf to the root."""
    return digest(F.transform(path, lambda step: F.concat(step["left"], step["right"])))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings on its path."""
    return F.aggregate(path, start, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, other: Sequence[Column] | None = None, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``leaf``, ``other``, ``subroot``, ``root``, ``path``.

    A source's leaves stand by ``doc_id``; runs of 16 nodes become one until one is left, the source's subroot; subroots, by
    source, become the root in the same way. ``other`` is the leaf with ``other`` fields in place of ``fields``, for checks of what
    a change does; without them it is the leaf.

    Rows with a null doc_id come first, by leaf; rows that repeat an id follow each other by leaf; rows equal in all fields
    each have a place of their own. A null source is a source, before all others. No rows give no rows; a single row is
    its own subroot and root. Columns not named are ignored, whatever their names.
    """
    columns = [F.col(c) for c in fields]
    base = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"),
        leaf(columns).alias("leaf"), leaf(list(other) if other else columns).alias("other"),
    )
    rows = materialise(base.groupBy("doc_id", "source", "leaf", "other").agg(F.count("*").alias("copies")), "merkle-leaves")
    sources = with_ordinal(rows.groupBy("source").agg(F.sum("copies").alias("size")), ["source"], "tree")
    sources = materialise(sources, "merkle-sources")
    count, most = sources.agg(F.count("*"), F.max("size")).first()

    own = rows.join(sources.withColumnRenamed("source", "_own"), F.col("source").eqNullSafe(F.col("_own"))).drop("_own")
    known = F.col("doc_id").isNotNull()
    at = F.coalesce("doc_id", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("bigint"))
    placed = places(own.select("tree", "size", "doc_id", "leaf", "other", "copies", known.alias("known"), at.alias("at")))
    trees = build(placed.withColumnRenamed("leaf", "hash"), most or 1, ["doc_id", "other"], "tree")

    roots = trees[-1].select(F.lit(0).alias("all"), F.col("tree"), "hash").join(sources, "tree")
    top = build(roots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(count).cast("bigint").alias("size"), (F.col("tree") - 1).alias("rank"), "hash", "source"), count, ["source"], "top")
    start = top[-1].select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("hash").alias("root"))
    down = descend(top, start)
    down = down.select((F.col("rank") + 1).alias("tree"), "path", "root", F.col("entry.source").alias("source"), F.col("entry.hash").alias("subroot"))
    return descend(trees, down).select("entry.doc_id", "source", F.col("entry.hash").alias("leaf"), "entry.other", "subroot", "root", "path")
