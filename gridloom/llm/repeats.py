"""Passages that occur before, byte by byte, by sorting the suffixes at sampled places.

Every window of ``length`` bytes has an anchor: the place in it whose next ``anchor`` bytes have the least hash. Equal windows
have equal anchors, so windows are compared only around anchors that occur more than once. Consecutive windows with one
anchor are a segment; equal segments are represented by their first. Those of one anchor are put in order twice, by what
follows the anchor's start and, read backwards, by what precedes its end: a multikey quicksort splits them by eight bytes
at a time to a shallow depth, and blind tries order what still has a long common prefix. Two windows of one anchor are
equal if they agree to the left and to the right, which the common prefixes of neighbours in the two orders tell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import by_size, materialise
from gridloom.llm.shingles import mix

#: Bytes of text that are hashed at once; a longer text is hashed alone.
BLOCK_BYTES = 2 << 20
#: Multiplier of the rolling hashes, odd, and the id that stands for a null one.
BASE = 0x9E3779B97F4A7C15
NO_ID = (1 << 63) - 1
#: Of a segment's hash the bits that say how many windows it has and where its anchor is.
SHAPE_BITS = 16
#: Kinds of covers: a segment, a segment that is the first of its kind, bytes that the sort has found.
WHOLE, HEAD, INNER = 0, 1, 2


@dataclass(frozen=True)
class Rule:
    """Bytes covered by a string of ``length`` bytes that also starts earlier are removed."""

    length: int = 100
    anchor: int = 40
    #: Bytes to which the quicksort goes; a multiple of eight. Beyond the anchor, so that tries begin at real differences.
    shallow: int = 48
    #: Different segments of one anchor that are sorted together; an anchor with more is dealt out by whole windows.
    most: int = 20_000

    @cached_property
    def spread(self) -> int:
        """Places in a window that can be its anchor; at most 256."""
        return self.length - self.anchor + 1

    @cached_property
    def width(self) -> int:
        """Bytes of a sort key: the longest string, whole words of eight, the last byte the length."""
        return -(-(self.length + 1) // 8) * 8


@lru_cache(1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    ups = [np.cumprod(np.r_[np.uint64(1), np.full(n, np.uint64(x))], dtype=np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64))]
    return ups[0], ups[1]


BYTES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def segments(data: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    """Of a text of ``length`` bytes or more: each segment's anchor hash, own hash, first window and last window, and where
    its anchor starts. The leftmost of equal hashes is the anchor."""
    n, k = len(data), rule.anchor
    up, down = powers(1 << max(21, (n - 1).bit_length()))
    sums = np.r_[np.uint64(0), np.cumsum(BYTES[data] * up[:n], dtype=np.uint64)]
    value = mix((sums[k:] - sums[:-k]) * down[: n - k + 1])
    place, size = np.arange(len(value), dtype=np.int64), 1
    while size < rule.spread:  # the least of ``size`` places from each on
        step = min(size, rule.spread - size)
        later = value[step:] < value[:-step]
        value, place, size = np.where(later, value[step:], value[:-step]), np.where(later, place[step:], place[:-step]), size + step
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[start[1:], len(place)] - 1
    anchor = place[start]
    own = mix((sums[last + rule.length] - sums[start]) * down[start] ^ mix((last - start).astype(np.uint64)))
    shape = ((last - start) << 8 | (anchor - start)).astype(np.uint64)
    return value[start].view(np.int64), ((own << np.uint64(SHAPE_BITS)) | shape).view(np.int64), start, last, anchor


def named(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows as ``(doc, tie, id, text)``. Rows that share an id are told apart by 31 bits of a hash of the text."""
    value = F.coalesce(F.col(text), F.lit(""))
    ident = F.col(doc_id).cast("bigint")
    tie = F.xxhash64(value).bitwiseAND(F.lit((1 << 31) - 1))
    return docs.select(F.coalesce(ident, F.lit(NO_ID)).alias("doc"), tie.alias("tie"), ident.alias("id"), value.alias("text"))


def found_segments(texts: DataFrame, rule: Rule, hashes_only: bool) -> DataFrame:
    """``(a, g, doc, place)`` per segment, or ``(a, n)`` per batch; ``place`` is ``tie`` and the first window's start."""
    schema = "a bigint, n bigint" if hashes_only else "a bigint, g bigint, doc bigint, place bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(iter([batch]), "text", BLOCK_BYTES):
                kept: list[list[np.ndarray]] = [[], [], [], []]
                for doc, tie, text in zip(part.column("doc").to_pylist(), part.column("tie").to_pylist(), part.column("text"), strict=True):
                    a, g, start, _, _ = segments(np.frombuffer(text.as_buffer(), np.uint8), rule)
                    for out, values in zip(kept, (a, g, np.full(len(a), doc), start | tie << 32), strict=True):
                        out.append(values)
                columns = [np.concatenate(x) for x in kept] if kept[0] else [np.zeros(0, np.int64)] * 4
                if hashes_only:
                    columns = list(np.unique(columns[0], return_counts=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in schema.split(", ")])

    return texts.select("doc", "tie", "text").mapInArrow(work, schema)


class BlindTrie:
    """Order of keys of equal length given as numbers: inner nodes hold only the bit in which their two sides differ."""

    def __init__(self, first: int) -> None:
        self.root: list | int = 0
        self.keys, self.same = [first], [[0]]

    def add(self, name: int, key: int) -> None:
        node = self.root
        while type(node) is list:  # blindly: bits in between are not looked at
            node = node[1 + (key >> node[0] & 1)]
        differs = (key ^ self.keys[node]).bit_length() - 1
        if differs < 0:
            self.same[node].append(name)
            return
        self.keys.append(key)
        self.same.append([name])
        above, side, node = None, 0, self.root
        while type(node) is list and node[0] > differs:
            above, side = node, 1 + (key >> node[0] & 1)
            node = node[side]
        leaf = len(self.keys) - 1
        split = [differs, node, leaf] if key >> differs & 1 else [differs, leaf, node]
        if above is None:
            self.root = split
        else:
            above[side] = split

    def order(self) -> list[int]:
        out, open_ = [], [self.root]
        while open_:
            node = open_.pop()
            if type(node) is list:
                open_ += (node[2], node[1])
            else:
                out += self.same[node]
        return out


def deep_shallow(keys: np.ndarray, shallow: int) -> np.ndarray:
    """Order of the rows of ``keys`` (bytes, a multiple of eight wide).

    Shallow: a multikey quicksort on symbols of eight bytes, in which all groups still open are split at once. Deep: each
    group equal to ``shallow`` bytes goes into a blind trie.
    """
    n = len(keys)
    words = np.ascontiguousarray(keys).view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)  # ``group`` is where the group of the row at a place begins
    for c in range(shallow // 8):
        sizes = np.bincount(group, minlength=n)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            return order
        symbol = words[order[open_], c]
        sort = np.lexsort((symbol, group[open_]))
        order[open_] = order[open_][sort]
        symbol, first = symbol[sort], group[open_]
        new = np.r_[True, (symbol[1:] != symbol[:-1]) | (first[1:] != first[:-1])]
        group[open_] = np.maximum.accumulate(np.where(new, open_, 0))
    starts, sizes = np.unique(group, return_counts=True)
    for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        rows = order[start : start + size]
        numbers = [int.from_bytes(keys[r, shallow:].tobytes(), "big") for r in rows]
        trie = BlindTrie(numbers[0])
        for i in range(1, size):
            trie.add(i, numbers[i])
        order[start : start + size] = rows[trie.order()]
    return order


def sort_keys(strings: list[bytes], rule: Rule) -> np.ndarray:
    """Strings padded with zeros to one width, the last byte their length: a string comes before those that go on with zeros."""
    tail = rule.width - 1
    return np.frombuffer(b"".join(s.ljust(tail, b"\0") + bytes([len(s)]) for s in strings), np.uint8).reshape(len(strings), rule.width)


def common_prefixes(keys: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of sorted ``keys`` and the one before; 0 for the first."""
    out = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        differs = keys[1:] != keys[:-1]
        first = np.where(differs.any(1), differs.argmax(1), keys.shape[1])
        out[1:] = np.minimum(first, np.minimum(keys[1:, -1], keys[:-1, -1]))
    return out


def repeated_windows(rank: np.ndarray, strings: list[bytes], before: np.ndarray, last: np.ndarray, rule: Rule) -> np.ndarray:
    """For segments of any anchors, in the order of ``rank``, which of their windows an earlier one holds.

    A row per segment and a column per number of bytes of a window that precede its anchor; ``before`` is that of the
    segment's first window and ``last`` that of its last one.
    """
    n, span = len(strings), rule.spread
    cuts = [(s[b:], s[: b + rule.anchor][::-1]) for s, b in zip(strings, before.tolist(), strict=True)]
    sides = []
    for side in (0, 1):
        keys = sort_keys([c[side] for c in cuts], rule)
        order = deep_shallow(keys, rule.shallow)
        sides.append((order, common_prefixes(keys[order])))
    out = np.zeros((n, span), bool)
    for j in range(span):
        there = np.flatnonzero((last <= j) & (j <= before))
        if len(there) < 2:
            continue
        classes = []
        for (order, prefix), depth in zip(sides, (rule.length - j, rule.anchor + j), strict=True):
            of = np.empty(n, np.int64)
            of[order] = np.cumsum(prefix < depth)
            classes.append(of[there])
        pair = classes[0] * (n + 1) + classes[1]
        sort = np.lexsort((rank[there], pair))
        again = np.r_[False, pair[sort][1:] == pair[sort][:-1]]
        out[there[sort[again]], j] = True
    return out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of true flags."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def cut_out(wanted: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """``(a, n, doc, place, before, windows, data)`` for ``wanted(a, g, n, doc, place)``: the segments' bytes, from the texts."""
    lists = wanted.groupBy("doc", F.shiftright("place", 32).alias("tie")).agg(F.collect_list(F.struct("a", "g", "place", "n")).alias("all"))
    met = texts.select("doc", "tie", "text").join(lists, ["doc", "tie"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(iter([batch]), "text", BLOCK_BYTES):
                docs, column = part.column("doc").to_pylist(), part.column("all")
                size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
                a, g, place, n = (column.flatten().field(i).to_numpy() for i in range(4))
                before, windows, start = g & 255, (g >> 8 & 255) + 1, place & 0xFFFFFFFF
                owner, data = np.repeat(np.arange(len(docs)), size), []
                buffers = [memoryview(t.as_buffer()) for t in part.column("text")]
                for o, s, w in zip(owner.tolist(), start.tolist(), windows.tolist(), strict=True):
                    data.append(bytes(buffers[o][s : s + w - 1 + rule.length]))
                columns = [a, n, np.array(docs, np.int64)[owner], place, before, windows]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(data, pa.binary())], ["a", "n", "doc", "place", "before", "windows", "data"])

    return met.mapInArrow(work, "a bigint, n bigint, doc bigint, place bigint, before bigint, windows bigint, data binary")


def sorted_repeats(pieces: DataFrame, rule: Rule) -> DataFrame:
    """``(doc, place, start, stop)``: the bytes of first segments that earlier windows hold. Segments of one anchor are together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            # A segment stands twice if rows share id and text.
            order = np.lexsort([table.column(c).to_numpy() for c in ("place", "doc", "a")])
            ids = np.stack([table.column(c).to_numpy()[order] for c in ("a", "doc", "place")])
            table = table.take(order[np.r_[True, (ids[:, 1:] != ids[:, :-1]).any(0)]])
            doc, place, before, windows = (table.column(c).to_numpy() for c in ("doc", "place", "before", "windows"))
            rank = np.empty(len(doc), np.int64)
            # Earlier windows of one anchor offset have earlier anchors.
            rank[np.lexsort((place + before, doc))] = np.arange(len(doc))
            again = repeated_windows(rank, table.column("data").to_pylist(), before, before - windows + 1, rule)
            row, first, last = runs(again)
            anchor = (place[row] & 0xFFFFFFFF) + before[row]
            start, stop = anchor - last, anchor - first + rule.length
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc[row], place[row], start, stop)], ["doc", "place", "start", "stop"])

        held, rows = [], 0
        for batch in batches:
            a, at = batch.column("a").to_numpy(), 0
            cuts = np.flatnonzero(a[1:] != a[:-1]) + 1
            if held and held[-1].column("a")[-1].as_py() != a[0]:
                cuts = np.r_[0, cuts]
            # Whole anchors until there are enough segments.
            for cut in cuts.tolist():
                if rows + cut - at >= rule.most:
                    if cut > at:
                        held.append(batch.slice(at, cut - at))
                    yield solve(held)
                    held, rows, at = [], 0, cut
            if batch.num_rows > at:
                held.append(batch.slice(at))
                rows += batch.num_rows - at
        if held:
            yield solve(held)

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(n, "a").sortWithinPartitions("a").mapInArrow(work, "doc bigint, place bigint, start bigint, stop bigint")


def counted_repeats(pieces: DataFrame, rule: Rule) -> DataFrame:
    """The same for anchors with too many different segments for one task: here the sort goes to the whole window, where
    equal ones have nothing left to be ordered by but their place, and the first of them is a minimum."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, place, windows, data in zip(*(batch.column(c).to_pylist() for c in ("doc", "place", "windows", "data")), strict=True):
                for i in range(windows):
                    rows.append((hashlib.sha256(data[i : i + rule.length]).digest()[:16], doc, place, (place & 0xFFFFFFFF) + i))
            names = ["window", "doc", "place", "start"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.binary(), pa.int64(), pa.int64(), pa.int64()])], names)

    every = materialise(pieces.mapInArrow(work, "window binary, doc bigint, place bigint, start bigint"), "repeats-windows")
    tie = F.shiftright("place", 32)
    first = every.groupBy("window").agg(F.min(F.struct("doc", tie.alias("tie"), "start")).alias("first"))
    later = every.join(first, "window").where(F.struct("doc", tie.alias("tie"), "start") > F.col("first"))
    return later.select("doc", "place", "start", (F.col("start") + rule.length).alias("stop"))


def without(rows: DataFrame, rule: Rule) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` from ``rows(id, text, covers)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(iter([batch]), "text", BLOCK_BYTES):
                sizes, spans, kept = [], [], []
                for text, covers in zip(part.column("text"), part.column("covers"), strict=True):
                    data, found = np.frombuffer(text.as_buffer(), np.uint8), covers.values
                    sizes.append(len(data))
                    if found is None or not len(found):
                        spans.append([])
                        kept.append(data.tobytes())
                        continue
                    kind, start, stop = (found.field(i).to_numpy() for i in range(3))
                    own = (kind == INNER) | ((kind == WHOLE) & ~np.isin(start, start[kind == HEAD]))
                    depth = np.zeros(len(data) + 1, np.int64)
                    np.add.at(depth, start[own], 1)
                    np.add.at(depth, stop[own], -1)
                    covered = np.cumsum(depth)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
                    spans.append([{"start": a, "stop": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                    kept.append(data[~covered].tobytes())
                kind_of = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, kind_of), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
                )

    return rows.select("id", "text", "covers").mapInArrow(work, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary")


def without_repeats(docs: DataFrame, rule: Rule | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes`` of the text, ``spans``, an array of ``(start, stop)`` in bytes, and
    ``kept``, the bytes outside them. Spans are the maximal runs of bytes covered by strings of ``rule.length`` bytes that also
    start earlier: in a document with a smaller id, or before in the same one.

    A null text is empty; an empty text, or one shorter than a string, has no spans. A null doc_id comes after all others.
    Rows that share an id count as one after the other, in the order of a hash of their texts; rows that share both id and
    text are one document and have equal results. All strings are judged on the texts as given, and none crosses from
    one text into another. No rows give no rows; other columns are ignored.

    Hashes name anchors and segments by 112 bits together. Texts are read three times and shuffled twice.
    """
    rule = rule or Rule()
    rows = named(docs, text, doc_id)
    texts = rows.where(F.octet_length("text") >= rule.length)
    common = found_segments(texts, rule, True).groupBy("a").agg(F.sum("n").alias("n")).where("n > 1").select("a")
    hits = found_segments(texts, rule, False).join(materialise(common, "repeats-anchors"), "a")
    hits = materialise(hits, "repeats-hits")
    heads = hits.groupBy("a", "g").agg(F.min(F.struct("doc", "place")).alias("first"))
    heads = materialise(heads.select("a", "g", "first.doc", "first.place"), "repeats-heads")
    several = heads.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
    pieces = materialise(cut_out(heads.join(several, "a"), texts, rule), "repeats-pieces")
    inner = sorted_repeats(pieces.where(F.col("n") <= rule.most), rule).unionByName(counted_repeats(pieces.where(F.col("n") > rule.most), rule))

    # Segments that are not the first of their kind are covered whole; of first ones, what the sort has found.
    start, tie = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("place", 32)
    stop = start + F.shiftright("g", 8).bitwiseAND(F.lit(255)) + rule.length
    covers = hits.select("doc", tie.alias("tie"), F.lit(WHOLE).alias("kind"), start.alias("start"), stop.alias("stop"))
    covers = covers.union(heads.select("doc", tie, F.lit(HEAD), start, stop)).union(inner.select("doc", tie, F.lit(INNER), "start", "stop"))
    covers = covers.groupBy("doc", "tie").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("covers"))
    return without(rows.join(covers, ["doc", "tie"], "left"), rule)
