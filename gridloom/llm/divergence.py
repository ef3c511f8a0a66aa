"""How far the sources of a language differ in their words, from run-length columns of counts.

The vocabulary of a language is put in an order in which terms with equal counts stand together: by the sources that have
a term and its counts there. In that order a source's counts are a few runs, most of them of zeros. The order is cut
into blocks of terms; in a block each source is a run-length column, the run boundaries of two sources are intersected,
and the difference on a joint run is worked out once and multiplied by its length. Sums over blocks are the divergences.

All arithmetic is on whole numbers: probabilities are ``1 + floor(10^9 * (count + 5) / (N + 5 V))``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import by_size, groups_of, materialise
from gridloom.operators.common import with_ordinal

SCALE = 1_000_000_000
PRIOR = 5
#: Terms of a block.
BLOCK = 4096
#: Bytes of text counted at once.
BLOCK_BYTES = 8 << 20
#: Bytes as terms see them: A-Z lower-cased, other ASCII but a-z a space, bytes of other characters as they are.
FOLD = np.full(256, 32, np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[97:123] = FOLD[65:91] = np.arange(97, 123)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of all texts one after the other, the text and the code of each term, and the terms by code. Terms are runs of
    ASCII letters and characters beyond ASCII, A-Z lower-cased; a null text has none."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    folded = FOLD[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(filled), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(folded))
    parts = pc.ascii_split_whitespace(plain)
    words, counts = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(counts)), counts)
    there = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(there).dictionary_encode()
    return owner[there.to_numpy(zero_copy_only=False)], coded.indices.to_numpy(), coded.dictionary


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, term, docs, sources, ns)``: of a block of documents, in how many a language's term occurs, and how often in those
    of each source. Nulls are empty. Tasks hand on sums by block, not occurrences."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, text, BLOCK_BYTES):
            owner, code, words = terms(part.column(text))
            size = max(1, len(words))
            langs, sources = part.column(lang).dictionary_encode(), part.column(source).dictionary_encode()
            lang_of, source_of = (c.indices.to_numpy().astype(np.int64) for c in (langs, sources))
            # In order of language, term and source; each term of a language is a run.
            cells, n = np.unique((lang_of[owner] * size + code) * len(sources.dictionary) + source_of[owner], return_counts=True)
            term, place = np.divmod(cells, max(1, len(sources.dictionary)))
            starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
            once = np.unique(owner * size + code)
            _, held = np.unique(lang_of[once // size] * size + once % size, return_counts=True)
            of_lang, of_word = np.divmod(term[starts], size)
            offsets = pa.array(np.r_[starts, len(term)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(of_lang)), words.cast(pa.string()).take(pa.array(of_word)), pa.array(held, pa.int64()),
                    pa.ListArray.from_arrays(offsets, sources.dictionary.take(pa.array(place))), pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64())),
                ],
                ["lang", "term", "docs", "sources", "ns"],
            )

    columns = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (lang, source)), text)
    return columns.mapInArrow(work, "lang string, term string, docs bigint, sources array<string>, ns array<bigint>")


def probability(count: Column, total: Column, size: Column) -> Column:
    """``1 + floor(10^9 * (count + 5) / (total + 5 * size))``, exact at any count."""
    wide = lambda c: c.cast("decimal(28,0)")
    above = wide(count + PRIOR) * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", above, wide(total + PRIOR * size))


def run_columns(counts: np.ndarray, totals: list[int], size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each row of ``counts`` as run-length column: the runs' starts and their probabilities."""
    out = []
    for row, total in zip(counts, totals, strict=True):
        starts = np.r_[0, np.flatnonzero(row[1:] != row[:-1]) + 1]
        distinct, back = np.unique(row[starts], return_inverse=True)
        p = [1 + SCALE * (c + PRIOR) // (total + PRIOR * size) for c in distinct.tolist()]
        out.append((starts, np.array(p, np.int64)[back]))
    return out


def run_difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """Sum of absolute differences of two run-length columns of ``length`` entries: once for each joint run, times its length."""
    cuts = np.union1d(a[0], b[0])
    p, q = (x[1][np.searchsorted(x[0], cuts, "right") - 1] for x in (a, b))
    return int((np.abs(p - q) * np.diff(np.r_[cuts, length])).sum())


def block_sums(rows: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` for each block and pair of a language's sources, ``a`` before ``b``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "block"):
            group = group.combine_chunks()
            kinds, langs = group.column("kind").to_numpy(), group.column("lang")
            for at in np.flatnonzero(kinds == 0).tolist():
                lang = langs[at].as_py()
                own = group.filter(pc.and_(pc.equal(langs, lang), pc.equal(group.column("kind"), 1)))
                names, totals = group.column("sources")[at].as_py(), group.column("ns")[at].as_py()
                lists = own.column("sources").combine_chunks()
                term = np.repeat(np.arange(len(own)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                source = pc.index_in(lists.flatten(), value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False)
                counts = np.zeros((len(names), len(own)), np.int64)
                counts[source, term] = own.column("ns").combine_chunks().flatten().to_numpy()
                columns = run_columns(counts, totals, group.column("size")[at].as_py())
                for i in range(len(names) - 1):
                    values = [run_difference(columns[i], c, len(own)) for c in columns[i + 1 :]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(values)), pa.array([names[i]] * len(values)), pa.array(names[i + 1 :]), pa.array(values, pa.int64())],
                        ["lang", "a", "b", "value"],
                    )

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "block").sortWithinPartitions("block", "kind", "place")
    return dealt.mapInArrow(work, "lang string, a string, b string, value bigint")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every group of a language and a source.

    Part ``pair``: the divergence from every other source of the language over the terms that ``least_docs`` of its documents
    hold. Part ``term``: the ``top`` terms more probable in the source than in the whole language, by how much.
    Ranks count from 1 by value, largest first, ties by item in the order of its UTF-8 bytes.

    Null texts, languages and sources are read as empty. Rows that repeat are counted each time. A group without terms,
    and a language without kept terms, have their pairs, with value 0 where there is no kept term. No documents give no
    rows. Other columns are ignored. The list of a language's sources is held in memory, and a block's counts of all of
    them; the result has a row for each pair of sources anyway.
    """
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    counts = materialise(term_counts(docs, text, lang, source), "divergence-counts")
    # Most terms are rare: those to be kept are known before anything is added up by source.
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    cells = counts.drop("docs").join(materialise(kept.select("lang", "term"), "divergence-kept"), ["lang", "term"])
    cells = cells.select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("ns").alias("n"))))
    cells = cells.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    vector = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("vector")
    vocabulary = materialise(cells.groupBy("lang", "term").agg(F.sum("n").alias("n"), vector), "divergence-vectors")
    # Terms found in the same sources with the same counts stand together. Hashes keep the keys of the sort short.
    order = ["lang", F.xxhash64("vector.source"), "n", F.xxhash64("vector.n"), "term"]
    vocabulary = with_ordinal(vocabulary, order, "place")
    vocabulary = materialise(vocabulary.select("lang", "term", "n", "vector", "place", F.floor(F.col("place") / BLOCK).alias("block")), "divergence-terms")

    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("size"), F.sum("n").alias("lang_total"))
    cells = vocabulary.select("lang", "term", F.col("n").alias("lang_n"), F.inline("vector"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "size", "lang_total"])
    groups = materialise(groups, "divergence-groups")

    listed = groups.groupBy("lang", "size").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("all"))
    heads = vocabulary.select("block", "lang").distinct().join(listed, "lang")
    rows = heads.select("block", "lang", F.lit(0).alias("kind"), F.col("all.source").alias("sources"), F.col("all.total").alias("ns"), "size", F.lit(0).cast("bigint").alias("place"))
    rows = rows.union(vocabulary.select("block", "lang", F.lit(1), "vector.source", "vector.n", F.lit(None).cast("bigint"), "place"))
    sums = block_sums(rows).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sums = sums.select("lang", F.inline(F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item"), "value") for x, y in ("ab", "ba")))))

    # Every pair of a language is a row of the result, also where no term is kept.
    bare = groups.where("size = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    pairs = sums.unionByName(none).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    known = cells.join(groups, ["lang", "source"])
    p, q = probability(F.col("n"), F.col("total"), F.col("size")), probability(F.col("lang_n"), F.col("lang_total"), F.col("size"))
    over = known.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).cast("bigint").alias("value")).where("value > 0")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
