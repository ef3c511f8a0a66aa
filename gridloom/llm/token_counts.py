"""Token counts by a join of pre-token frequencies with pieces per pre-token.

A byte-level tokenizer first splits a text into pre-tokens and then each of them, on its own, into pieces. So the pieces
of a text are the sum over its pre-tokens, and a pre-token need only be split once in the whole corpus. Texts are cut
into pre-tokens and counted; each distinct pre-token is encoded once; the two are joined and added up by document.
Token ids are never kept.
"""

from __future__ import annotations

import os
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import by_size

#: Bytes of text whose pre-tokens are counted together; bounds the memory of a task.
BLOCK_BYTES = 8 << 20
#: Pairs of document and count that are added up together.
SUM_PAIRS = 1_000_000
#: Low bits of a document id that stand in a posting; the others are a column.
LOW_BITS = 16
#: Low bits of a document id that stand in a row of sums.
SLICE_BITS = 12
LOW, SUM = np.dtype("<u2"), np.dtype("<i8")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(tokenizer) -> list[str]:
    """Strings that stand for one token each wherever they occur."""
    added = tokenizer.get_added_tokens_decoder().values()
    odd = [t.content for t in added if t.lstrip or t.rstrip or t.single_word or t.normalized]
    if odd or tokenizer.normalizer is not None:
        raise ValueError(f"counting by pre-token needs a tokenizer without normalizer and plain added tokens, not {odd}")
    return sorted((t.content for t in added), key=len, reverse=True)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest, in order,
    for letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def single_pieces(tokenizer) -> frozenset[str]:
    """Texts that are one piece: entries of the vocabulary that encode to themselves. Bounded by the vocabulary."""
    letters = byte_letters()
    entries = []
    for entry in tokenizer.get_vocab():
        try:
            entries.append(bytes(letters[c] for c in entry).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    counts = tokenizer.encode_batch(entries, add_special_tokens=False)
    return frozenset(e for e, c in zip(entries, counts, strict=True) if len(c.ids) == 1)


def packed(values: np.ndarray, places: np.ndarray) -> pa.Array:
    """Binaries of the ``values`` between one place and the next."""
    offsets = (places * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def frequencies(docs: DataFrame, pattern: str, specials: list[str], singles: frozenset[str], text: str, doc_id: str) -> DataFrame:
    """Rows ``(pretoken, high, postings, counts)``: for a block of texts and a pre-token, the documents it is in, whose ids share
    their high bits, as low bits, once for each time it occurs there. What needs no encoding, special strings and pre-tokens that are one piece, is
    added up under a null pre-token, with ``counts``."""
    splitter = regex.compile("|".join(map(regex.escape, specials))) if specials else None
    cut = regex.compile(pattern).findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, text, BLOCK_BYTES):
            ids = part.column(doc_id)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            order = np.lexsort((ids, known))
            lengths, ones = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            # Pre-tokens are numbered as they come; a text's own strings are not kept.
            index: defaultdict[str, int] = defaultdict()
            index.default_factory = index.__len__
            numbers = array("i")
            for i, row in enumerate(order):
                value = part.column(text)[int(row)].as_py()
                if not value:
                    continue
                segments = splitter.split(value) if splitter else [value]
                ones[i] = len(segments) - 1
                before = len(numbers)
                for segment in segments:
                    numbers.extend(map(index.__getitem__, cut(segment)))
                lengths[i] = len(numbers) - before
            codes, distinct = np.array(numbers, np.int32), list(index)
            place = np.repeat(np.arange(len(ids)), lengths)
            single = np.fromiter((w in singles for w in distinct), bool, len(distinct))
            is_one = single[codes] if len(codes) else np.zeros(0, bool)
            ones += np.bincount(place[is_one], minlength=len(ids))
            pairs, n = np.unique(codes[~is_one].astype(np.int64) * len(ids) + place[~is_one], return_counts=True)
            code, at = pairs // max(len(ids), 1), pairs % max(len(ids), 1)
            sorted_ids, sorted_known = ids[order], known[order]
            with_ones = np.flatnonzero(ones)
            nothing = pa.nulls(1, pa.string())
            for tokens, code, at, n, counted in (
                (nothing, np.zeros(len(with_ones), np.int64), with_ones, ones[with_ones], True),
                (pa.array(distinct, pa.string()), code, at, n, False),
            ):
                if not len(code):
                    continue
                valid = sorted_known[at]
                high = np.where(valid, sorted_ids[at] >> LOW_BITS, 0)
                low = np.where(valid, sorted_ids[at] & ((1 << LOW_BITS) - 1), 0).astype(LOW)
                starts = np.flatnonzero(np.r_[True, (np.diff(code) != 0) | (np.diff(high) != 0) | (np.diff(valid) != 0)])
                places = np.r_[starts, len(code)]
                # Counts stand beside what needs no encoding; of the rest a document is written once per occurrence.
                postings = packed(low, places) if counted else packed(np.repeat(low, n), np.r_[0, np.cumsum(n)][places])
                counts = packed(n.astype(SUM), places) if counted else pa.nulls(len(starts), pa.binary())
                columns = [tokens.take(pa.array(code[starts])), pa.array(high[starts], mask=~valid[starts]), postings, counts]
                yield pa.RecordBatch.from_arrays(columns, ["pretoken", "high", "postings", "counts"])

    columns = docs.select(F.col(doc_id).cast("bigint").alias(doc_id), text)
    return columns.mapInArrow(count, "pretoken string, high bigint, postings binary, counts binary")


def pieces(pretokens: DataFrame, path: str) -> DataFrame:
    """``pieces`` for each row of ``pretokens(pretoken, ...)``: as many tokens as it encodes to; 1 for null."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            texts = batch.column("pretoken").to_pylist()
            found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
            counts = [1 if t is None else len(e.ids) for t, e in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("pretoken"), pa.array(counts, pa.int64())], ["pretoken", "pieces"])

    return pretokens.mapInArrow(encode, "pretoken string, pieces bigint")


def add_up(joined: DataFrame) -> DataFrame:
    """``(slice, lows, sums)`` from ``(high, postings, counts, pieces)``: tokens that a task has found in each document, packed by
    slices of ids. A slice is null for documents without id."""

    def flush(ids: list[np.ndarray], valid: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        ids, valid, counts = np.concatenate(ids), np.concatenate(valid), np.concatenate(counts)
        keys, inverse = np.unique(ids[valid], return_inverse=True)
        sums = np.zeros(len(keys), SUM)
        np.add.at(sums, inverse, counts[valid])
        slices = keys >> SLICE_BITS
        cuts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]]) if len(keys) else np.zeros(0, np.int64)
        ends = np.r_[cuts[1:], len(keys)]
        lows = (keys & ((1 << SLICE_BITS) - 1)).astype(LOW)
        rows = [(int(slices[a]), lows[a:b].tobytes(), sums[a:b].tobytes()) for a, b in zip(cuts, ends, strict=False)]
        if not valid.all():
            rows.append((None, np.zeros(1, LOW).tobytes(), np.array([counts[~valid].sum()], SUM).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["slice", "lows", "sums"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, valid, counts, held = [], [], [], 0
        for batch in by_size(batches, "postings", SUM_PAIRS):
            high, postings = batch.column("high"), batch.column("postings")
            sizes = pc.binary_length(postings).to_numpy() // LOW.itemsize
            lows = np.frombuffer(b"".join(postings.to_pylist()), LOW)
            ids.append((np.repeat(high.fill_null(0).to_numpy(), sizes) << LOW_BITS) | lows)
            valid.append(np.repeat(high.is_valid().to_numpy(zero_copy_only=False), sizes))
            weights = np.repeat(batch.column("pieces").to_numpy(), sizes)
            weights[np.repeat(batch.column("counts").is_valid().to_numpy(zero_copy_only=False), sizes)] = np.frombuffer(
                b"".join(batch.column("counts").drop_null().to_pylist()), SUM
            )
            counts.append(weights)
            held += len(lows)
            if held >= SUM_PAIRS:
                yield flush(ids, valid, counts)
                ids, valid, counts, held = [], [], [], 0
        if held:
            yield flush(ids, valid, counts)

    return joined.mapInArrow(work, "slice bigint, lows binary, sums binary")


def unpack(sums: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens)``, one row per document, from ``(slice, lows, sums)`` sorted by slice."""

    def rows(number: int | None, tokens: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        lows = np.flatnonzero(seen)
        ids = pa.array((np.int64(number or 0) << SLICE_BITS) | lows, pa.int64(), mask=np.full(len(lows), number is None))
        return pa.RecordBatch.from_arrays([ids, pa.array(tokens[lows])], ["doc_id", "n_tokens"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, number = False, None
        for batch in batches:
            for found, lows, values in zip(*(batch.column(c).to_pylist() for c in ("slice", "lows", "sums")), strict=True):
                if not begun or found != number:
                    if begun:
                        yield rows(number, tokens, seen)
                    begun, number = True, found
                    tokens, seen = np.zeros(1 << SLICE_BITS, np.int64), np.zeros(1 << SLICE_BITS, bool)
                at = np.frombuffer(lows, LOW)
                tokens[at] += np.frombuffer(values, SUM)
                seen[at] = True
        if begun:
            yield rows(number, tokens, seen)

    n = int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sums.repartition(n, "slice").sortWithinPartitions("slice").mapInArrow(work, "doc_id bigint, n_tokens bigint")


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens), as the
    byte-level tokenizer of the file ``path`` counts without added begin or end; ``pattern`` is the one by which it
    splits. Special strings inside texts are one token each, as is the library's default. Nothing is cut off.

    A null text counts as empty: no bytes, no tokens. Rows that share a doc_id are one document, whose rows are counted
    one by one and added up; rows with a null id are the document null. Other columns are ignored.

    Frequencies are shuffled once, by pre-token, in blocks: a pre-token that is in every document is one row per
    block, not per document. Both sides of the join read that shuffle. What a task of the join has
    found is added up by document and packed by slices of ids before it is shuffled.
    """
    tokenizer = load(path)
    rows = frequencies(docs, pattern, special_strings(tokenizer), single_pieces(tokenizer), text, doc_id).repartition("pretoken")
    # Sums over the other columns keep this side's columns those of the other, so that both read one shuffle.
    distinct = rows.groupBy("pretoken").agg(F.count("high").alias("blocks"), F.sum(F.octet_length("postings")).alias("size"), F.count("counts").alias("counted"))
    joined = rows.join(pieces(distinct, path), "pretoken", "left").select("high", "postings", "counts", F.coalesce("pieces", F.lit(1)).alias("pieces"))
    counted = unpack(add_up(joined)).select("doc_id", F.lit(0).cast("bigint").alias("n_bytes"), "n_tokens")
    sizes = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_tokens")
    )
    sums = sizes.union(counted).groupBy("doc_id").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
