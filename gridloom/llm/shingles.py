"""Sets of word shingles of whole texts, as sorted 64-bit hashes, and MinHash signatures of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
#: Odd multipliers of the usual 64- and 32-bit finalisers.
MUL_A, MUL_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
MUL_32 = np.uint32(0x85EBCA6B)
PRIME = np.uint64(0x100000001B3)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MUL_A
    x = (x ^ (x >> np.uint64(27))) * MUL_B
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts``, one after the other, and how many each text has. Words are what stands between
    ASCII white space, A-Z lower-cased; a null text has none."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, counts = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(counts)), counts)[filled]
    coded = words.filter(pa.array(filled)).dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).astype(object)
    hashes = pd.util.hash_array(distinct, categorize=False) if len(distinct) else np.zeros(0, np.uint64)
    return hashes[coded.indices.to_numpy()], np.bincount(owner, minlength=len(counts))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one after the other, and how many each has. A text of fewer words than
    ``width`` has its whole sequence of words as one shingle; one without words has none."""
    words, counts = word_hashes(texts)
    starts = np.cumsum(counts) - counts
    # A shingle's hash depends on its words in order and on how many there are.
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), sizes)
    first = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(owner))
    span = np.minimum(counts, width)[owner]
    value = span.astype(np.uint64)
    for i in range(width):
        inside = span > i
        value[inside] = mix((value[inside] * PRIME) ^ words[first[inside] + i])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])] if len(value) else np.zeros(0, bool)
    return value[new], np.bincount(owner[new], minlength=len(counts))


def set_nodes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set: equal for equal sets. Empty sets get 0."""
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        sums, again = np.add.reduceat(values, starts), np.add.reduceat(mix(values ^ MUL_A), starts)
        out[full] = mix(sums ^ mix(again ^ counts[full].astype(np.uint64)))
    return out


def minhash(values: np.ndarray, counts: np.ndarray, symbols: int, seed: int = 1) -> np.ndarray:
    """Signatures, one row of 16-bit ``symbols`` per set; zeros for empty sets. Equal symbols are as likely as the
    similarity of two sets, but for one in 65,536."""
    out = np.zeros((len(counts), symbols), np.uint16)
    full = np.flatnonzero(counts)
    rng = np.random.default_rng(seed)
    salts, factors = rng.integers(0, 1 << 32, symbols, dtype=np.uint32), rng.integers(0, 1 << 31, symbols, dtype=np.uint32) * 2 + 1
    small = (values >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(counts)
    # Sets in runs of about 64k shingles, so that the arrays at work stay in the processor's cache.
    at = 0
    while at < len(full):
        begin = ends[full[at]] - counts[full[at]]
        stop = max(at + 1, int(np.searchsorted(ends[full], begin + 65_536, "right")))
        rows = full[at:stop]
        part, places = small[begin : ends[rows[-1]]], ends[rows] - counts[rows] - begin
        for k in range(symbols):
            y = (part ^ salts[k]) * factors[k]
            y ^= y >> np.uint32(15)
            y *= MUL_32
            y ^= y >> np.uint32(13)
            out[rows, k] = np.minimum.reduceat(y, places)
        at = stop
    return out
