"""Language of words and texts by a linear-chain conditional random field.

Every word has scores for each language from its affixes, its character n-grams and its place in lexicons; learned
transitions tie neighbouring words together. Forward-backward gives each word's probabilities for the languages, so that
texts that switch language are labelled word by word; a text's language is the one with most words.

The model is fitted on a bounded sample of labelled texts (``Settings``), on sequences spliced from runs of several
languages, as text that switches is rarely labelled as such. Prediction reads whole texts: a long chain is cut into
segments whose transfer matrices are multiplied first, which gives the exact messages at every cut, and all segments are
then worked on side by side.

The field spreads every word over the languages it has learned. Whether a text is in any of them is asked of its letters
instead: the share of each word's runs of three letters that the sample has, in whatever language, against what texts
of the sample reach that are held against the other half of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import by_size, materialise
from gridloom.llm.shingles import mix

BLOCK_BYTES = 1 << 20
SEGMENT = 32
UNKNOWN = "und"
#: How far below the mean of the sample's texts one may be, in standard deviations, and still count as known.
DEVIATIONS = 6
#: Words of a text that may be of no language besides, up to this share of its distinct words.
ODD_WORDS, ODD_SHARE = 2, 0.5


@dataclass(frozen=True)
class Settings:
    """The sample: per language, at most ``texts`` texts of at most ``chars`` characters, those whose ids hash lowest, and of
    each at most ``windows`` runs of words. ``buckets``: size of the table that features are hashed into."""

    texts: int = 300
    chars: int = 20_000
    windows: int = 12
    buckets: int = 1 << 15
    epochs: int = 4
    batch: int = 256
    rate: float = 0.2
    decay: float = 1e-6
    lexicon_count: int = 3
    lexicon_share: float = 0.9
    seed: int = 5


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    """Hashed features by label."""
    lexicon: np.ndarray
    """Hashes of lexicon words, sorted; ``lexicon_of`` has the language of each."""
    lexicon_of: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray
    """From row to column."""
    grams: np.ndarray
    """Hashes of all runs of three letters in the sample, sorted."""
    reach: tuple[float, float, float]
    """Share of known runs in a text not learned from: mean of texts, their deviation, and that of words within a text."""


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of ``texts``, one after the other, as numbers of distinct words; these; and how many each text has.
    Words stand between white space and are reduced to their letters, in lower case; without a letter it is none."""
    parts = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    coded = parts.flatten().dictionary_encode()
    letters = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}]+", "").dictionary_encode()
    distinct = letters.dictionary
    number = letters.indices.to_numpy()[coded.indices.to_numpy()] if len(distinct) else np.zeros(0, np.int64)
    filled = (pc.binary_length(distinct).to_numpy() > 0)[number] if len(distinct) else np.zeros(0, bool)
    owner = np.repeat(np.arange(len(counts)), counts)[filled]
    return number[filled], distinct, np.bincount(owner, minlength=len(counts))


def features(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of ``words``: six affixes each (first and last one to three letters); then n-grams of two and three
    letters, with marks for begin and end, one after the other, and how many of them each word has; and word hashes."""
    texts = words.to_pylist()
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    affixes = np.zeros((len(texts), 6), np.int64)
    fold = lambda value, letters: mix((value << np.uint64(21)) ^ letters)
    for side, (edge, step) in enumerate(((starts + 1, 1), (ends - 2, -1))):
        value = np.full(len(texts), side + 1, np.uint64)
        for n in range(3):
            # Beyond a short word's end its last letter is repeated.
            value = fold(value, flat[np.clip(edge + step * n, starts, ends - 1)] if len(texts) else value)
            affixes[:, 3 * side + n] = (value % np.uint64(buckets)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    grams, owners = [], []
    for n in (2, 3):
        at = np.arange(max(len(flat) - n + 1, 0))
        at = at[owner[at] == owner[at + n - 1]] if len(at) else at
        value = np.full(len(at), 10 + n, np.uint64)
        for k in range(n):
            value = fold(value, flat[at + k])
        grams.append((value % np.uint64(buckets)).astype(np.int64))
        owners.append(owner[at])
    order = np.argsort(np.concatenate(owners), kind="stable")
    counts = np.bincount(np.concatenate(owners), minlength=len(texts)) if texts else np.zeros(0, np.int64)
    hashes = pd.util.hash_array(np.array(texts, dtype=object), categorize=False) if texts else np.zeros(0, np.uint64)
    return affixes, np.concatenate(grams)[order], counts, hashes


def trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of three letters of ``words``, marks for begin and end included, and the word each is of."""
    texts = words.to_pylist()
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 2)
    at = np.arange(max(len(flat) - 2, 0))
    at = at[owner[at] == owner[at + 2]] if len(at) else at
    # A code point has 21 bits, so three of them fit into one number.
    return (flat[at] << np.uint64(42)) | (flat[at + 1] << np.uint64(21)) | flat[at + 2], owner[at]


def known_share(words: pa.Array, grams: np.ndarray) -> np.ndarray:
    """Of each word, the share of its runs of three letters that are among ``grams``, sorted."""
    found, owner = trigrams(words)
    if not len(grams):
        return np.zeros(len(words))
    hit = grams[np.minimum(np.searchsorted(grams, found), len(grams) - 1)] == found
    return np.bincount(owner, hit, len(words)) / np.maximum(np.bincount(owner, minlength=len(words)), 1)


def own_words(number: np.ndarray, distinct: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like the result of ``words_of``, each text's words once; and the text of each."""
    text, own = np.divmod(np.unique(np.repeat(np.arange(len(counts)), counts) * distinct + number), max(distinct, 1))
    return own, text, np.bincount(text, minlength=len(counts))


def letters_of(number: np.ndarray, distinct: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, tuple[float, float, float]]:
    """``grams`` and ``reach`` of a model whose sample has these words. Each half of the texts, every other one, is held against
    the runs of the other. From fewer than two texts of eight words on each side nothing can be said: ``reach`` is nan."""
    found, owner = trigrams(distinct)
    number, text, counts = own_words(number, len(distinct), counts)
    side = np.arange(len(counts)) % 2
    sides = side[text]
    shares = np.zeros(len(number))
    for half in (0, 1):
        other = np.zeros(len(distinct), bool)
        other[number[sides != half]] = True
        shares[sides == half] = known_share(distinct, np.unique(found[other[owner]]))[number[sides == half]]
    full = counts >= 8
    if min(np.count_nonzero(full & (side == 0)), np.count_nonzero(full & (side == 1))) < 2:
        return np.unique(found), (np.nan, np.nan, np.nan)
    means = np.bincount(text, shares, len(counts)) / np.maximum(counts, 1)
    own = full[text]
    return np.unique(found), (float(means[full].mean()), float(means[full].std()), float((shares - means[text])[own].std()))


def lexicon_place(model: Model, hashes: np.ndarray) -> np.ndarray:
    """Language of each word by the lexicon; -1 if it has none."""
    if not len(model.lexicon):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(model.lexicon, hashes), len(model.lexicon) - 1)
    return np.where(model.lexicon[at] == hashes, model.lexicon_of[at], -1)


def word_scores(model: Model, words: pa.Array) -> np.ndarray:
    """Score of each word for each language."""
    affixes, grams, counts, hashes = features(words, len(model.weights))
    out = model.weights[affixes].sum(1)
    if len(grams):
        out += np.add.reduceat(model.weights[grams], np.cumsum(counts) - counts) / counts[:, None]
    place = lexicon_place(model, hashes)
    out[place >= 0] += model.lexicon_weights[place[place >= 0]]
    return out


def marginals(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probabilities of each word for each language, by forward-backward over each text's chain of words. ``scores`` has the
    words of all texts, ``counts`` how many each text has."""
    labels = scores.shape[1]
    segments = -(-counts // SEGMENT)
    if not segments.sum():
        return np.zeros((0, labels))
    a = np.exp(transitions - transitions.max())
    first_word, last_segment = np.cumsum(counts) - counts, np.cumsum(segments)
    first_segment = last_segment - segments
    text = np.repeat(np.arange(len(counts)), segments)
    within = np.arange(len(text)) - first_segment[text]
    size = np.minimum(counts[text] - within * SEGMENT, SEGMENT)
    at = (first_word[text] + within * SEGMENT)[None, :] + np.arange(SEGMENT)[:, None]
    live = np.arange(SEGMENT)[:, None] < size[None, :]
    weight = np.exp(scores - scores.max(1, keepdims=True))
    e = np.where(live[:, :, None], weight[np.minimum(at, len(scores) - 1)], 1.0)
    # Transfer matrix of each segment.
    m = np.broadcast_to(np.eye(labels), (len(text), labels, labels)).copy()
    for t in range(SEGMENT):
        on = live[t]
        new = (m[on] @ a) * e[t, on][:, None, :]
        m[on] = new / new.max(axis=(1, 2), keepdims=True)
    # Messages into each segment from the left and from the right, one segment after the other in all texts at once.
    into, back = np.full((len(text), labels), 1.0 / labels), np.ones((len(text), labels))
    by_length = np.argsort(-segments, kind="stable")
    longer = np.searchsorted(-segments[by_length], -np.arange(1, segments.max() + 1), "right")
    for k in range(1, segments.max()):
        here = first_segment[by_length[: longer[k]]] + k
        v = np.einsum("sk,skl->sl", into[here - 1], m[here - 1])
        into[here] = v / v.sum(1, keepdims=True)
        there = last_segment[by_length[: longer[k]]] - k
        v = np.einsum("skl,sl->sk", m[there], back[there])
        back[there - 1] = v / v.sum(1, keepdims=True)
    # Within all segments at once.
    alpha = np.empty_like(e)
    state = into
    for t in range(SEGMENT):
        new = (state @ a) * e[t]
        state = np.where(live[t][:, None], new / new.sum(1, keepdims=True), state)
        alpha[t] = state
    out = np.empty_like(scores)
    for t in reversed(range(SEGMENT)):
        on = live[t]
        p = alpha[t, on] * back[on]
        out[at[t, on]] = p / p.sum(1, keepdims=True)
        new = (e[t] * back) @ a.T
        back = np.where(on[:, None], new / new.sum(1, keepdims=True), back)
    return out


def fit(texts: list[str], langs: list[str], settings: Settings) -> Model:
    """A model from labelled texts, by stochastic gradient ascent on the likelihood of spliced sequences."""
    rng = np.random.default_rng(settings.seed)
    labels = sorted(set(langs))
    k = len(labels)
    if not k:
        return Model([], np.zeros((1, 0)), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0, np.uint64), (np.nan,) * 3)
    number, distinct, counts = words_of(pa.array(texts, pa.string()))
    own = np.array([labels.index(x) for x in langs], np.int64)
    affixes, grams, gram_counts, hashes = features(distinct, settings.buckets)
    gram_starts = np.cumsum(gram_counts) - gram_counts
    seen = np.zeros((len(distinct), k))
    np.add.at(seen, (number, np.repeat(own, counts)), 1)
    total, top = seen.sum(1), seen.argmax(1)
    listed = np.flatnonzero((total >= settings.lexicon_count) & (seen.max(1) >= settings.lexicon_share * np.maximum(total, 1)))
    order = listed[np.argsort(hashes[listed])]
    model = Model(labels, np.zeros((settings.buckets, k)), hashes[order], top[order], np.zeros((k, k)), np.zeros((k, k)), *letters_of(number, distinct, counts))
    if k < 2:
        return model
    # Runs of words, cut from each text at random, and sequences of one to four of them.
    starts, runs = np.cumsum(counts) - counts, []
    for i in np.flatnonzero(counts):
        for _ in range(min(settings.windows, 1 + counts[i] // 8)):
            n = int(min(counts[i], rng.integers(4, SEGMENT + 1)))
            at = starts[i] + rng.integers(0, counts[i] - n + 1)
            runs.append((number[at : at + n], np.full(n, own[i])))
    place = lexicon_place(model, hashes)
    squares = [np.full(x.shape, 1e-6) for x in (model.weights, model.lexicon_weights, model.transitions)]
    for _ in range(settings.epochs):
        shuffled, sequences = rng.permutation(len(runs)), []
        at = 0
        while at < len(runs):
            take = [runs[i] for i in shuffled[at : at + int(rng.choice([1, 1, 2, 3, 4]))]]
            sequences.append(tuple(np.concatenate([x[j] for x in take])[:SEGMENT] for j in (0, 1)))
            at += len(take)
        for b in range(0, len(sequences), settings.batch):
            part = sequences[b : b + settings.batch]
            sizes = np.array([len(x[0]) for x in part])
            w, y = np.concatenate([x[0] for x in part]), np.concatenate([x[1] for x in part])
            used, again = np.unique(w, return_inverse=True)
            scores = word_scores_of(model, used, affixes, grams, gram_starts, gram_counts, place)[again]
            p, pairs = marginals(scores, sizes, model.transitions), expected_pairs(scores, sizes, model.transitions)
            gradient = -p
            gradient[np.arange(len(y)), y] += 1
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, again, gradient)
            grad_w = np.zeros_like(model.weights)
            for j in range(6):
                np.add.at(grad_w, affixes[used, j], by_word)
            which = np.concatenate([np.arange(gram_starts[u], gram_starts[u] + gram_counts[u]) for u in used])
            np.add.at(grad_w, grams[which], np.repeat(by_word / gram_counts[used][:, None], gram_counts[used], axis=0))
            grad_l = np.zeros_like(model.lexicon_weights)
            inside = place[used] >= 0
            np.add.at(grad_l, place[used][inside], by_word[inside])
            observed = np.zeros((k, k))
            last = np.zeros(len(y), bool)
            last[np.cumsum(sizes) - 1] = True
            np.add.at(observed, (y[:-1][~last[:-1]], y[1:][~last[:-1]]), 1)
            parameters = (model.weights, model.lexicon_weights, model.transitions)
            for x, g, s in zip(parameters, (grad_w, grad_l, observed - pairs), squares, strict=True):
                g = g / len(part) - settings.decay * x
                s += g * g
                x += settings.rate * g / np.sqrt(s)
    return model


def word_scores_of(model: Model, used: np.ndarray, affixes, grams, gram_starts, gram_counts, place) -> np.ndarray:
    """Like ``word_scores``, from features that are already known."""
    out = model.weights[affixes[used]].sum(1)
    which = np.concatenate([np.arange(gram_starts[u], gram_starts[u] + gram_counts[u]) for u in used])
    sizes = gram_counts[used]
    out += np.add.reduceat(model.weights[grams[which]], np.cumsum(sizes) - sizes) / sizes[:, None]
    inside = place[used] >= 0
    out[inside] += model.lexicon_weights[place[used][inside]]
    return out


def expected_pairs(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Expected number of transitions between languages over all texts, each at most a segment long."""
    k, longest = scores.shape[1], int(counts.max())
    starts = np.cumsum(counts) - counts
    at, live = starts[None, :] + np.arange(longest)[:, None], np.arange(longest)[:, None] < counts[None, :]
    e = np.where(live[:, :, None], np.exp(scores - scores.max(1, keepdims=True))[np.minimum(at, len(scores) - 1)], 1.0)
    a = np.exp(transitions - transitions.max())
    alpha, state = np.empty_like(e), np.full((len(counts), k), 1.0 / k)
    for t in range(longest):
        new = (state @ a) * e[t]
        state = np.where(live[t][:, None], new / new.sum(1, keepdims=True), state)
        alpha[t] = state
    beta, out = np.ones((len(counts), k)), np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        on = live[t]
        right = e[t] * beta
        joint = alpha[t - 1][:, :, None] * a * right[:, None, :]
        out += (joint / joint.sum(axis=(1, 2), keepdims=True))[on].sum(0)
        new = right @ a.T
        beta = np.where(on[:, None], new / new.sum(1, keepdims=True), beta)
    return out


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from the fit: a fifth of them, by checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, settings: Settings | None = None, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """A model fitted on a sample of the labelled documents that are not held out. Documents whose id, language or text is
    null are not in it. Copies of a text count once. Of a text longer than ``settings.chars`` a part of that length is taken,
    from a place that its hash tells. No more than the sample per language leaves a task."""
    settings = settings or Settings()
    chars, size = F.lit(settings.chars), F.length("text")
    usable = docs.where(~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull())
    usable = usable.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("id")).withColumn("hash", F.xxhash64("text"))
    ranked = usable.groupBy("lang", "hash").agg(F.min("id").alias("id"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "hash")
    picked = materialise(ranked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= settings.texts).drop("place"), "language-sample")
    start = F.pmod(F.col("hash"), F.greatest(size - chars + 1, F.lit(1))).cast("int") + 1
    rows = usable.join(picked, ["lang", "hash", "id"]).select("lang", "hash", F.substring("text", start, chars).alias("text"))
    sample = rows.dropDuplicates(["lang", "hash"]).select("lang", "text").orderBy("lang", "text").collect()
    return fit([row["text"] for row in sample], [row["lang"] for row in sample], settings)


def predict(docs: DataFrame, model: Model, text: str = "text", runs: bool = False, known: bool = False) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to ``docs``: the language with most expected words, and its share of them. With
    ``runs`` also ``lang_runs``, the text's words in order as runs of one language, ``(lang, words)``. With ``known`` also
    ``known``, whether its letters are those of the learned languages: the mean of its distinct words' shares of known
    runs is no more than ``DEVIATIONS`` below what such texts reach, besides ``ODD_WORDS`` (names, keys). It does not depend on how many
    languages there are, nor on which of them a word is of.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if the model knows no language. Of
    equal languages the first by name counts. Texts are read whole; nothing but the text is looked at. Rows and
    other columns are kept; columns with the added names are replaced. No shuffle.
    """
    docs = docs.drop("lang_pred", "score", "lang_runs", *(["known"] if known else []))
    added = "lang_pred string, score double" + (", lang_runs array<struct<lang:string,words:int>>" if runs else "") + (", known boolean" if known else "")
    schema = docs.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (x.split(" ", 1) for x in added.split(", ")))).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, text, BLOCK_BYTES):
            number, distinct, counts = words_of(part.column(text))
            langs, scores, found = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), [[] for _ in range(part.num_rows)]
            if len(number) and model.labels:
                p = marginals(word_scores(model, distinct)[number], counts, model.transitions)
                full = np.flatnonzero(counts)
                share = np.add.reduceat(p, (np.cumsum(counts) - counts)[full]) / counts[full][:, None]
                best = share.argmax(1)
                scores[full] = np.clip(share[np.arange(len(full)), best], 0, 1)
                for i, b in zip(full, best, strict=True):
                    langs[i] = model.labels[b]
                if runs:
                    tags, owner = p.argmax(1), np.repeat(np.arange(len(counts)), counts)
                    cuts = np.flatnonzero(np.r_[True, (tags[1:] != tags[:-1]) | (owner[1:] != owner[:-1])])
                    for start, n in zip(cuts, np.diff(np.r_[cuts, len(tags)]), strict=True):
                        found[owner[start]].append({"lang": model.labels[tags[start]], "words": int(n)})
            columns = [*part.columns, pa.array(langs), pa.array(scores)]
            inside = np.zeros(part.num_rows, bool)
            if known and len(number) and model.labels:
                own, owner, n = own_words(number, len(distinct), counts)
                full = np.flatnonzero(n)
                share = np.bincount(owner, known_share(distinct, model.grams)[own], len(n))[full] / n[full]
                mean, texts, words = model.reach
                odd = np.minimum(ODD_WORDS / n[full], ODD_SHARE)
                inside[full] = ~(share < mean - DEVIATIONS * np.hypot(texts, words / np.sqrt(n[full])) - odd)
            if runs:
                columns.append(pa.array(found, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))))
            if known:
                columns.append(pa.array(inside))
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.mapInArrow(work, schema)
