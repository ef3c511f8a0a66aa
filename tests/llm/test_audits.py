"""Merkle manifests, divergence of sources and repeated passages, against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import divergence, merkle, repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, rank int, n int, a long, place long"


def table(spark, rows):
    """``(doc_id, text, lang, source)`` rows with columns that clash with the operators' own."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 7, 8, 9, 1, 2) for r in rows], DOCS)


# --- repeated passages ----------------------------------------------------------------------------------------------


def plain_spans(docs, length):
    """Maximal covered runs of each ``(id, text)``, documents in order."""
    seen, out = set(), []
    for _, text in docs:
        data, covered = text.encode(), np.zeros(len(text.encode()), bool)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                covered[i : i + length] = True
            seen.add(window)
        edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(int))).tolist()
        out.append((list(zip(edge[::2], edge[1::2], strict=True)), data if not len(edge) else bytes(np.frombuffer(data, np.uint8)[~covered])))
    return out


def hard_texts():
    r = random.Random(3)
    words = [" ".join("".join(r.choice("abcdeé\x00") for _ in range(r.randint(1, 8))) for _ in range(40)) for _ in range(12)]
    texts = ["", "short", "ab" * 300, "a" * 500, "a" * 99, "a" * 100, "\x00" * 250, "\x00" * 120, words[0], words[0], words[0] + "!", "é" * 120]
    for _ in range(120):
        parts = [w[r.randint(0, 60) : r.randint(80, len(w))] for w in r.sample(words, r.randint(1, 4))]
        texts.append("".join(parts))
    line = words[1][:64]
    texts += ["".join(chr(97 + r.randint(0, 25)) for _ in range(150)) + line + "".join(chr(97 + r.randint(0, 25)) for _ in range(150)) for _ in range(60)]
    return texts


@pytest.mark.parametrize("rule", [repeats.Rule(), repeats.Rule(length=30, anchor=8, shallow=8), repeats.Rule(most=3), repeats.Rule(length=40, anchor=16, shallow=16, most=12)])
def test_repeats_equal_all_windows(spark, rule):
    docs = list(enumerate(hard_texts()))
    expected = plain_spans(docs, rule.length)
    rows = repeats.without_repeats(table(spark, [(i, t, "en", "s") for i, t in docs]), rule).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for (i, text), (spans, kept) in zip(docs, expected, strict=True):
        assert (found[i].n_bytes, [tuple(s) for s in found[i].spans], bytes(found[i].kept)) == (len(text.encode()), spans, kept), i


def test_repeats_of_null_and_repeated_ids(spark):
    r = random.Random(4)
    one, two = ("".join(r.choice("abcdefgh ") for _ in range(300)) for _ in range(2))
    rows = [(None, one, "en", "s"), (5, one, "en", "s"), (7, two, "en", "s"), (7, two, "en", "s"), (7, None, "en", "s"), (8, two + one, "en", "s"), (None, two, None, None)]
    found = repeats.without_repeats(table(spark, rows)).collect()
    spans = sorted(((x.doc_id is None, x.doc_id, x.n_bytes, [tuple(s) for s in x.spans]) for x in found), key=str)
    assert spans == sorted([(True, None, 300, [(0, 300)]), (True, None, 300, [(0, 300)]), (False, 5, 300, []), (False, 7, 300, []), (False, 7, 300, []), (False, 7, 0, []), (False, 8, 600, [(0, 600)])], key=str)
    assert repeats.without_repeats(table(spark, rows).limit(0)).collect() == []


def test_deep_shallow_order_is_the_order_of_bytes():
    r, rule = random.Random(5), repeats.Rule()
    stems = [bytes(r.choice(b"ab\x00") for _ in range(60)) for _ in range(5)]
    strings = [r.choice(stems) + bytes(r.choice(b"\x00a") for _ in range(r.randint(0, 40))) for _ in range(400)] + [b"", b"\x00", b"a"]
    keys = repeats.sort_keys(strings, rule)
    order = repeats.deep_shallow(keys, 16)
    assert [strings[i] for i in order] == sorted(strings)
    prefix = repeats.common_prefixes(keys[order])
    ranked = sorted(strings)
    for a, b, n in zip(ranked, ranked[1:], prefix[1:], strict=False):
        assert n == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


# --- divergence of sources ------------------------------------------------------------------------------------------


def plain_audit(rows, least, top):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held, whole = Counter(t for d in own for t in set(d[2])), Counter(t for d in own for t in d[2])
        kept = [t for t in held if held[t] >= least]
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, words in own:
            counts[s].update(words)
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        of, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pairs = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, of[s][t] - q[t]) for t in kept if counts[s][t] and of[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def test_divergence_equals_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 16)
    r = random.Random(6)
    words = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(90)] + ["Ünd", "X_y", "日本"]
    rows = [(i, " ".join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=r.randint(0, 40))), r.choice(["en", "en", "de", None]), r.choice(["a", "a", "a", "b", "c", "ü", None])) for i in range(400)]
    rows += [(900, None, "en", "empty"), (901, "", "en", ""), (902, "only here", "fr", "a"), (903, "x " * 30_000 + "1 2 3", "fr", "b"), (904, "12 !", "it", "a"), (None, "wa wa", "en", "a"), (904, "12 !", "it", "a")]
    found = divergence.audit(table(spark, rows), least_docs=5, top=7).collect()
    assert sorted((x.lang, x.source, x.part, x.item, x.value, x.rank) for x in found) == plain_audit(rows, 5, 7)
    assert divergence.audit(table(spark, rows).limit(0)).collect() == []


def test_run_columns_multiply_runs():
    counts = np.array([[0, 0, 0, 4, 4, 1], [0, 0, 2, 2, 2, 2]])
    a, b = divergence.run_columns(counts, [9, 8], 6)
    assert a[0].tolist() == [0, 3, 5] and b[0].tolist() == [0, 2]
    p = [[1 + 10**9 * (c + 5) // (total + 30) for c in row] for row, total in zip(counts.tolist(), [9, 8], strict=True)]
    assert divergence.run_difference(a, b, 6) == sum(abs(x - y) for x, y in zip(*p, strict=True))


# --- Merkle manifest ------------------------------------------------------------------------------------------------

sha = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(hashes):
    """Root, and the steps (left, right) of each leaf up to it."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        starts = [i // 16 * 16 for i in at]
        for path, i, start in zip(paths, at, starts, strict=True):
            path.append(("".join(level[start:i]), "".join(level[i + 1 : start + 16])))
        level = [sha(*level[i : i + 16]) for i in range(0, len(level), 16)]
        at = [i // 16 for i in at]
    return level[0], paths


def test_manifest_equals_plain_tree(spark):
    r = random.Random(7)
    big = [r.randint(-(1 << 63), (1 << 63) - 1) for _ in range(300)] + list(range(-40, 300)) + [(1 << 63) - 1, -(1 << 63)]
    rows = [(i, r.choice(["Text ", "é", ""]) * r.randint(0, 5), "en", "big") for i in big]
    rows += [(i, "x", "en", f"s{i}") for i in range(40)] + [(i, "x", None, "mid") for i in range(16)] + [(i, None, "de", None) for i in range(17)]
    rows += [(None, f"t{i}", "en", "big") for i in range(20)] + [(5, "again", "en", "big")] * 3 + [(5, "other", "en", "big"), (None, "t3", "en", "big"), (1, "é" * 40_000, "en", "é")]
    docs = table(spark, rows)
    other = [F.lower(F.col("text")) if c == "text" else F.col(c) for c in merkle.FIELDS]
    made = merkle.manifest(docs, other=other)
    found = made.select("doc_id", "source", "leaf", "other", "subroot", "root", "path", merkle.proof(F.col("path")).alias("proof"), merkle.fold(F.col("leaf"), F.col("path")).alias("own"), merkle.fold(F.col("other"), F.col("path")).alias("changed")).collect()

    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, text, lang, source, n: sha(*map(field, (i, source, lang, n, text)))
    by_source = {}
    for i, text, lang, source in rows:
        n = len(text or "")
        by_source.setdefault(source, []).append((i is not None, i or 0, leaf(i, text, lang, source, n), leaf(i, text and text.lower(), lang, source, n)))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by_source[s])]) for s in sources}
    root, tops = plain_tree([trees[s][0] for s in sources])
    expected = []
    for s, top in zip(sources, tops, strict=True):
        for (known, i, h, o), path in zip(sorted(by_source[s]), trees[s][1], strict=True):
            steps, folded = path + top, o
            for left, right in steps:
                folded = sha(left, folded, right)
            expected.append((i if known else None, s, h, o, trees[s][0], root, sha(*(a + b for a, b in steps)), root, folded))
    assert sorted(((x.doc_id, x.source, x.leaf, x.other, x.subroot, x.root, x.proof, x.own, x.changed) for x in found), key=str) == sorted(expected, key=str)
    assert merkle.manifest(docs.limit(0)).collect() == []
    alone = merkle.manifest(docs.where("source = 'é'")).first()
    assert alone.leaf == alone.subroot == alone.root and alone.path == []


def test_places_come_from_bitmaps(spark):
    """No sort of rows: the plan orders words and what shares a word, nothing else."""
    words = spark.createDataFrame([(1, True, w, 1, 3) for w in (-(1 << 57), -1, 0, 5, 1 << 30, (1 << 57) - 1)], "tree long, known boolean, word long, bits long, n long")
    assert [(r.word, r.before) for r in merkle.directory(words).orderBy("word").collect()] == [(w, 3 * i) for i, w in enumerate((-(1 << 57), -1, 0, 5, 1 << 30, (1 << 57) - 1))]
