"""Registered queries against their SQL twins or plain versions, over whole small tables."""

import hashlib
import html
import re
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from check_oracle import compare, connect
from tokenizers import Tokenizer

import __spark_entry__ as entry
from gridloom.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def rows_of(sf_dir, name, columns):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, sf_dir, name):
    assert compare(spark, database, sf_dir, name) is None


def test_language_of_held_out_documents(spark, sf_dir):
    langs = dict(rows_of(sf_dir, "documents", "doc_id, lang"))
    rows = QUERIES["op1_crf_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and langs[r.doc_id] is not None]
    assert len(rows) == len(langs) and len(held) > 20
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_main_text_is_the_article(spark, sf_dir):
    pages = dict(rows_of(sf_dir, "pages", "page_id, html"))
    rows = QUERIES["op4_template_extract"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"(?s)<article>(.*?)</article>", pages[row.page_id])[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>|<br>", article)]
        assert row.text == "\n".join(b for b in blocks if b) and row.n_chars == len(row.text)


def test_token_counts_are_the_library_s(spark, sf_dir):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: (len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in rows_of(sf_dir, "documents", "doc_id, text")}
    rows = QUERIES["op6_pretoken_counts"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == expected and len(rows) == len(expected)
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)


def test_contaminated_documents_hold_an_item(spark, sf_dir):
    normal = lambda t: " ".join(t.lower().split())
    items = {i: normal(t) for i, t in rows_of(sf_dir, "benchmark", "item_id, text")}
    rows = {r.doc_id: r for r in QUERIES["op9_edit_decontam"](spark, sf_dir).collect()}
    for doc_id, text in rows_of(sf_dir, "documents", "doc_id, text"):
        exact = {i for i, t in items.items() if t in normal(text)}
        assert exact <= set(rows[doc_id].item_ids)
        assert rows[doc_id].contaminated == bool(rows[doc_id].item_ids)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def plain_components(rows, percent):
    """Size of set and smallest reachable id of every document, by comparing all that share a shingle."""
    sets, parent, holders = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}, defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_duplicates_equal_all_pairs(spark, sf_dir):
    expected = plain_components(rows_of(sf_dir, "documents", "doc_id, text"), 85)
    rows = QUERIES["op10_hamming_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_repeated_bytes_are_those_of_all_windows(spark, sf_dir):
    seen, expected = set(), {}
    for doc_id, text in sorted(rows_of(sf_dir, "documents", "doc_id, text")):
        data = text.encode()
        covered = bytearray(len(data))
        for i in range(len(data) - 99):
            if (window := data[i : i + 100]) in seen:
                covered[i : i + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        expected[doc_id] = (len(data), sum(covered), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(kept).hexdigest())
    rows = QUERIES["op13_deep_shallow_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected and len(rows) == len(expected)
    assert sum(r.n_removed for r in rows) > 0
