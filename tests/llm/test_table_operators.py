"""Url rules, mixing, pages, vectors and near duplicates on hard cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import maxscore, mixing, near_dups, page_template, shingles, url_filter
from gridloom.llm.common import components, literal_table, merged

# --- urls -----------------------------------------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.org", "/fr/x", "block"), ("a.org", "/fr/x", "allow")]
URLS = [None, "", "no scheme", "HTTP://A.B.NET", "http://x.net/", "http://NET/q?x", "s://example.net/en/1#y", "s://sub.Example.net/en", "s://notexample.com/de/",
        "s://example.com/de/", "x://org/fr/://net/", "s://a.org/fr/xy", "s://b.a.org/fr/y", "s://org?/fr/", "s://ÄB.org/fr/", "s://" + "a." * 3000 + "net/" + "p" * 9000, "s://.net/"]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), h + p) for h, p, _ in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits)[2] if fits else None
    return host, path, rule, "allow" if rule is None else "block" if any(h + p == rule and v == "block" for h, p, v in RULES) else "allow"


def test_urls_are_judged_like_by_plain_rules(spark):
    urls = URLS + [f"http://h{i}.example.{('com', 'net', 'org')[i % 3]}/{('de', 'en', 'fr')[i % 2]}/{i}" for i in range(500)]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = literal_table(spark, RULES, ["host", "path", "verdict"])
    rows = url_filter.judge_urls(pages, rules).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [plain_verdict(u) for u in urls]
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.where("crc32(key) % 7 = 0").union(spark.sql("SELECT CAST(NULL AS STRING)"))
    cascade = url_filter.build(listed, universe.union(universe))
    wrong = universe.where(cascade.holds(F.col("key")) != (F.crc32("key") % 7 == 0))
    assert len(cascade.levels) > 2 and wrong.count() == 0
    assert sum(level.bits for level in cascade.levels) < 4000 * 8


# --- mixing ---------------------------------------------------------------------------------------------------------


def mix_docs(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["big"] * 12 + ["mid"] * 3 + ["small", None]), " w" * r.randint(1, 60), 1, 2) for i in range(3000)]
    rows += [(None, "mid", "a b", 1, 2), (5000, "empty", None, 1, 2), (5001, "empty", "", 1, 2), (5002, "mid", "x " * 20_000, 1, 2), (5003, "mid", "x", 1, 2), (5003, "mid", "x", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, tokens int, place int")


def test_weights_reach_the_entropy_and_the_schedule_the_weights(spark):
    docs = mix_docs(spark)
    target = mixing.Target(entropy=0.9, max_repeat=8.0)
    rows = mixing.mix(docs, target, seed=3).collect()
    counts = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect() if r.n}
    used = {s: sum(r.tokens for r in rows if r.source == s) for s in counts}
    total = sum(used.values())
    entropy = -sum(n / total * math.log(n / total) for n in used.values()) / math.log(len(counts))
    assert abs(entropy - 0.9) < 0.01 and total <= sum(counts.values())
    # A source falls short of its weight by less than its longest document.
    assert sum(counts.values()) - total < len(counts) * 20_001
    for source in counts:
        assert used[source] <= 8 * counts[source]
        by_id = {}
        for r in rows:
            if r.source == source:
                by_id.setdefault(r.doc_id, []).append(r.epoch)
        repeats = {i: sorted(e) for i, e in by_id.items() if i != 5003}
        assert all(e == list(range(1, len(e) + 1)) for e in repeats.values())
        assert max(map(len, repeats.values())) - min(map(len, repeats.values())) <= 1
    assert not any(r.source == "empty" for r in rows) and set(docs.columns) | {"epoch"} == set(rows[0].asDict())
    assert sorted(map(tuple, mixing.mix(docs, target, seed=3).collect()), key=str) == sorted(map(tuple, rows), key=str)
    places = {r.doc_id: r.place for r in rows if r.epoch == 1}
    assert any(places[r.doc_id] != r.place for r in rows if r.epoch == 2)


def test_combinations_of_columns_are_sources(spark):
    pairs = [("a", "b=c"), ("a=b", "c"), ("a", None), (None, "a"), ("null", None), (None, "null"), (None, None), ("1", "2=null")]
    rows = [(i, *pairs[i % 8], "w " * (1 + i % 8)) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    found = {(r.key, r.n) for r in mixing.plan(docs.withColumn("tokens", mixing.word_count(F.col("text"))), mixing.Target(), ("source", "lang")).collect()}
    assert len({key for key, _ in found}) == 8 and sorted(n for _, n in found) == [100 * n for n in range(1, 9)]
    # One column that tells the same combinations apart gives the same schedule.
    one = docs.withColumn("both", F.to_json(F.array("source", "lang")))
    plain = lambda source: sorted((r.doc_id, r.epoch, r.place) for r in mixing.mix(one, mixing.Target(entropy=0.98), seed=3, source=source).collect())
    assert plain(("source", "lang")) == plain("both") == plain(["both"]) != plain("source")


def test_whole_schedule_leaves_no_document_out(spark):
    docs = mix_docs(spark).where("doc_id <> 5002")
    some, every = (mixing.mix(docs, mixing.Target(entropy=0.9, max_repeat=4.0, whole=x), seed=3).collect() for x in (False, True))
    ids = {r.doc_id for r in docs.where("source IS NULL OR source <> 'empty'").select("doc_id").union(docs.where("doc_id IS NULL").select("doc_id")).collect()} - {5000, 5001}
    assert {r.doc_id for r in every} | {None} == ids | {None} != {r.doc_id for r in some} | {None}
    n = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect() if r.n}
    used = {source: sum(r.tokens for r in every if r.source == source) / n[source] for source in n}
    assert used["big"] == 1 and used["mid"] > 1.2 and max(used.values()) <= 4


@pytest.mark.parametrize("target", [mixing.Target(entropy=1.0, max_repeat=1.5), mixing.Target(entropy=0.0), mixing.Target(budget=0), mixing.Target(budget=10**7, max_repeat=2.0)])
def test_limits_hold(spark, target):
    docs = mix_docs(spark)
    rows = mixing.mix(docs, target).groupBy("source").agg(F.sum("tokens").alias("n")).collect()
    counts = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert all(r.n <= target.max_repeat * counts[r.source] for r in rows)
    assert target.budget is None or sum(r.n for r in rows) <= target.budget


def test_mixing_nothing(spark):
    assert mixing.mix(mix_docs(spark).limit(0)).collect() == []


# --- pages ----------------------------------------------------------------------------------------------------------


def page(body, extra=""):
    return f'<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">menu</a></ul></nav>{extra}{body}<footer>&copy; host</footer></body></html>'


PAGES = {
    "<article><h1>A &amp; B</h1><p>one <b>two\n\n</b>three<br>four<p>five &#233; &copy</article>": "A & B\none two three four\nfive é ©",
    "<div id=main><p>no article</p><div class='ad'>buy</div><aside>side</aside><form><p>f</p></form>tail</div>": "no article\ntail",
    "<article><p>text</p><section class='comments'><p>reader</p></section><ul><li>a<li>b</ul></article>": "text\na\nb",
    "<article><p>cut <!-- never closed": "cut",
    "<article><p>a < b and <3</p><p>x</article": "a < b and <3\nx",
    "<header>top</header><main><header><h1>H</h1></header><p>m</p><div class=\"share-buttons\">s</div></main>": "H\nm",
    "": "",
    "plain text only": "plain text only",
}


def test_main_text_of_hard_pages(spark):
    rows = [(i, "s://one.example/" + str(i), page(b), "mine") for i, b in enumerate(PAGES)]
    rows += [(90, None, None, "m"), (91, "s://two.example/", "", "m"), (92, "nohost", "<article><p>" + "w " * 100_000 + "</p></article>", "m"), (92, "nohost", "<article>x</article>", "m")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = {(r.page_id, r.url, len(r.text)): r.text for r in page_template.extract(table).collect()}
    got = {k[0]: v for k, v in out.items()}
    assert [got[i] for i in range(len(PAGES))] == list(PAGES.values())
    assert got[90] == got[91] == "" and (92, "nohost", 199_999) in out and (92, "nohost", 1) in out
    assert page_template.extract(table.limit(0)).collect() == []


def test_template_text_goes_where_elements_do_not_tell(spark):
    body = lambda i: f"<div><p>Welcome to the site</p></div><div><h1>title {i}</h1><p>story {i} of many</p></div><div><p>All rights reserved</p></div>"
    rows = [(i, f"s://h.example/{i}", page(body(i))) for i in range(30)] + [(100 + i, f"s://small.example/{i}", page(body(i))) for i in range(3)]
    rows += [(200 + i, "s://single.example/", page(body(7))) for i in range(2)]
    out = {r.page_id: r.text for r in page_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"title {i}\nstory {i} of many" for i in range(30))
    # Few pages tell as much, if they differ; a host of one page has no template.
    assert [out[100 + i] for i in range(3)] == [f"title {i}\nstory {i} of many" for i in range(3)]
    assert out[200] == "Welcome to the site\ntitle 7\nstory 7 of many\nAll rights reserved"


MARKED = {
    '<body class="single has-sidebar comment-open"><article><p>a</article>': "a",
    '<body id="search"><div class="content-with-sidebar"><p>a</div><div class="sidebar"><p>b</div>': "a",
    '<article class="post comment-open related"><h2 id="related-work">h</h2><section id="share-price"><p id="search-methods">s</p></section><p class="notice">n</article>': "h\ns\nn",
    '<h2 class="notice">h</h2><section id="related-work"><p>a</section><div id="site-footer">b</div><div id="comments">c</div>': "h\na",
    '<div class="menu"><p>m<main><p>a<div class="left-sidebar">b</div><div role="search">c</div></main></div>': "a",
    '<article><p>a</article><div class="comments"><article><p>reader</article></div><aside><article>b</article></aside>': "a",
    '<div id="comments"><article>reader</article></div><p>a': "a",
    "<main><p>if <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1</annotation></semantics></math> then</main>": "if x=1 then",
    '<div data-id="ads">a<div class=\'ad\'>b</div></div><div class="cookie-banner">c</div><div class="post_comments">d</div>': "a",
}


def test_words_in_names_mark_only_what_they_name():
    assert {html: page_template.main_text(html, {})[0] for html in MARKED} == MARKED


@pytest.mark.parametrize("name", ["article", "div"])
def test_copies_do_not_make_their_text_the_template(spark, name):
    body = lambda i: f"<{name}><h1>title {i}</h1>" + "".join(f"<p>part {k} of story {i}</p>" for k in range(60)) + f"</{name}>"
    story = lambda i: "\n".join([f"title {i}", *(f"part {k} of story {i}" for k in range(60))])
    rows = [(i, f"s://copies.example/{i}", page(body(max(i - 89, 0)))) for i in range(100)]
    out = {r.page_id: r.text for r in page_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [out[i] for i in range(100)] == [story(max(i - 89, 0)) for i in range(100)]


def test_text_in_the_article_stays_though_all_pages_have_it(spark):
    rows = [(i, f"s://same.example/{i}", page(f"<article><p>Dear readers</p><p>story {i}</p><p>Yours</p></article><p>All rights reserved</p>")) for i in range(20)]
    out = {r.page_id: r.text for r in page_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"Dear readers\nstory {i}\nYours" for i in range(20))


def test_classes_out_of_order_are_not_valid():
    assert page_template.order_of([1, 2, 3, 1, 2, 3]) == page_template.order_of([1, 2, 3]) != 0
    assert page_template.order_of([1, 2, 3, 2, 1, 3]) == 0 == page_template.order_of([1, 2, 1])


# --- vectors --------------------------------------------------------------------------------------------------------


def plain_top(queries, vectors, k):
    out = []
    for q, v in {(q, tuple(v)) for q, v in queries}:
        best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("reach", [3, 40, 2**30])
def test_top_k_equals_brute_force(spark, monkeypatch, reach):
    monkeypatch.setattr(maxscore, "CANDIDATES", 100)
    monkeypatch.setattr(maxscore, "STRIDE", 16)
    monkeypatch.setattr(maxscore, "QUERIES", 10)
    rng = np.random.default_rng(reach)
    vectors = [(int(i), [int(x) for x in rng.integers(-reach, reach, rng.integers(1, 12))]) for i in range(300)]
    vectors += [(i, vectors[0][1]) for i in range(300, 400)] + [vectors[7]]
    queries = [v for v in vectors if v[0] % 20 == 0] + [vectors[20], (1000, [0, 0])]
    frame = lambda rows: spark.createDataFrame([(i, v, "x") for i, v in rows] + [(None, [1], "x"), (5000, None, "x")], "id long, vector array<long>, score string")
    assert sorted(map(tuple, maxscore.top_k(frame(queries), frame(vectors), 7).collect())) == plain_top(queries, vectors, 7)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [0.1, -0.01]), (1, [float("nan"), 1.0]), (2, [None, 1.0]), (3, None), (4, [float("inf"), 1.0]), (5, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "id long, e array<float>")
    kept = table.where(maxscore.usable(F.col("e"))).select("id", maxscore.quantised(F.col("e")).alias("vector"))
    assert sorted(map(tuple, kept.collect())) == [(0, [6, -1]), (5, [64, 64])]
    assert maxscore.top_k(kept.where("id = 0"), kept.where("id = 0")).collect() == []
    assert maxscore.top_k(kept.limit(0), kept).collect() == []


# --- near duplicates ------------------------------------------------------------------------------------------------


def plain_links(texts, percent):
    sets = [frozenset(zip(*[t.lower().split()[i:] for i in range(5)])) or frozenset([tuple(t.lower().split())] if t.split() else []) for t in (t or "" for t in texts)]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("percent", [80, 85])
def test_dense_groups_lose_no_link(spark, monkeypatch, percent):
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    monkeypatch.setattr(near_dups, "SETS", 4)
    r = random.Random(percent)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(150)]
    texts = [None, "", " \t", "One two", "one  TWO", "one", " ".join(base), " ".join(base)]
    for _ in range(160):
        copy = list(base)
        for _ in range(r.randint(0, 9)):
            copy[r.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(80)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_shingles int, node string")
    rows = sorted(near_dups.near_duplicates(docs, near_dups.Rule(percent=percent)).collect())
    assert [(r.n_shingles, r.component_id) for r in rows] == plain_links(texts, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30_000))
    rows = [(7, text), (3, text.upper()), (3, text), (None, text), (None, None), (9, "a b c"), (9, "d e f")]
    out = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in out) == [(-1, -1, True), (-1, -1, True), (3, 3, True), (3, 3, True), (7, 3, False), (9, 9, True), (9, 9, True)]
    assert near_dups.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_lookups_meet_every_pair_within_the_threshold():
    rule = near_dups.Rule(percent=85)
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, rule.symbols)
        b = a.copy()
        b[rng.choice(rule.symbols, rule.threshold, replace=False)] ^= 1
        assert any((a[read] == b[read]).all() for _, read in rule.masks)
    n, p, d = rule.symbols, 0.15, rule.threshold
    assert sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(d + 1, n + 1)) < 1e-9


def test_shingles_are_those_of_the_definition():
    import pyarrow as pa

    texts = ["A b\x0bC d e F", "a B c d e f", "x y", "X\ty ", "É b c d e", "é b c d e", "a a a a a a a", None, " "]
    values, counts = shingles.shingle_sets(pa.array(texts))
    nodes = shingles.set_nodes(values, counts)
    assert counts.tolist() == [2, 2, 1, 1, 1, 1, 1, 0, 0]
    assert nodes[0] == nodes[1] and nodes[2] == nodes[3] and nodes[4] != nodes[5] and nodes[7] == 0


def test_components_of_chains_and_stars(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (201, 201)] + [(r.randint(300, 340), r.randint(300, 340)) for _ in range(20)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    linked = {x for e in edges if e[0] != e[1] for x in e}
    whole = {r.node: r.component for r in components(frame(edges), "a", "b").collect()}
    assert whole == {x: find(x) for x in linked}
    half = components(frame(edges[::2]), "a", "b")
    both = merged(half, frame(edges[1::2]))
    assert {r.node: r.component for r in both.collect()} == {x: find(x) for x in parent}
    assert components(frame([]), "a", "b").collect() == []
