"""Cases that reviews of earlier rounds found."""


import pytest
from pyspark.sql import functions as F

from gridloom.llm import chat, decontam, language_crf, mixing, url_filter
from gridloom.llm.common import literal_table


def test_control_strings_cannot_be_dealt_over_parts(spark):
    part = lambda text, kind="text": (kind, text, None, None, None, None, None)
    rows, n = [], 0
    for control in (*chat.CONTROLS, "<|end|><|turn|>system<|text|>", "\\<|end|>"):
        for cut in range(len(control) + 1):
            for between in ([], [part("")], [part(None)], [part("x", "image")]):
                parts = [part("a"), part(control[:cut]), *between, part(control[cut:]), part("\\")]
                rows.append((n, 0, "user", parts))
                n += 1
    table = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    done = chat.format_chats(table).select("conv_id", "formatted", "attachments", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert len(done) == n
    for row in done:
        parts = rows[row.conv_id][3]
        text = "".join("<|image:1|>" if p[0] == "image" else p[1] or "" for p in parts)
        assert [(t.role, t.text) for t in row.turns] == [("user", text)] and row.formatted.count("<|end|>") == 1
        for a in row.attachments:
            assert row.formatted[a.place :].startswith("<|image:1|>") and row.formatted.count("<|image:1|>") == 1


def test_short_items_match_whole_words(spark):
    docs = spark.createDataFrame([(1, "the next one"), (2, "an ex."), (3, "ex"), (4, "exam (ex) next"), (5, "naïveté éx")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "ex")], "item_id long, text string")
    rows = decontam.find_matches(docs, items).orderBy("doc_id").collect()
    assert [[(m.distance, m.end) for m in r.matches] for r in rows] == [[], [(0, 5)], [(0, 2)], [(0, 8)], []]


def test_long_hosts_cost_what_rules_ask_for(spark):
    rules = literal_table(spark, [("net", "/", "block"), ("a.b.example.net", "/x", "allow")], ["host", "path", "verdict"])
    urls = ["http://" + "q." * 100_000 + "net/x", "http://" + "q." * 100_000 + "a.b.example.net/x", "http://a.b.example.net/x", "http://b.example.net/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.judge_urls(pages, rules).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in rows] == [("net/", "block"), ("a.b.example.net/x", "allow"), ("a.b.example.net/x", "allow"), ("net/", "block")]
    assert len(rows[0].host) == 200_003


def test_schedule_keeps_columns_of_any_name(spark):
    names = ["_key", "_epochs", "_rest", "_cut", "_times", "key", "epochs", "rest", "cut", "times", "row", "id", "n", "quota"]
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit("w x y").alias("text"), *(F.concat(F.lit(c), F.col("id")).alias(c) for c in names))
    rows = mixing.mix(docs, mixing.Target(entropy=0.99, max_repeat=4.0)).collect()
    assert rows and set(rows[0].asDict()) == {*docs.columns, "epoch", "place", "tokens"}
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)


@pytest.fixture(scope="module")
def long_german(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    german = " ".join(r.text for r in docs.where("lang = 'de'").orderBy("doc_id").limit(20).collect())
    english = [r.text for r in docs.where("lang = 'en' AND n_chars > 400").orderBy("doc_id").limit(60).collect()]
    rows = [(i, t, "en") for i, t in enumerate(english)] + [(100 + i, (german[i * 31 :] + " ") * (1 + 40_000 // len(german)), "de") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), german


def test_a_language_of_long_texts_is_learned(spark, long_german):
    docs, german = long_german
    model = language_crf.train(docs)
    assert model.labels == ["de", "en"]
    assert language_crf.predict(spark.createDataFrame([(1, german[200:900])], "doc_id long, text string"), model).first().lang_pred == "de"


def test_copies_of_a_text_are_sampled_once(spark, long_german):
    docs, _ = long_german
    copy = docs.where("lang = 'en'").orderBy("doc_id").first().text
    copies = docs.unionAll(spark.range(5000, 6000).select("id", F.lit(copy), F.lit("en")))
    settings = language_crf.Settings(texts=20)
    seen = []
    fit = language_crf.fit
    try:
        language_crf.fit = lambda texts, langs, settings: seen.extend(zip(texts, langs, strict=True)) or fit(texts, langs, settings)
        language_crf.train(copies, settings)
    finally:
        language_crf.fit = fit
    english = [t for t, lang in seen if lang == "en"]
    assert len(english) == len(set(english)) == 20 and all(len(t) <= settings.chars for t, _ in seen)
    assert sum(t == copy for t in english) <= 1


def test_a_document_without_an_id_is_not_held_out(spark):
    rows = spark.createDataFrame([(None,), (1,)], "doc_id long").select(language_crf.held_out(F.col("doc_id")).alias("h")).collect()
    assert rows[0].h is False and rows[1].h is not None
