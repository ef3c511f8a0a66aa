"""The corpus pipeline: what each stage does to planted cases, and hard rows through all of them."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from gridloom.llm import near_dups
from gridloom.llm.common import materialise

WORDS = "the of and to in is was for that on"


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def added(documents, rows):
    return documents.unionByName(documents.sparkSession.createDataFrame(rows, documents.schema))


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "pii", "mix"]


def test_each_stage_takes_effect_and_keeps_clean_documents(spark, sf_dir, documents):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    clean = documents.where("lang = 'en' AND n_chars BETWEEN 600 AND 3000").orderBy("doc_id").first().text
    rows = [
        (9001, None, "en", "s", None), (9002, "12 34 !!", "en", "s", 8), (9003, clean, None, None, len(clean)),
        (9004, clean.upper(), "en", "s", len(clean)), (9005, clean[:200] + " " + item + " " + clean[200:400], "en", "s", 0),
        (9006, "the one of them is that4 and mail a.b@mail.example.com for 4111 1111 1111 1111", "en", "s", 1), (None, clean[100:500], "en", "s", 1),
    ]
    docs, stages = added(documents, rows), dict(corpus_pipeline.STAGES)
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]
    start = set(ids(docs))

    known = stages["language_id"](spark, docs, sf_dir)
    assert known.columns == docs.columns and start - set(ids(known)) == {9001, 9002}

    parted = stages["near_dedup"](spark, docs, sf_dir)
    groups = {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs, corpus_pipeline.NEAR).collect()}
    assert parted.columns == docs.columns and {i for i in ids(parted)} == {i for i in start if groups[i] == i}
    assert not {9003, 9004} & set(ids(parted)) and {9001, 9002, None} <= set(ids(parted))

    free = stages["decontaminate"](spark, docs, sf_dir)
    assert free.columns == docs.columns and 9005 not in ids(free) and {9001, 9003, None} <= set(ids(free))

    private = stages["pii"](spark, docs, sf_dir)
    assert private.columns == docs.columns and sorted(ids(private), key=str) == sorted(ids(docs), key=str)
    text = private.where("doc_id = 9006").first()
    assert "a.b@mail" not in text.text and "4111 1111" not in text.text and text.n_chars == len(text.text)

    mixed = stages["mix"](spark, docs, sf_dir)
    assert mixed.columns == [*docs.columns, "epoch", "place", "tokens"] and mixed.where("source IS NULL").count() > 0
    assert set(ids(mixed)) <= start - {9001}


def test_languages_that_were_not_learned_go(spark, sf_dir, documents):
    r = random.Random(8)
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä"
    noise = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(60))
    parts = [documents.where(f"lang = '{x}' AND n_chars > 500").orderBy("doc_id").first().text[:200] for x in ("en", "de", "fr", "es")]
    texts = [finnish, noise, "всички хора се раждат свободни и равни по достойнство и права", " ".join(parts), parts[1]]
    docs = added(documents, [(9001 + i, t, None, "s", len(t)) for i, t in enumerate(texts)])
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    for known in (docs, docs.where("lang IS NULL OR lang IN ('en', 'de')")):  # the fewer languages, the higher each one's share
        kept = {r.doc_id for r in stage(spark, known, sf_dir).select("doc_id").collect()}
        assert not {9001, 9002, 9003} & kept and 9005 in kept
        assert {r.doc_id for r in known.where("doc_id < 9001").collect()} <= kept
    assert {9004, 9005} <= {r.doc_id for r in stage(spark, docs, sf_dir).select("doc_id").collect()}


def test_no_documents(spark, sf_dir, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), sf_dir).count() == 0


def test_whole_run(spark, sf_dir, documents):
    out = corpus_pipeline.run(spark, sf_dir)
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert 0.5 * documents.count() < len(kept) < documents.count()


def test_rows_that_share_an_id_go_by_their_own_text(spark, documents):
    r = random.Random(9)
    text = lambda: " ".join(r.choice(["stone", "river", "cloud", "amber", "violet", "north", "lamp", "copper"]) + str(r.randint(0, 99)) for _ in range(60))
    a, b, c = text(), text(), text()
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (5, c), (5, c), (5, c.upper()), (6, c + " more words"), (7, None), (7, None), (7, ""), (None, a), (8, c[::-1]), (8, c[::-1] + " end")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], documents.schema)
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    found = sorted(((x.doc_id, x.text) for x in kept.collect()), key=str)
    assert kept.columns == docs.columns
    assert [x for x in found if x[0] in (1, 2, 3)] == [(1, a), (2, b)]
    assert len([x for x in found if x[0] == 5]) == 1 and not [x for x in found if x[0] == 6]
    assert sorted(str(x[1]) for x in found if x[0] == 7) == ["", "None", "None"] and (None, a) in found
    assert len([x for x in found if x[0] == 8]) == 1


def test_language_found_in_a_text_is_its_language(spark, sf_dir, documents):
    first = lambda lang: documents.where(f"lang = '{lang}' AND n_chars BETWEEN 600 AND 3000").orderBy("doc_id").first().text
    de, en, fr = first("de"), first("en"), first("fr")
    cut = lambda text: text[:300]
    rows = [(9001, fr, None), (9002, de, "en"), (9003, de, "de"), (9004, cut(en) + " " + cut(fr), "fr"), (9005, cut(en) + " " + cut(fr), "en"), (9006, "12", "en")]
    docs = added(documents, [(i, t, lang, "s", len(t)) for i, t, lang in rows])
    out = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, sf_dir)
    found = {r.doc_id: r.lang for r in out.collect()}
    assert {i: found[i] for i in found if i > 9000} == {9001: "fr", 9002: "de", 9003: "de", 9004: "fr", 9005: "en"}
    assert out.schema.simpleString() == docs.schema.simpleString()


def test_schedule_goes_by_the_language_found(spark, sf_dir, documents):
    stages = dict(corpus_pipeline.STAGES)
    # The model is not learned from documents held out, so it is the same without their languages.
    bare = documents.withColumn("lang", F.expr("CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 <> 0 THEN lang END"))
    plan = lambda docs: sorted((r.doc_id, r.epoch, r.place, str(r.lang)) for r in stages["mix"](spark, docs, sf_dir).collect())
    stated, found = (materialise(stages["language_id"](spark, docs, sf_dir), "test-language") for docs in (documents, bare))
    used = {(i, epoch) for i, epoch, *_ in plan(stated)}
    assert plan(found) == plan(stated)
    assert {i for i, _ in used} == {r.doc_id for r in stated.where("text RLIKE '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'").collect()}
    assert {(i, epoch) for i, epoch, *_ in plan(bare)} != used != {(i, epoch) for i, epoch, *_ in plan(documents.withColumn("lang", F.lit("en")))}
