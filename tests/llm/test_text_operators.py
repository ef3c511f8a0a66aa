"""Chat formatting, pseudonyms, token counts, language and decontamination on hard cases."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import chat, decontam, language_crf, pseudonyms, token_counts

# --- chat -----------------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, formatted string, rows string"


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, TURNS).withColumn("parts", chat.text_part(F.col("text")))
    done = chat.format_chats(turns)
    return done.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))


def test_chat_reads_back_what_it_wrote(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|>", "\\", "\\\\<|", "<\\|end|>", "", None, "a\n\U0001f600<s>", "x" * 200_000, "<|turn|>user<|text|>"]
    rows = [(1, i, ("user", "assistant")[i % 2], t, "x", "y") for i, t in enumerate(nasty)]
    rows += [(None, None, None, None, None, None), (2, 5, "assistant", "b", "", ""), (2, 5, "assistant", "b", "", ""), (2, None, "<|end|>", "first", "", "")]
    by_id = {r.conv_id: r for r in formatted(spark, rows).collect()}
    assert [(t.role, t.text) for t in by_id[1].turns] == [(("user", "assistant")[i % 2], t or "") for i, t in enumerate(nasty)]
    assert by_id[1].loss == "".join(t or "" for t in nasty[1::2])
    assert [(t.role, t.text) for t in by_id[2].turns] == [("<|end|>", "first"), ("assistant", "b"), ("assistant", "b")]
    assert [(t.role, t.text) for t in by_id[None].turns] == [("", "")] and by_id[None].loss_spans == []


def test_chat_parts_become_numbered_placeholders(spark):
    part = lambda kind, **x: (kind, x.get("text"), x.get("ref"), x.get("width"), x.get("height"), x.get("seconds"), x.get("pages"))
    rows = [
        (1, 1, "assistant", [part("text", text="see "), part("document", ref="d", pages=3), part("text", text=" <|image:1|>")]),
        (1, 0, "user", [part("image", ref="i", width=28, height=15), part("text", text="é and"), part("audio", ref="a", seconds=1.01), part(None)]),
        (2, 0, "user", None),
        (2, 1, "user", []),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    one, two = chat.format_chats(turns).orderBy("conv_id").collect()
    assert [(a.number, a.kind, a.ref, a.tokens) for a in one.attachments] == [(1, "image", "i", 4), (2, "audio", "a", 26), (3, "document", None, 1), (4, "document", "d", 768)]
    for a in one.attachments:
        assert one.formatted[a.place :].startswith(f"<|{a.kind}:{a.number}|>")
    assert one.expanded_tokens == 799 and one.formatted.count("<|image:1|>") == 1
    assert two.attachments == [] and two.n_turns == 2


def test_chat_without_rows(spark):
    assert formatted(spark, []).collect() == []


# --- pseudonyms -----------------------------------------------------------------------------------------------------

HARD = [
    (1, "a.b@mail.example.com +1 (017) 555-7713 4952935900253052 161.17.88.162! 2024-02-29 29.02.2023 01.03.2023", "x"),
    (2, "5927243074273351 999.1.1.1 1.2.3.4.5 12345678901234567890123", "not valid: as they are"),
    (3, None, None),
    (4, "", ""),
    (5, "4111 1111 1111 1111, 4111-1111-1111-1112; a.b@mail.example.com", "x"),
    (5, "4111 1111 1111 1111, 4111-1111-1111-1112; a.b@mail.example.com", "x"),
    (None, 'token = "3fdf5a35c7b8d733c0b5c7d364eda8ac88d929d1" ' + "word " * 50_000 + "10.0.0.1", "long"),
]


def test_pseudonyms_keep_format_and_can_be_restored(spark):
    docs = spark.createDataFrame(HARD, "doc_id long, text string, pii string")
    done = pseudonyms.pseudonymise(docs, "k")
    rows = done.collect()
    assert done.columns == ["doc_id", "text", "pii"] and len(rows) == len(HARD)
    assert [p.kind for p in rows[0].pii] == ["email", "phone", "card", "ipv4", "date", "date"]
    assert rows[1].text == HARD[1][1] and rows[1].pii == [] and rows[2].text is None and rows[2].pii == [] and rows[3].text == ""
    for row, (_, text, _) in zip(rows, HARD, strict=True):
        for p in row.pii:
            assert p.value in text and p.pseudonym in row.text and p.value != p.pseudonym
    digits = "".join(c for c in rows[4].pii[0].pseudonym if c.isdigit())
    checks = [int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits))]
    assert sum(checks) % 10 == 0 and rows[4].pii[0].pseudonym[4] == " "
    assert rows[0].pii[0].pseudonym == rows[4].pii[1].pseudonym == rows[5].pii[1].pseudonym
    assert [r.text for r in pseudonyms.pseudonymise(done, "k", inverse=True).collect()] == [t for _, t, _ in HARD]
    assert pseudonyms.pseudonymise(docs, "other").first().text != rows[0].text


SHAPES = {
    "date": ["2024-01-05T10:00:00Z"],
    "phone": ["+44 20 7946 0958", "+49 30 123456", "+1 555 123 4567", "555 123 4567", "+442079460958", "+44 (20) 7946-0958"],
    "card": ["3782-822463-10005", "3782.822463.10005", "4111.1111.1111.1111", "NO12 4111 1111 1111 1111"],
    "iban": ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"],
    "ssn": ["123-45-6789"],
    "ipv6": ["2001:db8:85a3:0:0:8a2e:370:7334", "2001:db8::1", "FE80::12:34"],
}


def test_pseudonyms_of_other_shapes_of_values(spark):
    values = [(kind, v) for kind, of in SHAPES.items() for v in of]
    odd = ["DE88370400440532013000", "std::vector 12:30:45 ad::be", "1 555 123 4567 8", "DE89 3704 0044 0532 0130 01"]
    texts = [f"on {v}, and ({v})" for _, v in values] + odd
    done = pseudonyms.pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1), "k")
    rows = sorted(done.collect())
    for (kind, value), row in zip(values, rows, strict=False):
        assert [p.kind for p in row.pii] == [kind] * 2 and value not in row.text, row
        p = row.pii[0]
        assert p.value in value and len(p.value) == len(p.pseudonym) and p.value[:2] == p.pseudonym[:2] or kind not in ("iban",)
    assert [r.text for r in rows[len(values) :]] == odd
    assert [r.text for r in sorted(pseudonyms.pseudonymise(done, "k", inverse=True).collect())] == texts


def test_dates_are_permuted_without_collision(spark):
    days = spark.range(0, 72_900, 37).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = pseudonyms.pseudonymise(days, "k").select(F.col("pii")[0]["pseudonym"].alias("p"), "text")
    assert out.where("p <> text").count() == out.count() - out.where("p = text").count()
    assert out.select("p").distinct().count() == days.count() and out.where("p IS NULL").count() == 0


def test_pseudonyms_use_no_python(spark):
    plan = pseudonyms.pseudonymise(spark.createDataFrame(HARD, "doc_id long, text string, z string"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- token counts ---------------------------------------------------------------------------------------------------


def test_token_counts_of_hard_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    r = random.Random(2)
    signs = ["a", "é", "1", "²", " ", "  ", "\t", "\n", "\x0b", "\x85", "\xa0", "'s", "漢", "\U0001f600", "́", "<|endoftext|>", "\x00", "the", " thon"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(1, 40))) for _ in range(300)] + ["", "x" * 30_000, "the on " * 40_000, "<|endoftext|>"]
    rows = [(7 * i + (i % 3) * 10**12 - 100, t, 1) for i, t in enumerate(texts)] + [(50_001, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {x.doc_id: (x.n_bytes, x.n_tokens) for x in token_counts.count_tokens(docs, path, public_tokenizers.PATTERN).collect()}
    assert got == {i: (len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows}


def test_token_counts_add_up_rows_of_one_id_and_of_none(spark):
    docs = spark.createDataFrame([(1, "the on"), (1, "the on"), (None, "thonheat"), (None, None), (2, "")], "doc_id long, text string")
    count = lambda d: token_counts.count_tokens(d, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=3).collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count(docs)}
    assert got[1] == (12, 4, True) and got[2] == (0, 0, False) and got[None][0] == 8 and got[None][1] > 1
    assert count(docs.limit(0)) == []


def test_both_sides_of_the_token_join_read_one_shuffle(spark):
    docs = spark.createDataFrame([(1, "the on thonheat")], "doc_id long, text string")
    done = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    done.collect()
    assert "ReusedExchange" in done._jdf.queryExecution().executedPlan().toString()


# --- language -------------------------------------------------------------------------------------------------------


def plain_marginals(scores, transitions):
    k, a = scores.shape[1], np.exp(transitions)
    alpha, state = [], np.full(k, 1 / k)
    for row in np.exp(scores):
        state = (state @ a) * row
        state /= state.sum()
        alpha.append(state)
    beta, out = np.ones(k), []
    for row, forward in zip(np.exp(scores)[::-1], alpha[::-1], strict=True):
        out.append(forward * beta / (forward * beta).sum())
        beta = a @ (row * beta)
        beta /= beta.sum()
    return np.array(out[::-1]).reshape(len(scores), k)


def test_segments_give_exact_marginals():
    rng = np.random.default_rng(0)
    counts = np.array([0, 1, 5, 32, 33, 300, 0, 64, 97])
    scores, transitions = rng.normal(size=(counts.sum(), 3)), rng.normal(size=(3, 3))
    got, at = language_crf.marginals(scores, counts, transitions), 0
    for n in counts:
        assert np.allclose(got[at : at + n], plain_marginals(scores[at : at + n], transitions))
        at += n


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return language_crf.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_languages_of_hard_texts(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    english, german = (docs.where(f"lang = '{x}' AND n_chars > 500").first().text for x in ("en", "de"))
    texts = [None, "", " \n", "123 !!", english, german, english.upper(), " ".join([english] * 200), english[:400] + " " + german[:300], "漢字", "x" * 50_000]
    rows = [(i, t, "zz", 9.0) for i, t in enumerate(texts)]
    found = language_crf.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"), model, runs=True)
    out = found.orderBy("doc_id").collect()
    assert [r.lang_pred for r in out[:4]] == ["und"] * 4 and all(r.score == 0 and r.lang_runs == [] for r in out[:4])
    assert [out[i].lang_pred for i in (4, 5, 6, 7)] == ["en", "de", "en", "en"]
    assert [x.lang for x in out[8].lang_runs] == ["en", "de"] and out[4].lang == "zz"
    assert all(0 <= r.score <= 1 for r in out) and sum(x.words for x in out[7].lang_runs) == len(texts[7].split())


def test_language_model_needs_labels(spark):
    schema = "doc_id long, text string, lang string"
    none = language_crf.train(spark.createDataFrame([(1, "a b", None), (2, None, "en"), (None, "c", "en")], schema))
    assert none.labels == [] and language_crf.predict(spark.createDataFrame([(1, "a b", "en")], schema), none).first().lang_pred == "und"
    one = language_crf.train(spark.createDataFrame([(i, "a b c", "en") for i in range(20)], schema))
    assert language_crf.predict(spark.createDataFrame([(1, "q", "de")], schema), one).first().lang_pred == "en"
    assert language_crf.predict(spark.createDataFrame([], schema), one).collect() == []


# --- decontamination ------------------------------------------------------------------------------------------------


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_matches_are_all_within_the_budget():
    r = random.Random(3)
    for _ in range(300):
        items = [(i, "".join(r.choice("abcdef ") for _ in range(r.randint(10, 60))).strip()) for i in range(3)]
        text = "".join(r.choice("abcdef") for _ in range(r.randint(0, 30)))
        for _, t in items:
            t = list(t)
            for _ in range(r.randint(0, 7)):
                k = r.randrange(len(t))
                t[k : k + 1] = r.choice([[], ["x"], [t[k], "y"]])
                if not t:
                    break
            text += "".join(t) + "".join(r.choice("abcdef") for _ in range(r.randint(0, 9)))
        got = {x["item_id"]: x["distance"] for x in decontam.Matcher(items, 0.12).matches(text)}
        nearest = {i: plain_distance(t, text) for i, t in items if t}
        assert got == {i: d for i, d in nearest.items() if d <= int(len(dict(items)[i]) * 0.12)}


def test_decontamination_of_hard_rows(spark, monkeypatch):
    passage = "the quick brown fox jumps over the lazy dog near the old river bank at dawn"
    docs = [(1, "intro " + passage.upper().replace(" ", "\n ") + " outro", "m"), (2, passage.replace("quick", "quik"), "m"), (3, passage[:40], "m"), (4, None, None), (5, "", ""), (None, passage, "m")]
    docs += [(6, "word " * 100_000 + passage, "m"), (6, "word " * 100_000 + passage, "m")]
    items = [(10, passage, 1), (11, passage, 1), (None, passage, 1), (12, None, 1), (13, "", 1), (14, " \n", 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, matches string")
    bench = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    for block in (decontam.BLOCK_CHARS, 80):
        monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
        rows = decontam.find_matches(table, bench).collect()
        assert [r.doc_id for r in rows] == [d[0] for d in docs]
        assert [len(r.matches) for r in rows] == [3, 3, 0, 0, 0, 3, 3, 3]
        assert {m.distance for m in rows[0].matches} == {0} and {m.distance for m in rows[1].matches} == {1}
    assert decontam.find_matches(table, bench.limit(0)).where("size(matches) > 0").count() == 0
    assert decontam.find_matches(table.limit(0), bench).count() == 0
