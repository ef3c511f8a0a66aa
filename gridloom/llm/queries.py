"""Registered queries of the operators in this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import chat, decontam, divergence, language_crf, maxscore, merkle, mixing, near_dups, page_template, pseudonyms, repeats, token_counts, url_filter
from gridloom.llm.common import literal_table, table

#: A key for tests; a real one comes from a vault.
PII_KEY = "not a secret"

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op7_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = literal_table(spark, URL_RULES, ["host", "path", "verdict"])
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = """
WITH parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC) AS place
  FROM parsed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT parsed.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fits WHERE place = 1) f ON parsed.page_id = f.page_id
"""

CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op2_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = literal_table(spark, [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], ["conv_id", "turn", "role", "text"])
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra.select("conv_id", "turn", "role", "text"))
    done = chat.format_chats(rows.withColumn("parts", chat.text_part(F.col("text"))))
    turns, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    done = done.withColumns({"turns": turns, "loss": loss})
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in chat.CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


OP2_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
sized AS (
  SELECT *, length('<|turn|>' || {_escaped("role")} || '<|text|>' || {_escaped("text")} || '<|end|>') AS n FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

def op5_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return done.select("doc_id", "text", F.size("pii").cast("bigint").alias("n_found"), F.array_join("pii.kind", ",").alias("kinds"))


MIX = mixing.Target(entropy=0.998, max_repeat=4.0)
MIX_SEED = 7


def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, MIX, seed=MIX_SEED).select("doc_id", "source", "epoch", "place", "tokens")


def mix_sql(docs: str, columns: str) -> str:
    """The schedule for ``docs`` as SQL; the bisection is a recursion over lists of all sources' shares."""
    place = lambda epoch: f"CAST('0x' || substr(md5('{MIX_SEED}|' || ({epoch}) || '|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT)"
    z = lambda a: f"list_sum(list_transform(ps, lambda x: exp({a} * ln(x))))"
    entropy = lambda a: f"(ln({z(a)}) - list_sum(list_transform(ps, lambda x: exp({a} * ln(x)) * {a} * ln(x))) / {z(a)})"
    repeat = lambda a: f"(list_max(list_transform(ps, lambda x: exp({a} * ln(x)) / (x * total))) * total / {z(a)})"
    mid = "((lo + hi) / 2)"
    return f"""
WITH RECURSIVE counted AS (
  SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS tokens FROM {docs}),
sums AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS n FROM counted GROUP BY source HAVING sum(tokens) > 0),
lists AS (SELECT list(n / CAST(total AS DOUBLE)) AS ps, CAST(any_value(total) AS DOUBLE) AS total
          FROM sums, (SELECT sum(n) AS total FROM sums)),
even(i, lo, hi) AS (
  SELECT 0, CASE WHEN {entropy("1e0")} >= {MIX.entropy} * ln(len(ps)) THEN 1e0 ELSE 0e0 END, 1e0 FROM lists
  UNION ALL
  SELECT i + 1, CASE WHEN {entropy(mid)} >= {MIX.entropy} * ln(len(ps)) THEN {mid} ELSE lo END,
         CASE WHEN {entropy(mid)} >= {MIX.entropy} * ln(len(ps)) THEN hi ELSE {mid} END FROM even, lists WHERE i < {mixing.STEPS}),
seldom(i, lo, hi) AS (
  SELECT 0, 0e0, CASE WHEN {repeat("0e0")} <= {MIX.max_repeat} THEN 0e0 ELSE 1e0 END FROM lists
  UNION ALL
  SELECT i + 1, CASE WHEN {repeat(mid)} <= {MIX.max_repeat} THEN lo ELSE {mid} END,
         CASE WHEN {repeat(mid)} <= {MIX.max_repeat} THEN {mid} ELSE hi END FROM seldom, lists WHERE i < {mixing.STEPS}),
exponent AS (SELECT round(greatest((SELECT max(lo) FROM even), (SELECT min(hi) FROM seldom)), 6) AS a),
powered AS (SELECT source, n, exp(a * ln(n / CAST((SELECT sum(n) FROM sums) AS DOUBLE))) AS pw FROM sums, exponent),
quotas AS (
  SELECT source, n, CAST(least(floor(round(pw / (SELECT sum(pw) FROM powered) * (SELECT sum(n) FROM sums), 3)), floor(n * {MIX.max_repeat})) AS BIGINT) AS quota
  FROM powered),
plan AS (SELECT source, n, quota, CAST(quota // n AS INTEGER) AS epochs, quota % n AS rest FROM quotas),
placed AS (
  SELECT c.*, epochs, rest, {place("epochs + 1")} AS last_place
  FROM counted c JOIN plan ON c.source IS NOT DISTINCT FROM plan.source WHERE tokens > 0),
summed AS (
  SELECT *, epochs + CASE WHEN sum(tokens) OVER (PARTITION BY source ORDER BY last_place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest
                          THEN 1 ELSE 0 END AS times
  FROM placed),
used AS (SELECT *, CAST(unnest(range(1, times + 1)) AS INTEGER) AS epoch FROM summed)
SELECT {columns}, epoch, {place("epoch")} AS place, tokens FROM used
"""


def op9_edit_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"), F.col("matches.item_id").alias("item_ids"), F.array_min("matches.distance").alias("edits")
    )


def op6_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op10_hamming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), near_dups.Rule(percent=85)).select("doc_id", "n_shingles", "component_id", "kept")


def op1_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_crf.train(docs)
    found = language_crf.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_crf.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_template_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_template.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op3_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(maxscore.usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").alias("id"), maxscore.quantised(F.col("embedding")).alias("vector"))
    return maxscore.top_k(vectors.where("id % 20 = 0"), vectors, 20)


OP3_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 20
"""

TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op11_bitmap_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = [*(F.col(c) for c in merkle.FIELDS[:-1]), F.when(changed, F.expr(TAMPERED)).otherwise(F.col("text"))]
    made = merkle.manifest(docs, other=other).withColumn("folded_root", merkle.fold(F.col("other"), F.col("path")))
    return made.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def merkle_sql(levels: int) -> str:
    """The tree as SQL, for sources, and numbers of sources, of at most ``16 ** levels``."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    hashed = lambda text: "sha256(" + " || ".join(field(c) for c in (*merkle.FIELDS[:-1], text)) + ")"
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

    def tree(name: str, start: str) -> str:
        parts = [f"{name}0 AS ({start})"]
        for i in range(levels):
            parts.append(f"""{name}{i + 1} AS (
  SELECT tree, CAST((size + 15) // 16 AS BIGINT) AS size, rank // 16 AS rank,
         CASE WHEN any_value(size) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY rank)) END AS h
  FROM {name}{i} GROUP BY tree, size, rank // 16)""")
        return ",\n".join(parts)

    def climb(name: str, start: str) -> str:
        parts = [f"{name}_up0 AS ({start})"]
        for i in range(levels):
            parts.append(f"""{name}_up{i + 1} AS (
  SELECT u.id, u.tree, u.rank // 16 AS rank,
         any_value(u.proof) || coalesce(string_agg(n.h, '' ORDER BY n.rank) FILTER (n.rank <> u.rank), '') AS proof,
         CASE WHEN any_value(n.size) = 1 THEN any_value(u.folded)
              ELSE sha256(string_agg(CASE WHEN n.rank = u.rank THEN u.folded ELSE n.h END, '' ORDER BY n.rank)) END AS folded
  FROM {name}_up{i} u JOIN {name}{i} n ON n.tree = u.tree AND n.rank // 16 = u.rank // 16
  GROUP BY u.id, u.tree, u.rank)""")
        return ",\n".join(parts)

    leaves = f"""SELECT row_number() OVER () AS id, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {hashed("text")}) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS size, {hashed("text")} AS h,
         CASE WHEN {crc} % 5 = 0 THEN {hashed(TAMPERED)} ELSE {hashed("text")} END AS other
  FROM documents"""
    return f"""
WITH leaves AS MATERIALIZED ({leaves}),
{tree("t", "SELECT tree, size, rank, h FROM leaves")},
{climb("t", "SELECT id, tree, rank, '' AS proof, other AS folded FROM leaves")},
{tree("s", f"SELECT 0 AS tree, count(*) OVER () AS size, tree - 1 AS rank, h FROM t{levels}")},
{climb("s", f"SELECT id, 0 AS tree, tree - 1 AS rank, proof, folded FROM t_up{levels}")}
SELECT l.doc_id, l.h AS leaf, t.h AS subroot, s.h AS root, sha256(u.proof) AS proof_sha256, u.folded AS folded_root, u.folded = s.h AS verified
FROM leaves l JOIN t{levels} t ON t.tree = l.tree JOIN s_up{levels} u ON u.id = l.id, s{levels} s
"""


def op12_run_length_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, lang_total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN totals USING (lang, source) LEFT JOIN langs USING (lang)),
cells AS (
  SELECT g.lang, g.source, k.term, lang_n, coalesce(n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(n, 0) + 5) // (total + 5 * v) AS p, 1 + 1000000000::HUGEINT * (lang_n + 5) // (lang_total + 5 * v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM cells WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(place AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found)
WHERE part = 'pair' OR place <= 50
"""


def op13_deep_shallow_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    "op3_maxscore_topk": op3_maxscore_topk,
    "op4_template_extract": op4_template_extract,
    "op1_crf_language_id": op1_crf_language_id,
    "op10_hamming_dedup": op10_hamming_dedup,
    "op6_pretoken_counts": op6_pretoken_counts,
    "op9_edit_decontam": op9_edit_decontam,
    "op8_temperature_mix": op8_temperature_mix,
    "op5_feistel_pii": op5_feistel_pii,
    "op2_chat_parts": op2_chat_parts,
    "op7_bloom_cascade": op7_bloom_cascade,
    "op11_bitmap_merkle": op11_bitmap_merkle,
    "op12_run_length_divergence": op12_run_length_divergence,
    "op13_deep_shallow_dedup": op13_deep_shallow_dedup,
}

ORACLE = {
    "op3_maxscore_topk": OP3_SQL,
    "op8_temperature_mix": mix_sql("documents", "doc_id, source"),
    "op2_chat_parts": OP2_SQL,
    "op7_bloom_cascade": OP7_SQL,
    "op11_bitmap_merkle": merkle_sql(6),
    "op12_run_length_divergence": OP12_SQL,
}
