"""A corpus made ready for training: five stages, each written as Parquet before the next one reads it.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents it is given; its decisions take effect in what it
returns. All but the last return the columns of ``documents``. Null or empty texts, null ids and languages, repeated
rows and extra columns are dealt with as the operators in ``gridloom.llm`` say; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontam, language_crf, mixing, near_dups, pseudonyms
from gridloom.llm.common import importable, materialise, table

#: Share of a text's words from which on its language is the one found, whatever is stated.
SURE = 0.85
NEAR = near_dups.Rule(percent=80)
#: Edits per character of a benchmark item within which a text holds it.
EDITS = 0.05
#: A key for tests; a real one comes from a vault.
KEY = "not a secret"
MIX = mixing.Target(entropy=0.95, max_repeat=4.0, whole=True)
SEED = 11


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in languages that the labelled ones teach, also if they switch between them; others go, by their letters, as do
    texts without a letter.

    ``lang`` is the language that the field finds in the text: where none is stated, and where it has nearly all words
    (``SURE``). Else the stated one stays, as in texts that are mixed or too short to tell. ``mix`` goes by it.
    """
    importable(spark)
    found = language_crf.predict(docs, language_crf.train(docs), known=True).where("known")
    lang = F.when(F.col("lang").isNull() | (F.col("score") >= SURE), F.col("lang_pred")).otherwise(F.col("lang"))
    return found.withColumn("lang", lang).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, once; ids that are to go are joined, not texts.

    Rows that share an id are judged by their own text: one may go and another stay. Of those that share id and group one
    stays, the first by a hash of the text, of equal rows the first by their other columns. Texts without words, and rows
    without an id, stay.
    """
    importable(spark)
    found = materialise(near_dups.near_duplicates(docs, NEAR), "near-found")
    words = found.where("kept AND cluster IS NOT NULL AND doc_id IS NOT NULL")
    first = words.groupBy("doc_id", "cluster").agg(F.min("text_hash").alias("first"), F.max("text_hash").alias("last")).where("first < last")
    other = words.join(first, ["doc_id", "cluster"]).where("text_hash <> first")
    gone = found.where("NOT kept").unionByName(other.select(found.columns)).select("doc_id", "text_hash").distinct()
    gone = materialise(gone, "near-gone")
    # Ids of which all rows go are most, and no texts need be hashed for them.
    rows = found.select("doc_id", "text_hash").distinct().groupBy("doc_id").agg(F.count("*").alias("n"))
    marked = gone.groupBy("doc_id").agg(F.count("*").alias("gone")).join(rows, "doc_id")
    whole = materialise(marked.where("gone = n").select("doc_id"), "near-gone-ids")
    some = materialise(gone.join(marked.where("gone < n").select("doc_id"), "doc_id"), "near-gone-rows")
    twice = materialise(words.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "near-twice")
    kept = docs.join(whole, "doc_id", "left_anti").select(docs.columns)
    if some.isEmpty() and twice.isEmpty():
        return kept
    hashed = kept.select(F.struct(*docs.columns).alias("row"), "doc_id", near_dups.text_hash(F.col("text")).alias("text_hash"))
    kept = hashed.join(some, ["doc_id", "text_hash"], "left_anti")
    columns = [c for c in docs.columns if c not in ("doc_id", "text")]
    once = kept.join(twice, ["doc_id", "text_hash"], "left_semi").select("row.*")
    once = once.groupBy("doc_id", "text").agg(F.min(F.struct(*columns)).alias("rest")).select("doc_id", "text", "rest.*").select(docs.columns)
    return kept.join(twice, ["doc_id", "text_hash"], "left_anti").select("row.*").unionAll(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    found = decontam.find_matches(docs, table(spark, sf_dir, "benchmark"), EDITS)
    return found.where(F.size("matches") == 0).select(docs.columns)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; ``n_chars`` follows the text."""
    done = pseudonyms.pseudonymise(docs, KEY)
    changed = F.when(F.size("pii") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", changed).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training schedule: a row for each time a document is used, with ``epoch``, ``place`` and ``tokens``. Weights are
    those of each source's languages: a rare one is used more often, and every document with words once at least."""
    return mixing.mix(docs, MIX, seed=SEED, source=("source", "lang"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", pseudonymise),
    ("mix", mix_sources),
]

#: Forward-backward, MinHash buckets and keyed permutations have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
