"""Mixing sources to target weights: shares of tokens raised to an exponent, and a schedule that realises them.

With exponent 1 every source has the weight of its tokens, with 0 all sources have the same. Bisection finds the largest
exponent whose weights reach a target entropy, but no smaller one than lets every source be repeated within a limit.
Each source's share of the token budget is then realised as whole permutations of its documents, one per epoch, and
the first part of one more.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import ensure_checkpoint_dir, materialise

STEPS = 24
#: The order of an epoch is that of 60-bit hashes; cuts are found 12 bits at a time.
HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint")


def _names(source: str | Sequence[str]) -> list[str]:
    return [source] if isinstance(source, str) else list(source)


def _key(source: str | Sequence[str]) -> Column:
    """Source as a join key; null is a source of its own. Of several columns every combination is a source."""
    *more, last = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in _names(source)]
    # Lengths go before all but the last, so that no two combinations give the same key.
    return F.concat(*(x for part in more for x in (F.length(part).cast("string"), part)), last)


@dataclass(frozen=True)
class Target:
    """``entropy``: share of the largest possible entropy, the logarithm of the number of sources, that weights shall reach.
    ``max_repeat``: how often a source's tokens may be used at most. ``budget``: tokens to schedule; None: as many as
    there are. With ``whole`` it is the least that leaves no source short of one epoch, so that no document is left out."""

    entropy: float = 0.95
    max_repeat: float = 4.0
    budget: int | None = None
    whole: bool = False


def _bisect(holds: Callable[[float], bool], low_side: bool) -> float:
    """Where ``holds`` changes within [0, 1]: it holds below the place if ``low_side``, else above; the end on that side."""
    lo, hi = 0.0, 1.0
    if holds(hi if low_side else lo):
        return hi if low_side else lo
    for _ in range(STEPS):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if holds(mid) == low_side else (lo, mid)
    return lo if low_side else hi


def find_exponent(shares: DataFrame, target: Target, budget: int) -> float:
    """Exponent for ``shares(n, p)``, tokens and share of each source. Each step is one small aggregation.

    If even the natural shares need more repetition than allowed the exponent is 1; if even equal weights do not reach
    the entropy, as with a single source, it is 0 or what the limit allows.
    """
    sources = shares.count()

    def sums(a: float):
        powered = F.exp(a * F.log("p"))
        return shares.agg(F.sum(powered), F.sum(powered * a * F.log("p")), F.max(powered / F.col("n")), F.max(F.col("n") / powered)).first()

    def spread_enough(a: float) -> bool:
        z, zlog, _, _ = sums(a)
        return math.log(z) - zlog / z >= target.entropy * math.log(sources)

    def seldom_enough(a: float) -> bool:
        z, _, most, once = sums(a)
        return most * (once * z if target.whole else budget) / z <= target.max_repeat

    a = max(_bisect(spread_enough, True), _bisect(seldom_enough, False) if seldom_enough(1.0) else 1.0)
    return round(a, 6)


def plan(docs: DataFrame, target: Target, source: str | Sequence[str] = "source", tokens: str = "tokens") -> DataFrame:
    """One row per source with tokens: ``key``, ``n`` tokens, ``weight``, ``quota`` tokens to schedule, ``epochs`` whole
    permutations and ``rest`` tokens of one more. ``docs`` are aggregated by source before they are shuffled."""
    ensure_checkpoint_dir(docs.sparkSession)
    sums = docs.groupBy(_key(source).alias("key")).agg(F.sum(tokens).alias("n")).where("n > 0").checkpoint()
    all_tokens = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    budget = all_tokens if target.budget is None else target.budget
    shares = sums.withColumn("p", F.col("n") / F.lit(float(max(all_tokens, 1))))
    a = find_exponent(shares, target, budget) if all_tokens else 1.0
    powered = F.exp(a * F.log("p"))
    z, once = shares.agg(F.sum(powered), F.max(F.col("n") / powered)).first()
    z = z or 1.0
    weight = powered / z
    if target.whole:
        budget = math.ceil((once or 0.0) * z)
    # Rounded first: a product that is a whole number but for floating point is that number.
    quota = F.least(F.floor(F.round(weight * budget, 3)), F.floor(F.col("n") * F.lit(target.max_repeat)))
    if target.whole:
        quota = F.greatest(quota, F.col("n"))
    out = shares.select("key", "n", weight.alias("weight"), quota.cast("bigint").alias("quota"))
    return materialise(
        out.withColumn("epochs", F.floor(F.col("quota") / F.col("n")).cast("int")).withColumn("rest", F.col("quota") - F.col("epochs") * F.col("n")),
        "mix-plan",
    )


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in the permutation of an epoch."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def find_cuts(keys: DataFrame, rests: DataFrame) -> DataFrame:
    """Per source, the largest place up to which the tokens of ``keys(key, place, tokens)`` stay within ``rest``.

    A radix search: tokens are summed by the first 12 bits of the place; within the slice where the sum passes the rest, by
    the next 12, until that slice holds one place. Sums are combined before the shuffle and at most 4096 per source
    come together, so that a source of any size is no more work for a task than another. Documents of equal place are
    taken or left together.
    """
    state = materialise(rests.select("key", F.lit(0).cast("bigint").alias("prefix"), F.col("rest"), F.lit(-1).cast("bigint").alias("cut"), F.lit(False).alias("done")), "mix-cuts")
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        if not state.where("NOT done").head(1):
            break
        shift = HASH_BITS - LEVEL_BITS * level
        near = keys.join(state.where("NOT done").select("key", "prefix"), "key").where(F.shiftright("place", shift + LEVEL_BITS) == F.col("prefix"))
        slices = near.groupBy("key", F.shiftright("place", shift).alias("slice")).agg(
            F.sum("tokens").alias("t"), F.min("place").alias("first"), F.max("place").alias("last")
        )
        upto = Window.partitionBy("key").orderBy("slice")
        summed = slices.withColumn("upto", F.sum("t").over(upto)).join(state.where("NOT done").select("key", "rest"), "key")
        found = summed.groupBy("key").agg(
            F.max(F.when(F.col("upto") <= F.col("rest"), F.struct("slice", "last", "upto"))).alias("inside"),
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("slice", F.col("first"), F.col("last")))).alias("passing"),
        )
        state = materialise(
            state.join(found, "key", "left").select(
                "key",
                F.when(F.col("passing").isNull(), F.col("prefix")).otherwise(F.col("passing.slice")).alias("prefix"),
                (F.col("rest") - F.coalesce(F.col("inside.upto"), F.lit(0))).alias("rest"),
                F.greatest("cut", F.coalesce(F.col("inside.last"), F.lit(-1))).alias("cut"),
                (F.col("done") | F.col("passing").isNull() | (F.col("passing.first") == F.col("passing.last"))).alias("done"),
            ),
            "mix-cuts",
        )
    return state.select("key", "cut")


def mix(
    docs: DataFrame, target: Target | None = None, tokens: Column | None = None, seed: int = 0, source: str | Sequence[str] = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """The schedule: the columns of ``docs`` with ``epoch`` (from 1), ``place`` and ``tokens`` added, one row for each time
    a document is used. Read by epoch and place it is the training order: each epoch of a source is a permutation of all its
    documents, the last one the beginning of a permutation.

    The tokens of a source never pass its quota; they fall short of it by less than one document (with equal places,
    that is equal ids, by less than those together). ``tokens`` is the number of tokens of a document, by default its words;
    null counts as none. Documents without tokens are in no epoch. A null source is a source of its own; of several
    columns named as ``source``, every combination is one. Columns of ``docs`` named like the added ones are replaced.
    No documents, no rows.

    Documents are read three times and never shuffled, unless there are so many sources that the table of them is too
    large to be broadcast by Spark's own threshold.
    """
    target = target or Target()
    counted = docs.drop("epoch", "place").withColumn("tokens", F.coalesce((word_count(F.col("text")) if tokens is None else tokens).cast("bigint"), F.lit(0)))
    names = [c for c in counted.columns if c != "tokens"]
    # The row goes along as one value, so that no column of it can clash with those of the plan.
    sized = counted.where("tokens > 0").select(F.struct(*names).alias("row"), F.col(doc_id).alias("id"), "tokens", _key(source).alias("key"))
    quotas = plan(counted.select(*_names(source), "tokens"), target, source)
    joined = sized.join(quotas.select("key", "epochs", "rest"), "key")
    last = order_key(seed, F.col("epochs") + 1, F.col("id"))
    keys = materialise(joined.where("rest > 0").select("key", last.alias("place"), "tokens"), "mix-keys")
    cuts = find_cuts(keys, quotas.where("rest > 0").select("key", "rest"))
    placed = joined.join(cuts, "key", "left")
    times = F.col("epochs") + F.when(last <= F.col("cut"), 1).otherwise(0)
    used = placed.withColumn("times", times).where("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return used.select(*(F.col("row").getField(c).alias(c) for c in names), "epoch", order_key(seed, F.col("epoch"), F.col("id")).alias("place"), "tokens")
