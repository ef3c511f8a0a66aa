"""URL rules by Bloom filter cascade: exact membership of url keys without a join.

A url's keys are its host and parent domains, each followed by a prefix of its path. Levels of Bloom filters
alternate: the first holds the listed keys, the second the keys of the corpus that the first lets through wrongly, the
third the listed keys that the second lets through, and so on until a level has nothing left to hold. Over the keys
that the cascade was built from (listed ones and every key of the corpus) its answer is exact. Filters travel inside
the plan as constants; they are sized by the number of listed keys, never by the corpus: the first level's rate of
false positives is set so that as many unlisted keys pass as there are listed ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_keys(host: Column, path: Column, path_lengths: list[int], labels_at_most: int) -> Column:
    """Every key a rule for this url could have, the longest first; of equal length, the longer host first.

    ``path_lengths`` are the lengths that paths of rules have, ``labels_at_most`` the most labels that their hosts have; other
    prefixes and longer tails can fit no rule.
    """
    labels = F.split(host, r"\.")
    labels = F.slice(labels, F.greatest(F.size(labels) - labels_at_most + 1, F.lit(1)), F.lit(labels_at_most))
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.filter(F.array(*map(F.lit, path_lengths)), lambda n: n <= F.length(path))
    pairs = F.flatten(
        F.transform(
            tails,
            lambda tail: F.transform(
                lengths,
                lambda n: F.struct((-F.length(tail) - n).alias("size"), (-F.length(tail)).alias("own"), F.concat(tail, F.substring(path, F.lit(1), n)).alias("key")),
            ),
        )
    )
    return F.transform(F.array_sort(pairs), lambda p: p["key"])


@dataclass(frozen=True)
class Bloom:
    """One level: ``words`` of 64 bits, tested at ``hashes`` places that depend on the level's ``salt``."""

    salt: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def places(self, key: Column) -> list[Column]:
        first, step = (F.pmod(F.xxhash64(key, F.lit(self.salt), F.lit(use)), F.lit(self.bits)) for use in ("first", "step"))
        return [F.pmod(first + i * step, F.lit(self.bits)) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words, out = F.array(*(F.lit(w).cast("bigint") for w in self.words)), F.lit(True)
        for place in self.places(key):
            word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
            out = out & (F.getbit(word, (place % 64).cast("int")) == 1)
        return out


def fill(keys: DataFrame, n: int, rate: float, salt: int) -> Bloom:
    """A filter over ``keys(key)``, about ``n`` rows, letting others through at ``rate``. Runs a job."""
    bits = 64 * math.ceil(max(64, -n * math.log(rate) / math.log(2) ** 2) / 64)
    shape = Bloom(salt, bits, max(1, round(bits / max(n, 1) * math.log(2))) if n > 8 else max(1, math.ceil(-math.log2(rate))), ())
    place = keys.select(F.explode(F.array(*shape.places(F.col("key")))).alias("place"))
    words = (
        place.groupBy(F.shiftright("place", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("word"))
        .collect()
    )
    filled = dict((row["at"], row["word"]) for row in words)
    return Bloom(salt, bits, shape.hashes, tuple(filled.get(i, 0) for i in range(bits // 64)))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def holds(self, key: Column) -> Column:
        """Whether ``key`` is listed: the parity of the first level that turns it away."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            out = F.when(level.holds(key), out).otherwise(i % 2 == 1)
        return out


def build(listed: DataFrame, universe: DataFrame, salt: int = 0) -> Cascade:
    """Cascade for ``listed(key)`` that is exact for those and all of ``universe(key)``, which may repeat keys.

    The universe is read once for its size and once for the keys that the first level lets through wrongly; later
    levels work on those alone, about 1.4 times the listed ones. Every level at least halves what is left.
    Null keys are ignored.
    """
    ensure_checkpoint_dir(listed.sparkSession)
    inside = listed.where("key IS NOT NULL").select("key").distinct().checkpoint()
    n = inside.count()
    if not n:
        return Cascade(())
    size = universe.agg(F.approx_count_distinct("key", 0.02)).first()[0]
    levels = [fill(inside, n, min(0.5, math.sqrt(2) * n / max(size, 1)), salt)]
    passing = universe.where(F.col("key").isNotNull() & levels[0].holds(F.col("key"))).select("key").distinct()
    outside = passing.join(inside, "key", "left_anti").checkpoint()
    held, wrong = inside, outside
    while left := wrong.count():
        level = fill(wrong, left, 0.5, salt + len(levels))
        levels.append(level)
        # What the new level holds was let through wrongly; next come those of the other side that it lets through.
        held, wrong = wrong, held.where(level.holds(F.col("key"))).checkpoint()
    return Cascade(tuple(levels))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to ``pages`` by the longest of ``rules(host, path, verdict)``.

    A rule fits its host and all subdomains if the url's path starts with the rule's; its name is host followed by
    path. Of rules that fit, the longest counts; of equal length, the one with the longer host. Without one, ``rule`` is
    null and ``verdict`` is ``default``, as for every url outside the list. A url that is null or has no ``://`` has an
    empty host and path. Verdicts are ``allow`` or ``block``; repeated rules count once, and a rule listed with
    both verdicts blocks. Columns of ``pages`` with those four names are replaced; rows and order of rows are kept.

    Two cascades: one tells rules from all other keys of the corpus, one tells blocking rules from allowing ones.
    No join and no shuffle of pages.
    """
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL").select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), "verdict")
    lengths = sorted(row["n"] for row in listed.select("n").distinct().collect())
    most = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"]
    parsed = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    if not lengths:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = url_keys(F.col("host"), F.col("path"), lengths, most)
    known = build(listed, parsed.select(F.explode(keys).alias("key")))
    blocking = build(listed.where("verdict = 'block'"), listed)
    rule = F.get(F.filter(keys, lambda key: known.holds(key)), F.lit(0))
    verdict = F.when(F.col("rule").isNull(), default).when(blocking.holds(F.col("rule")), "block").otherwise("allow")
    return parsed.withColumn("rule", rule).withColumn("verdict", verdict)
