"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters with an error budget of k edits is cut into k + 1 pieces. Wherever the item occurs in a text
with at most k edits, one of its pieces occurs unchanged. All pieces are looked for at once by an Aho-Corasick automaton;
around each hit, Myers' bit-parallel algorithm computes the least edit distance between the item and any part of the
text. Nothing within the budget is missed, and nothing beyond it is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters of test items that one automaton holds; a benchmark beyond that is worked off in several.
BLOCK_CHARS = 4_000_000
MATCHES = "array<struct<item_id:bigint,distance:int,end:bigint>>"


def normal(text: str) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join(text.lower().split())


def pieces(text: str, budget: int) -> Iterator[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their places; as many as there are characters, if fewer."""
    parts = min(budget + 1, len(text))
    for i in range(parts):
        start = i * len(text) // parts
        yield start, text[start : (i + 1) * len(text) // parts]


def whole(text: str, begin: int, end: int) -> bool:
    """Whether no word goes on at either end of a part of ``text``."""
    left = begin > 0 and text[begin - 1].isalnum() and text[begin].isalnum()
    return not left and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


class Item:
    """A test item ready for Myers' algorithm: ``masks`` has, for each character, a bit for every place it has."""

    def __init__(self, item_id: int | None, text: str, rate: float):
        self.item_id, self.text, self.budget = item_id, text, int(len(text) * rate)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def nearest(self, window: str) -> tuple[int, int]:
        """Least edit distance to any part of ``window`` and the first end of such a part."""
        at = window.find(self.text)
        if at >= 0:
            return 0, at + len(self.text)
        m = len(self.text)
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, distance = full, 0, m
        best, end = m, 0
        for j, c in enumerate(window, 1):
            equal = self.masks.get(c, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (~(horizontal | plus) & full)
            down = plus & horizontal
            distance += bool(up & top) - bool(down & top)
            up, down = up << 1, down << 1
            plus, minus = (down | ~(vertical | up)) & full, up & vertical & full
            if distance < best:
                best, end = distance, j
        return best, end


class Matcher:
    """The automaton over all pieces of ``items``, pairs of id and normalised text. Empty texts match nothing. With ``words``,
    an item that allows no edit must be whole words of a text."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, words: bool = False):
        self.words = words
        self.items = [Item(i, text, rate) for i, text in items if text]
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(self.items):
            for start, piece in pieces(item.text, item.budget):
                found.setdefault(piece, []).append((n, start))
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[dict]:
        """The best match of each item that ``text``, normalised, holds within its budget."""
        if not self.items:
            return []
        windows: dict[int, list[list[int]]] = {}
        exact: dict[int, int] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for n, start in owners:
                item = self.items[n]
                if self.words and not item.budget:  # its one piece is the item; within a longer word it is another word
                    if whole(text, last + 1 - size, last + 1):
                        exact.setdefault(n, last + 1)
                    continue
                begin = last + 1 - size - start - item.budget
                stop = begin + len(item.text) + 2 * item.budget
                own = windows.setdefault(n, [])
                # Hits come from left to right, so windows that overlap can be joined as they come.
                if own and begin <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(own[-1][0], begin), max(own[-1][1], stop)
                else:
                    own.append([begin, stop])
        out = [{"item_id": self.items[n].item_id, "distance": 0, "end": end} for n, end in exact.items()]
        for n, own in windows.items():
            item, best = self.items[n], None
            for begin, stop in own:
                begin = max(begin, 0)
                distance, end = item.nearest(text[begin:stop])
                if distance <= item.budget and (best is None or distance < best[0]):
                    best = distance, begin + end
                if best and not best[0]:
                    break
            if best:
                out.append({"item_id": item.item_id, "distance": best[0], "end": best[1]})
        return out


def find_matches(docs: DataFrame, items: DataFrame, rate: float = 0.05, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Adds ``matches`` to ``docs``: for each item of ``items`` that occurs in the text with at most ``rate`` edits per
    character of the item, its id, the least number of edits, and where the first such part ends in the normalised
    text, in order of id.

    Texts and items are compared in lower case with runs of white space as one space. A null or empty text matches
    nothing, nor does a null or empty item; an item with a null id counts, its id stays null. Repeated items are
    reported each. An item so short that no edit is allowed must not begin or end inside a word. Texts are read whole,
    rows and other columns are kept, a column ``matches`` is replaced.

    Documents are not shuffled. The benchmark is dealt into blocks by a hash of id and text, as many as its size asks for;
    each is collected, within a fixed size, and looked for in one pass over the documents.
    """
    wanted = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t"))
    chars = wanted.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = -(-chars // BLOCK_CHARS)
    out = docs.drop("matches").withColumn("matches", F.array().cast(MATCHES))
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("t", "i"), F.lit(blocks)) == block)
        held = [(row["i"], normal(row["t"])) for row in part.collect()]
        out = _pass(out, held, rate, text)
    return out.withColumn("matches", F.array_sort("matches")) if blocks else out


def _pass(docs: DataFrame, items: list[tuple[int | None, str]], rate: float, text: str) -> DataFrame:
    schema = to_arrow_schema(docs.schema)
    place = docs.columns.index("matches")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, rate, words=True)
        for batch in batches:
            found = [
                (old or []) + (matcher.matches(normal(t)) if t else [])
                for t, old in zip(map(pa.StringScalar.as_py, batch.column(text)), batch.column("matches").to_pylist(), strict=True)
            ]
            columns = batch.columns
            columns[place] = pa.array(found, schema.field("matches").type)
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(look, docs.schema)
