"""Main text of web pages by deduction of each host's template.

A page is read as tokens: tags with the path of elements they stand in, and pieces of text with theirs. Tokens that occur
equally often on every page of a host, whose occurrence vectors agree, form an equivalence class. Classes that are
frequent, large and in one order on all pages are valid; nested into each other they are the host's template. What lies
between template tokens are slots. A slot's text is data; text that belongs to a valid class is the template's own,
unless it stands in the article. Pages of a host that are copies of each other count once.
Of the slots, those in the article are kept, those in menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, as the template's elements around them tell, are not.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import by_size, materialise
from gridloom.llm.url_filter import url_host

BLOCK_BYTES = 4 << 20
MASK = (1 << 64) - 1

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template noscript iframe svg annotation annotation-xml xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Elements that a new element of the same group ends, unless one of the limits stands between.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
LIMITS = frozenset("ul ol dl table select menu article body".split())
#: Elements that are no article, whatever is in them, and words in class, id or role that say so.
ASIDE = frozenset("nav footer aside form script style button select dialog menu object head".split())
MAIN = frozenset("article main".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notices alert popup modal "
    "sidebar menu nav navigation navbar breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar "
    "comment comments respond reply replies disqus share sharing social related recommended newsletter subscribe signup widget search".split()
)
#: Of these words, those whose elements hold articles that are not the page's own, and those that mark an author's own remarks within an article.
OTHERS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo comment comments respond reply replies disqus related recommended".split())
REMARKS = frozenset("notice notices alert".split())
#: Elements whose class, id and role speak of the page or of its own text.
UNMARKED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
#: Parts of a name that say how a page is laid out (``has-sidebar``, ``comment-open``), and those an id may have beside the words; other ids are of headings and sections.
STATES = frozenset("has with without no not open opened closed enabled disabled".split())
FURNITURE = frozenset("site main page top bottom left right primary secondary global mobile list container wrapper wrap inner outer content box bar area panel block buttons links posts form".split())
#: Comments, declarations and tags; a tag that is not closed ends where the next begins.
MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z|(?=<))"
    r"|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)(?:>|\Z|(?=<))",
    re.DOTALL,
)
QUOTES = "\"'"
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)


@dataclass(frozen=True)
class Settings:
    """A class is frequent if it is on ``tag_share`` of a host's different pages, or ``text_share`` of them for its text to be the
    template's, and large if it has ``size`` tokens. What one page alone has tells nothing: a class is on two different
    pages at least."""

    tag_share: float = 0.5
    text_share: float = 0.9
    size: int = 3


@dataclass(frozen=True)
class Place:
    """Where a token stands: hash of its path of elements, whether within the article, whether within what is none, whether
    also an article there is none of the page's own; and the hashes of the tags that begin and end it."""

    path: str
    main: bool
    aside: bool
    others: bool
    opened: int
    closed: int


def digest(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def boilerplate(marks: str, main: bool) -> set[str]:
    """The words of ``BOILERPLATE`` that an element's attributes, one per line, name it by. A name of several parts counts by
    its first and its last part; an id only outside the article, and if all its parts are such words or ``FURNITURE``."""
    found = set()
    for attribute in marks.lower().split("\n"):
        kind, _, names = attribute.partition("=")
        for name in names.split():
            parts = [x for x in re.split("[-_]+", name) if x]
            if kind == "id":
                if not main and all(x in BOILERPLATE or x in FURNITURE or x.isdigit() for x in parts):
                    found.update(BOILERPLATE.intersection(parts))
            elif parts and STATES.isdisjoint(parts):
                found.update(BOILERPLATE.intersection((parts[0], parts[-1])))
    return found - REMARKS if main else found


@lru_cache(maxsize=100_000)
def place_below(above: Place, name: str, marks: str) -> Place:
    main = above.main or name in MAIN
    words = set() if name in UNMARKED else boilerplate(marks, above.main)
    never = name in ASIDE or name == "header" and not main
    others = above.others or never or not OTHERS.isdisjoint(words)
    # The page's own article starts afresh below a wrapper that is only marked.
    aside = (above.aside and (name not in MAIN or above.main or above.others)) or never or bool(words)
    path = f"{digest(above.path, name, marks):x}"
    return Place(path, main, aside, others, digest("open", path), digest("close", path))


ROOT = Place("", False, False, False, 0, 0)
#: End of the elements whose content is no markup.
RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}


def tokens(html: str) -> Iterator[tuple[str, int, Place, str]]:
    """The tokens of a page in order: ``(kind, hash, place, text)``, kind ``open``, ``close``, ``break`` or ``text``.

    Elements whose end tag is left out end where HTML lets them; markup that is cut off ends with the page. Texts have
    their character references decoded and their white space kept.
    """
    stack: list[tuple[str, Place]] = []
    at = 0

    def top() -> Place:
        return stack[-1][1] if stack else ROOT

    def end(names, limits=frozenset()) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in limits:
                return -1
        return -1

    while at < len(html):
        found = MARKUP.search(html, at)
        stop = found.start() if found else len(html)
        if stop > at:
            text = entities.unescape(html[at:stop])
            yield "text", 0, top(), text
        if not found:
            return
        at = found.end()
        closing, name, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            i = end((name,))
            if i >= 0:
                place = stack[i][1]
                del stack[i:]
                yield "close" if name not in INLINE else "inline", place.closed, place, name
            continue
        if name == "br":
            yield "text", 0, top(), " "
            continue
        if name in VOID:
            if name not in INLINE:
                yield "break", 0, top(), name
            continue
        if name in CLOSES_P and (i := end(("p",), LIMITS | frozenset(("button", "td", "th", "li")))) >= 0:
            del stack[i:]
        elif name in SIBLINGS and (i := end(SIBLINGS[name], LIMITS)) >= 0:
            del stack[i:]
        marks = "\n".join(f"{m[1]}={' '.join(m[2].strip(QUOTES).split())}" for m in ATTRIBUTE.finditer(rest)) if "=" in rest else ""
        place = place_below(top(), name, marks)
        if name in RAW:
            over = RAW_ENDS[name].search(html, at)
            at = over.end() if over else len(html)
            yield "open" if name not in INLINE else "inline", place.opened, place, name
            continue
        yield "open" if name not in INLINE else "inline", place.opened, place, name
        if not rest.endswith("/") or name not in ("svg", "path"):
            stack.append((name, place))


def keyed(html: str) -> list[tuple[str, int, Place, str]]:
    """Tokens as they are counted: text without white space around it gets a hash of its place and words."""
    out = []
    for kind, key, place, text in tokens(html):
        if kind == "text":
            words = " ".join(text.split())
            key = digest("text", place.path, words) if words else 0
        out.append((kind, key, place, text))
    return out


def signed(x: int) -> int:
    x &= MASK
    return x - (1 << 64) if x >> 63 else x


def occurrence_vectors(pages: DataFrame) -> DataFrame:
    """``(host, token, is_text, support, one, two)``: on how many different pages of a host a token is, and two sums over
    all its pages of hashes of page and count, which agree for tokens whose occurrence vectors do. Each of ``_copies`` equal
    pages adds its fraction to the support, which is whole again when all are summed and rounded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, "_html", BLOCK_BYTES):
            sums: dict[tuple[str, int, bool], list] = {}
            for host, page, html, copies in zip(*(part.column(c).to_pylist() for c in ("_host", "_page", "_html", "_copies")), strict=True):
                seen: dict[tuple[int, bool], int] = defaultdict(int)
                for kind, key, _, _ in keyed(html or ""):
                    if key:
                        seen[key, kind == "text"] += 1
                for (key, is_text), n in seen.items():
                    held = sums.setdefault((host, key, is_text), [0.0, 0, 0])
                    held[0] += 1 / copies
                    held[1] += hash((page, n, 1))
                    held[2] += hash((page, n, 2))
            columns = [[k[0] for k in sums], [signed(k[1]) for k in sums], [k[2] for k in sums], [v[0] for v in sums.values()], *([signed(v[i]) for v in sums.values()] for i in (1, 2))]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["host", "token", "is_text", "support", "one", "two"])

    return pages.mapInArrow(work, "host string, token bigint, is_text boolean, support double, one bigint, two bigint")


def candidate_classes(pages: DataFrame, settings: Settings) -> DataFrame:
    """One row ``(host, tokens, classes)`` per host with frequent, large classes: their tokens and, for each, its class. As
    many as a page has tokens, not as there are pages."""
    wrap = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))  # noqa: E731  sums of hashes, which do not fit 64 bits
    contents = materialise(pages.groupBy("_host", "_page").agg(F.count("*").alias("_copies")), "template-contents")
    copied = materialise(contents.where("_copies > 1"), "template-copied")
    pages = pages.join(copied, ["_host", "_page"], "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
    support = F.round(F.sum("support")).cast("bigint").alias("support")
    counted = occurrence_vectors(pages).groupBy("host", "token", "is_text").agg(support, wrap("one").alias("one"), wrap("two").alias("two"))
    sizes = contents.groupBy(F.col("_host").alias("host")).agg(F.count("*").alias("n"))
    named = counted.join(materialise(sizes, "template-hosts"), "host").where(
        (F.col("support") >= settings.tag_share * F.col("n"))
        & (~F.col("is_text") | ((F.col("support") >= settings.text_share * F.col("n")) & (F.col("support") > 1)))
    )
    classes = named.select("host", "token", F.xxhash64("one", "two", "support").alias("class"))
    large = classes.groupBy("host", "class").agg(F.collect_list("token").alias("own")).where(F.size("own") >= settings.size)
    return large.groupBy("host").agg(F.collect_list(F.struct("class", "own")).alias("template"))


def read_template(template: list[dict] | None) -> dict[int, int]:
    return {t & MASK: c["class"] for c in template or [] for t in c["own"]}


def order_of(sequence: list[int]) -> int:
    """Hash of the order in which a class's tokens occur: that of one round if the page has several alike, else none."""
    n = len(set(sequence))
    first = sequence[:n]
    return signed(digest(*map(str, first))) if len(sequence) % n == 0 and first * (len(sequence) // n) == sequence else 0


def invalid_classes(pages: DataFrame) -> DataFrame:
    """``(host, class)`` of classes that are not in one order on all pages of ``pages(_host, _html, template)``, or
    whose rounds overlap those of a larger class without lying in one of its gaps."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, "_html", BLOCK_BYTES):
            orders: set[tuple[str, int, int]] = set()
            for host, html, template in zip(*(part.column(c).to_pylist() for c in ("_host", "_html", "template")), strict=True):
                of, sequences, places = read_template(template), defaultdict(list), defaultdict(list)
                for i, (_, key, _, _) in enumerate(keyed(html or "")):
                    if key in of:
                        sequences[of[key]].append(key)
                        places[of[key]].append(i)
                for name, sequence in sequences.items():
                    orders.add((host, name, order_of(sequence)))
                by_size_ = sorted(sequences, key=lambda c: (-len(set(sequences[c])), c))
                for i, small in enumerate(by_size_):
                    n = len(set(sequences[small]))
                    rounds = np.array(places[small][: len(places[small]) // n * n]).reshape(-1, n)
                    for big in by_size_[:i]:
                        if len(places[big]) == len(set(sequences[big])):
                            gaps = np.searchsorted(places[big], rounds)
                            if (gaps.min(1) != gaps.max(1)).any():
                                orders.add((host, small, 0))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in orders], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["host", "class", "ordered"])

    seen = pages.mapInArrow(work, "host string, class bigint, ordered bigint")
    return seen.groupBy("host", "class").agg(F.min("ordered").alias("least"), F.max("ordered").alias("most")).where("least <> most OR least = 0").select("host", "class")


def main_text(html: str, template: dict[int, int]) -> tuple[str, int]:
    """Text of the slots that are kept, and how many slots there are."""
    blocks: list[list[tuple[str, Place]]] = [[]]
    slots, open_slot = 0, False
    page = keyed(html)
    inside = any(kind == "open" and place.main and not place.aside for kind, _, place, _ in page)
    for kind, key, place, text in page:
        if kind == "text":
            if key and (place.main or key not in template):
                slots += not open_slot
                open_slot = True
                if not place.aside and (place.main or not inside):
                    blocks[-1].append(text)
            elif not key and blocks[-1]:
                blocks[-1].append(" ")
            continue
        open_slot = open_slot and key not in template
        if kind != "inline":
            blocks.append([])
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line), slots


def extract(pages: DataFrame, settings: Settings | None = None, html: str = "html", url: str = "url") -> DataFrame:
    """Adds ``text`` and ``n_slots`` to ``pages``: the main text of each page, blocks in order of page, one per line, and
    how many slots it has beside its host's template. Nothing of a kept slot is cut.

    A null or empty page has an empty text. A page whose url has no host, or is null, is read without a template, as is
    one of a host whose pages have nothing in common; elements alone then tell the article from the rest. Without an
    ``article`` or ``main`` element all that is not marked as something else is kept. Repeated rows are read each, but count
    once for the template; ids are not looked at. Rows and other columns are kept; columns with the added names are replaced.

    Tokens are summed per host before they are shuffled, so a host of any size costs a task no more than another. Templates
    are as large as a page; pages are joined with them by host, and are shuffled for it only if all templates together
    are too large to be broadcast by Spark's own threshold.
    """
    settings = settings or Settings()
    host = F.when(url_host(F.col(url)) != "", url_host(F.col(url)))
    page = F.xxhash64(F.coalesce(F.col(html), F.lit("")))
    pages = pages.drop("text", "n_slots")
    marked = pages.select("*", host.alias("_host"), F.col(html).alias("_html"))
    hosted = marked.where("_host IS NOT NULL").select("_host", page.alias("_page"), "_html")
    templates = materialise(candidate_classes(hosted, settings), "template-classes")
    joined = hosted.select("_host", "_html").join(templates.withColumnRenamed("host", "_host"), "_host")
    wrong = materialise(invalid_classes(joined), "template-wrong")
    each = templates.select("host", F.inline("template")).join(wrong, ["host", "class"], "left_anti")
    valid = materialise(each.groupBy("host").agg(F.collect_list(F.struct("class", "own")).alias("_template")), "template-valid")
    schema = pages.select("*", F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n_slots")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, "_html", BLOCK_BYTES):
            found = [main_text(h or "", read_template(t)) for h, t in zip(part.column("_html").to_pylist(), part.column("_template").to_pylist(), strict=True)]
            columns = [part.column(c) for c in schema.fieldNames()[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64())], schema.fieldNames())

    with_template = marked.join(valid.withColumnRenamed("host", "_host"), "_host", "left")
    return with_template.mapInArrow(work, schema)
