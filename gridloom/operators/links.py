"""Links on web pages: extraction, classification by anchor text, inventory of known links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import squish
from gridloom.operators.common import keep_first

ANCHOR = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)[^>]*>(.*?)</a\s*>"

# Character references that occur in anchor text and hrefs. The ampersand comes last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

# Fixed value: links that name a data file.
DATA_FILE = r"\.xlsx|\.xls|\.csv|\.zip"


def _unescape(c: Column) -> Column:
    for reference, character in ENTITIES:
        c = F.replace(c, F.lit(reference), F.lit(character))
    return c


def _without_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in a path that starts with a slash."""
    parts = F.split(path, "/")
    resolved = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda kept, part: F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1))))
        .when(part == ".", kept)
        .otherwise(F.concat(kept, F.array(part))),
    )
    trailing = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(resolved, "/"), trailing)


def absolute_url(href: Column, base: Column) -> Column:
    """``href`` as a full URL, relative to the page at ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(page, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    full_path = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    clean_path = F.when(full_path.rlike(r"/\.\.?(/|$)"), _without_dot_segments(full_path)).otherwise(full_path)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", F.regexp_extract(base, r"^([^#]*)", 1))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(site, page, href))
        .otherwise(F.concat(site, clean_path, rest))
    )


def link_extract(pages: DataFrame) -> DataFrame:
    """Anchors of ``pages(page_id, url, html)``: ``page_id, position, text, href, full_url``.

    A page is searched once for whole anchors; target and text are then taken from each short anchor.
    """
    found = F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))).alias("position", "anchor")
    target = F.regexp_replace(F.regexp_extract("anchor", ANCHOR, 1), "^[\"']|[\"']$", "")
    label = F.regexp_replace(F.regexp_extract("anchor", ANCHOR, 2), "(?s)<[^>]*>", "")
    parsed = pages.select("page_id", "url", found).select(
        "page_id", "url", "position", squish(_unescape(label)).alias("text"), _unescape(F.trim(target)).alias("href")
    )
    full_url = absolute_url(F.col("href"), F.col("url"))
    return parsed.select("page_id", "position", "text", "href", full_url.alias("full_url"))


def link_classify(
    links: DataFrame,
    kind: str,
    include_terms: Sequence[str],
    too_specific_terms: Sequence[str] = (),
    file_pattern: str = DATA_FILE,
) -> DataFrame:
    """Data-file links whose text names the wanted kind, one row per URL (first page, first place).

    ``download_class`` is ``include_<kind>``, or ``manual_review`` when the text is also too specific.
    """
    lowered = F.lower("text")
    specific = lowered.rlike("|".join(too_specific_terms)) if too_specific_terms else F.lit(False)
    wanted = (
        links.where(F.col("full_url").rlike(file_pattern))
        .withColumn("text_lower", lowered)
        .withColumn(f"is_{kind}", F.col("text_lower").rlike("|".join(include_terms)))
        .withColumn("is_too_specific", specific)
        .where(F.col(f"is_{kind}"))
        .withColumn(
            "download_class",
            F.when(F.col("is_too_specific"), F.lit("manual_review")).otherwise(F.lit(f"include_{kind}")),
        )
    )
    return keep_first(wanted, ["full_url"], ["page_id", "position"])


def link_filter_simple(links: DataFrame, term: str, file_pattern: str = DATA_FILE) -> DataFrame:
    """Older single-term rule: data-file links whose text holds ``term``, one row per URL."""
    wanted = links.where(F.col("full_url").rlike(file_pattern) & F.lower("text").contains(term))
    return keep_first(wanted, ["full_url"], ["page_id", "position"])


def link_new(links: DataFrame, inventory: DataFrame) -> DataFrame:
    """Links whose URL the inventory does not hold yet."""
    return links.join(inventory.select("full_url"), "full_url", "left_anti")


def manual_review_count(new_links: DataFrame) -> DataFrame:
    return new_links.agg(
        F.count("*").alias("new_links"),
        F.count_if(F.col("download_class") == "manual_review").alias("manual_review_links"),
    )


def link_inventory_update(old: DataFrame, current: DataFrame) -> DataFrame:
    """Known and current links together, one row per URL; a known link wins over its current twin."""
    both = old.withColumn("_age", F.lit(0)).unionByName(current.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, ["full_url"], ["_age", "page_id", "position"]).drop("_age")
