"""Text expressions: cleaning, header names, redaction marks. All are built-in JVM expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Redaction marks and missing-value tokens.
WITHHELD_MARK = r"(?i)\(b\)\s*\(7\)\s*\(\s*E\s*\)"
WITHHELD_CANONICAL = "(b)(7)(E)"
EXEMPTION_MARK = r"(?i)\(b\)\s*\(\s*[0-9]+\s*\)"
MISSING_TOKENS = ("NA", "N/A", "NULL")


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and the plain letters they decompose to."""
    accented, plain = [], []
    for code in range(0x00C0, 0x0180):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base.isalpha():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, UNACCENTED = _accent_table()

# White space beyond ASCII, such as the no-break space, which spreadsheets are full of.
SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def squish(c: Column) -> Column:
    """Collapse runs of whitespace, Unicode's too, to one space and trim. Text without such runs is only trimmed.

    For headers, metadata and lenient dates; :func:`tidy`, for typed values, knows ASCII whitespace only.
    """
    uneven = c.rlike("[\t-\r\u0085\u00a0\u1680\u2000-\u3000]|  ")
    return F.trim(F.when(uneven, F.regexp_replace(c, SPACE + "+", " ")).otherwise(c))


def has_data(c: Column) -> Column:
    """True when the value is present and not blank, Unicode's white space counted as blank; never NULL."""
    return F.coalesce(c.rlike("[^" + SPACE[1:]), F.lit(False))


def tidy(c: Column) -> Column:
    """Canonical redaction mark, single spaces, trimmed.

    Most values need no rewriting: one test for a bracket or uneven spacing spares them both.
    """
    rewritten = F.regexp_replace(F.regexp_replace(c, WITHHELD_MARK, WITHHELD_CANONICAL), r"\s+", " ")
    return F.trim(F.when(c.rlike(r"[(\t-\r]|  "), rewritten).otherwise(c))


def clean_text(c: Column) -> Column:
    """Tidied text; blank becomes NULL."""
    return F.nullif(tidy(c.cast("string")), F.lit(""))


def is_missing_token(c: Column) -> Column:
    return F.upper(c).isin(*MISSING_TOKENS)


def redaction_flag(c: Column) -> Column:
    """True when the untouched text carries any ``(b)(<digits>)`` mark; never NULL."""
    return F.coalesce(c.cast("string").rlike(EXEMPTION_MARK), F.lit(False))


def clean_names(c: Column) -> Column:
    """Free-text header to snake_case. Names left empty become ``x``; NULL stays NULL."""
    s = F.when(c.rlike("[\u00c0-\u017f]"), F.translate(c, ACCENTED, UNACCENTED)).otherwise(c)
    s = F.translate(s, "\"'", "")
    s = F.replace(F.replace(s, F.lit("%"), F.lit("_percent_")), F.lit("#"), F.lit("_number_"))
    # Words begin at a capital after a small letter, and at the last of several capitals before one.
    s = F.regexp_replace(s, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_")
    s = F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when((s == "") | F.substring(s, 1, 1).between("0", "9"), F.concat(F.lit("x"), s)).otherwise(s)


def normalise_cell(c: Column) -> Column:
    """Form in which a data cell is compared with its own column header."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))  # white space goes with the rest


def file_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def file_stem(c: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(file_name(c), r"\.[^.]+$", "")


def parse_number(c: Column) -> Column:
    """First number inside free text, such as 2026 in ``FY2026 (to date)``; grouping commas dropped."""
    digits = F.regexp_extract(c, r"-?[0-9][0-9,]*(\.[0-9]+)?", 0)
    return F.nullif(F.regexp_replace(digits, ",", ""), F.lit("")).try_cast("double")
