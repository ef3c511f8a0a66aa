"""Date expressions: the lenient parsing ladder, calendar buckets, fiscal years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.convert import month_first_date, serial, serial_to_date
from gridloom.functions.text import squish


def parse_date_ladder(c: Column, literal_short_years: bool = False) -> Column:
    """Serial, then year-first, then month-first text; each matches a prefix of the text.

    ``literal_short_years`` reads ``1/5/24`` as year 24, as a parser does that accepts one to four
    year digits; the default reads it as 2024.
    """
    s = squish(c)
    years, pad = ("{1,4}", "000$1") if literal_short_years else ("{4}", "$1")
    day = F.regexp_extract(s, f"^([0-9]{years}-[0-9]{{1,2}}-[0-9]{{1,2}})", 1)
    year_first = F.regexp_replace(day, "^([0-9]+)", pad).try_cast("date")
    # The beginning of the text picks the parser, whatever follows it.
    return (
        F.when(s.rlike("^[0-9]{1,4}-"), year_first)
        .when(s.rlike("^[0-9]{1,2}/"), month_first_date(s, literal_short_years))
        .otherwise(serial_to_date(F.floor(serial(s))))
    )


def first_event_date(columns: Sequence[str], parse=parse_date_ladder) -> Column:
    """Per row, the first of ``columns`` that parses."""
    return F.coalesce(*[parse(F.col(c)) for c in columns])


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def week_start(c: Column) -> Column:
    """Monday of the week."""
    return F.trunc(c, "week")


def fiscal_year(c: Column) -> Column:
    """Fiscal years begin in October of the year before."""
    return F.year(c) + F.when(F.month(c) >= 10, F.lit(1)).otherwise(F.lit(0))


def calendar_year(fiscal: Column, month: Column) -> Column:
    return fiscal - F.when(month >= 10, F.lit(1)).otherwise(F.lit(0))
