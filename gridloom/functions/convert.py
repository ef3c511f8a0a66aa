"""Safe conversions from cleaned text to typed values.

Every conversion yields NULL for text it does not recognise, under ANSI mode or not. Spark's own text
casts are wider than wanted (``'45123'`` is a year to it), so a shape test comes before each cast.
Spreadsheet serials count days from 1899-12-30; serials outside years 1 to 9999 give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
DAY = r"[0-9]{4}(?:-[0-9]{1,2}-|/[0-9]{1,2}/| [0-9]{1,2} |\\[0-9]{1,2}\\)[0-9]{1,2}"
CLOCK = r"(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:\.[0-9]+)?)?"
ZONE = "(?: ?(?:Z|UTC))?"

# Accepted spellings of yes and no, and the spreadsheet epoch.
TRUE_TOKENS = ("Y", "YES", "TRUE", "T", "1")
FALSE_TOKENS = ("N", "NO", "FALSE", "F", "0")
SERIAL_EPOCH = "1899-12-30"
MICROS_PER_DAY = 86_400_000_000

FIRST_SERIAL, LAST_SERIAL = -693_593, 2_958_465  # 0001-01-01 and 9999-12-31


def numeric(c: Column) -> Column:
    """Plain decimal or exponent text to double; anything else NULL.

    The shape test also keeps text from the cast, whose failures are far slower than the test.
    """
    return F.when(c.rlike(f"^{NUMBER}$"), c.try_cast("double"))


def serial(c: Column) -> Column:
    """Numeric text usable as a day serial."""
    n = numeric(c)
    return F.when((n >= FIRST_SERIAL) & (n < LAST_SERIAL + 1), n)


def serial_to_date(days: Column) -> Column:
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), days.try_cast("int"))


def _year_first(c: Column) -> Column:
    """Cheap necessary test for year-first text: a separator after four characters."""
    return F.substring(c, 5, 1).isin("-", "/", " ", "\\")


def year_first_date(c: Column) -> Column:
    """Year-first text with any of the four separators; a valid clock may follow."""
    day = F.regexp_extract(c, f"^({DAY})(?:[ T]{CLOCK}{ZONE})?$", 1)
    return F.when(_year_first(c), F.translate(day, "/ \\", "---").try_cast("date"))


def year_first_datetime(c: Column) -> Column:
    moment = F.regexp_extract(c, f"^({DAY}[ T]{CLOCK}|{DAY}(?=$)){ZONE}$", 1)
    dashed = F.regexp_replace(moment, r"^([0-9]{4})[/ \\]([0-9]{1,2})[/ \\]", "$1-$2-")
    return F.when(_year_first(c), dashed.try_cast("timestamp_ntz"))


def month_first_date(c: Column, literal_short_years: bool = False) -> Column:
    """``m/d/yyyy``, then ``m/d/yy`` (00-68 are 2000s). Text after the date is ignored."""
    md = "[0-9]{1,2}/[0-9]{1,2}/"
    if literal_short_years:
        years = F.regexp_extract(c, f"^({md}[0-9]{{1,4}})", 1)
        parsed = F.regexp_replace(years, "^([0-9]+)/([0-9]+)/([0-9]+)$", "000$3-$1-$2").try_cast("date")
    else:
        long = F.regexp_replace(F.regexp_extract(c, f"^({md}[0-9]{{4}})", 1), "^([0-9]+)/([0-9]+)/([0-9]+)$", "$3-$1-$2")
        short = F.regexp_extract(c, f"^({md}[0-9]{{2}})(?![0-9])", 1)
        short = F.regexp_replace(short, "^([0-9]+)/([0-9]+)/([0-5][0-9]|6[0-8])$", "20$3-$1-$2")
        short = F.regexp_replace(short, "^([0-9]+)/([0-9]+)/([0-9]{2})$", "19$3-$1-$2")
        parsed = F.coalesce(long.try_cast("date"), short.try_cast("date"))
    return F.when(c.contains("/"), parsed)


def to_date(c: Column, us_dates: bool = False) -> Column:
    """Year-first text, else a serial truncated to its day; ``us_dates`` also takes month/day/year."""
    choices = [year_first_date(c), serial_to_date(serial(c))]
    if us_dates:
        choices.append(month_first_date(c))
    return F.coalesce(*choices)


def to_datetime(c: Column) -> Column:
    """Year-first text, else a serial with its day fraction rounded to the microsecond."""
    micros = F.round(serial(c) * F.lit(float(MICROS_PER_DAY))).try_cast("bigint")
    epoch = F.lit(f"{SERIAL_EPOCH} 00:00:00").cast("timestamp_ntz")
    return F.coalesce(year_first_datetime(c), F.timestamp_add("MICROSECOND", micros, epoch))


def to_time(c: Column) -> Column:
    """Clock text, the clock of year-first text, else a serial's day fraction, as ``HH:mm:ss[.ffffff]``."""
    clock = F.regexp_extract(c, f"^({CLOCK}){ZONE}$", 1)
    micros = F.round(F.pmod(numeric(c), F.lit(1.0)) * F.lit(float(MICROS_PER_DAY))).try_cast("bigint")
    midnight = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    moment = F.coalesce(
        F.when(c.contains(":") & (clock != ""), F.concat(F.lit("2000-01-01 "), clock).try_cast("timestamp_ntz")),
        year_first_datetime(c),
        F.timestamp_add("MICROSECOND", F.pmod(micros, F.lit(MICROS_PER_DAY)), midnight),
    )
    return F.substring(moment.cast("string"), 12, 15)


def to_logical(c: Column) -> Column:
    upper = F.upper(c)
    return F.when(upper.isin(*TRUE_TOKENS), F.lit(True)).when(upper.isin(*FALSE_TOKENS), F.lit(False))


def to_integer(c: Column) -> Column:
    """Decimals round half away from zero; values beyond 32 bits give NULL."""
    return F.round(numeric(c)).try_cast("int")


def to_double(c: Column) -> Column:
    return numeric(c)


CONVERTERS = {
    "datetime": to_datetime,
    "date": to_date,
    "time": to_time,
    "logical": to_logical,
    "integer": to_integer,
    "double": to_double,
    "text": lambda c: c,
}
