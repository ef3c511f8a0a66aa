"""Golden values for names, text and conversions."""

import pytest
from pyspark.sql import functions as F

from gridloom import functions as fn

NAMES = [
    ("# of people per Event", "number_of_people_per_event"),
    ("Created By (HashID)", "created_by_hash_id"),
    ("Arrest DateTime", "arrest_date_time"),
    ("Juvenile <18", "juvenile_18"),
    ("2019 Records", "x2019_records"),
    ("APP_DT_TIME", "app_dt_time"),
    ("ARREST_AT_CHECKPOINT (Y/N)", "arrest_at_checkpoint_y_n"),
    ("CES(Y/N)", "ces_y_n"),
    ("Statute Charge(s)", "statute_charge_s"),
    ("Destination Address in U.S.", "destination_address_in_u_s"),
    ("Subject's Age", "subjects_age"),
    ("% of Total", "percent_of_total"),
    ("Calendar Year # (YYYY)", "calendar_year_number_yyyy"),
    ("citizenshipCd", "citizenship_cd"),
    ("Países", "paises"),
    ("---", "x"),
    (None, None),
]


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clean_names(spark):
    assert values(spark, [raw for raw, _ in NAMES], fn.clean_names) == [clean for _, clean in NAMES]


TEXTS = [
    (" (B) (7)( e )", "(b)(7)(E)"),
    ("near (b)(7)(e),  north", "near (b)(7)(E), north"),
    ("a\t\n b", "a b"),
    ("   ", None),
    ("", None),
    (None, None),
    ("plain", "plain"),
    (" lead", "lead"),
    ("(b)(6)", "(b)(6)"),
]


def test_clean_text(spark):
    assert values(spark, [t for t, _ in TEXTS], fn.clean_text) == [c for _, c in TEXTS]


def test_redaction_flag_is_never_null(spark):
    texts = ["(b)(6)", "x (B) ( 7 ) y", "(c)(6)", None, ""]
    assert values(spark, texts, fn.redaction_flag) == [True, True, False, False, False]


DATES = [
    ("2024-01-05", "2024-01-05"), ("2024-1-5", "2024-01-05"), ("2024/01/05", "2024-01-05"), ("2024 01 05", "2024-01-05"),
    ("2024-01/05", None), ("2024-01-05 abc", None), ("2024-01-05T13:45:00Z", "2024-01-05"), ("2024-01-05 25:00:00", None),
    ("2024-02-30", None), ("2024", "1905-07-16"), ("2024-01", None), ("45123", "2023-07-16"), ("45123.75", "2023-07-16"),
    ("-1.5", "1899-12-29"), ("99999999", None), ("1e300", None), ("1e400", None), ("01/05/2024", None), ("nan", None), (None, None),
]


def test_to_date(spark):
    assert values(spark, [t for t, _ in DATES], lambda c: fn.to_date(c).cast("string")) == [d for _, d in DATES]


def test_to_date_takes_us_dates_on_request(spark):
    us = values(spark, ["01/05/2024", "2024-01-05"], lambda c: fn.to_date(c, us_dates=True).cast("string"))
    assert us == ["2024-01-05", "2024-01-05"]


STAMPS = [
    ("2024-01-05", "2024-01-05 00:00:00"), ("2024-01-05 13:45", "2024-01-05 13:45:00"),
    ("2024/1/5 1:2:3", "2024-01-05 01:02:03"), ("2024-01-05T13:45:00.1234567", "2024-01-05 13:45:00.123456"),
    ("45123.5", "2023-07-16 12:00:00"), ("0.0000001", "1899-12-30 00:00:00.00864"), ("2024-01-05 13", None),
    ("13:45", None), ("1e300", None),
]


def test_to_datetime(spark):
    assert values(spark, [t for t, _ in STAMPS], lambda c: fn.to_datetime(c).cast("string")) == [s for _, s in STAMPS]


TIMES = [
    ("13:45", "13:45:00"), ("7:5", "07:05:00"), ("7:08:09.50", "07:08:09.5"), ("13:45:60", None), ("0.75", "18:00:00"),
    ("45123.5", "12:00:00"), ("-0.25", "18:00:00"), ("0.9999999999999", "00:00:00"), ("2024-01-05 08:15", "08:15:00"),
    ("2024-13-05 08:15", None), ("2024-01-05", "00:00:00"), ("07:08 PM", None), (":", None),
]


def test_to_time(spark):
    assert values(spark, [t for t, _ in TIMES], fn.to_time) == [s for _, s in TIMES]


INTEGERS = [
    ("34.5", 35), ("-1.5", -2), ("2.5", 3), ("1e2", 100), ("5.", 5), (".5", 1), ("1,000", None), ("2147483647", 2147483647),
    ("2147483648", None), ("1_000", None), ("1d", None), ("", None), (None, None),
]


def test_to_integer(spark):
    assert values(spark, [t for t, _ in INTEGERS], fn.to_integer) == [n for _, n in INTEGERS]


def test_to_double_refuses_suffixes(spark):
    assert values(spark, ["1d", "5f", "0x1A", "1.5", "+.5e1", "x"], fn.to_double) == [None, None, None, 1.5, 5.0, None]


def test_to_logical(spark):
    assert values(spark, ["y", "Yes", "T", "1", "n", "no", "F", "0", "maybe", None], fn.to_logical) == (
        [True] * 4 + [False] * 4 + [None, None]
    )


LADDER = [
    ("45123.9", "2023-07-16"), ("2024-01-05 13:45", "2024-01-05"), ("1/5/2024", "2024-01-05"), ("1/5/24 10:00", "2024-01-05"),
    ("1/5/70", "1970-01-05"), ("1/5/124", None), ("13/45/2024", None), ("  1/5/2024 ", "2024-01-05"), ("text", None), ("", None),
]


def test_parse_date_ladder(spark):
    got = values(spark, [t for t, _ in LADDER], lambda c: fn.parse_date_ladder(c).cast("string"))
    assert got == [d for _, d in LADDER]


def test_ladder_can_read_short_years_literally(spark):
    parse = lambda c: fn.parse_date_ladder(c, literal_short_years=True).cast("string")
    assert values(spark, ["1/5/24", "1/5/2024", "24-1-5"], parse) == ["0024-01-05", "2024-01-05", "0024-01-05"]


def test_conversions_do_not_depend_on_ansi_or_zone(spark):
    texts = ["abc", "2024-03-10 02:30", "1e300", "45123.5"]
    kinds = ("date", "datetime", "time", "integer", "double", "logical")
    convert = lambda c: F.struct(*[fn.CONVERTERS[k](c).cast("string").alias(k) for k in kinds])
    usual = values(spark, texts, convert)
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")}
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(spark, texts, convert) == usual
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize(("text", "number"), [("2026 (to date)", 2026.0), ("FY1998", 1998.0), ("1,234.5 x", 1234.5), ("none", None)])
def test_parse_number(spark, text, number):
    assert values(spark, [text], fn.parse_number) == [number]


def test_fiscal_year_round_trip(spark):
    df = spark.sql("select explode(sequence(date'2019-01-01', date'2021-12-01', interval 1 month)) d")
    back = fn.calendar_year(fn.fiscal_year(F.col("d")), F.month("d"))
    assert df.where(back != F.year("d")).count() == 0
    assert df.where("d = date'2019-10-01'").select(fn.fiscal_year(F.col("d"))).first()[0] == 2020
