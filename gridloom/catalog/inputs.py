"""Messy views over the test tables, as DataFrames. Their SQL twins are in ``oracle.py``.

Every view covers its whole source table, so the work of a query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.operators.benchmark import MONTHS
from gridloom.plans.spec import TableSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, *choices: Column) -> Column:
    """``choices[key % n]``."""
    n = len(choices)
    chosen = F.when(key % n == 0, choices[0])
    for i, choice in enumerate(choices[1:], 1):
        chosen = chosen.when(key % n == i, choice)
    return chosen


RAW_COLUMNS = [
    "record_id", "source_file", "source_sheet", "date_text", "stamp_text", "flag_text", "int_text", "ratio_text",
    "time_text",
]

RAW_SPEC = TableSpec(
    datetime=("stamp_text",),
    date=("date_text",),
    time=("time_text",),
    logical=("flag_text",),
    integer=("int_text",),
    double=("ratio_text",),
    order=("date_text", "stamp_text", "time_text", "age", "flag_text", "int_text", "ratio_text"),
    redaction_flags=("date_text", "flag_text"),
)


TEXT_OF_KIND = {
    "datetime": "stamp_text", "date": "date_text", "time": "time_text", "logical": "flag_text", "integer": "int_text",
    "double": "ratio_text", "text": "flag_text",
}


def raw_of(orders: DataFrame) -> DataFrame:
    """``orders`` with dirty text columns added: serials, mixed dates, redaction marks, flags, blanks."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    iso, us = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "MM/dd/yyyy")
    t = F.lit
    return orders.withColumns({
        "record_id": key.cast("string"),
        "source_file": F.concat(t("part_"), F.year(day).cast("string"), t(".xlsx")),
        "source_sheet": t("sheet1"),
        "date_text": _pick(
            key, serial, iso, F.concat(iso, t(" 13:45:00")), us, t("  "), t(" (B) (7)( e )"), t("n/a"),
            F.concat(serial, t(".25")),
        ),
        "stamp_text": _pick(
            key, F.concat(serial, t(".5")), F.concat(iso, t(" 08:15")), F.concat(iso, t("T23:59:59.125")),
            F.concat(us, t(" 10:00")), t("(b)(6)"), t(None).cast("string"),
        ),
        "flag_text": _pick(key, t("Y"), t(" no "), t("TRUE"), t("0"), t("N/A"), t("(b)(6)"), t(None).cast("string")),
        "int_text": _pick(
            key, F.concat(cust, t(".0")), cust, F.concat(cust, t(".5")), t("unknown"), F.concat(t("-"), cust, t(".5")), t(""),
        ),
        "ratio_text": _pick(key, F.concat(cust, t(".25")), t("1e3"), t("1,000"), t("null"), t("-.5")),
        "time_text": _pick(key, t("13:45"), t("07:08:09"), t("0.75"), t("45123.5"), t("(b)(7)(E)")),
    })


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(table(spark, sf_dir, "orders")).select(*RAW_COLUMNS)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records by yearly part; in odd years the flag column is empty throughout."""
    year = F.regexp_extract("source_file", "([0-9]+)", 1).cast("int")
    part_file = F.concat(F.lpad((year - 1991).cast("string"), 4, "0"), F.lit("_"), F.col("source_file"))
    return raw(spark, sf_dir).select(
        part_file.alias("part_file"), *RAW_COLUMNS[:5],
        F.when(year % 2 == 0, F.col("flag_text")).alias("flag_text"), *RAW_COLUMNS[6:],
    )


PAIR_COLUMNS = ["source_file", "source_sheet", "date_text", "stamp_text", "flag_text", "int_text", "note_a", "note_b"]


def pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two releases of the same records: B lacks some, changes some, repeats some, and fills another column."""
    orders = raw_of(table(spark, sf_dir, "orders"))
    text = lambda c: F.lit(c).cast("string")
    a = orders.withColumns({"note_a": F.col("o_orderpriority"), "note_b": text(None)}).select(*PAIR_COLUMNS)
    kept = orders.where("o_orderstatus <> 'P'").withColumns({
        "int_text": F.when(F.col("o_orderpriority") == "5-LOW", text("changed")).otherwise(F.col("int_text")),
        "note_a": text(" "),
        "note_b": F.col("o_orderstatus"),
    })
    repeated = kept.where("o_orderpriority = '1-URGENT'")
    return a, kept.unionByName(repeated).select(*PAIR_COLUMNS)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per nation: title, note, header on row 2 or 3, customers, repeated headers, one without header."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "k")
    header_row = F.when(F.col("k") % 3 >= 1, F.lit(3)).otherwise(F.lit(2)).cast("bigint")
    texts = lambda *values: F.array(*[F.lit(v).cast("string") for v in values])
    header = F.when(F.col("k") % 2 == 0, texts("APP AGE", "GENDER", "", "Citizenship", "Entry Status")).otherwise(
        texts("Age", " Subject  Gender", "", "CITIZENSHIP", "STATUS_AT_ENTRY")
    )
    place = header_row + F.col("c_custkey") * 2 + 2
    row = lambda df, number, cells: df.select("k", number.alias("row_number"), cells.alias("cells"))
    rows = row(nation, F.lit(1).cast("bigint"), texts("Release notice", None, "", "", ""))
    rows = rows.unionAll(row(nation.where("k % 3 >= 1"), F.lit(2).cast("bigint"), texts("gender notes", "", "", "", "")))
    rows = rows.unionAll(row(nation.where("k <> 24"), header_row, header))
    person = F.array(
        (F.col("c_custkey") % 90).cast("string"),
        F.when(F.col("c_acctbal") < 0, F.lit("M")).otherwise(F.lit("F")),
        F.lit(""),
        F.col("c_mktsegment"),
        F.col("c_custkey").cast("string"),
    )
    rows = rows.unionAll(row(customer, place, person))
    breaks = customer.where("c_mktsegment = 'BUILDING' and k % 4 = 0 and k <> 24")
    rows = rows.unionAll(row(breaks, place + 1, header))
    return rows.select(
        F.concat(F.lit("file_"), (F.col("k") % 5).cast("string"), F.lit(".xlsx")).alias("source_file"),
        F.concat(F.lit("sheet_"), F.col("k").cast("string")).alias("source_sheet"),
        "row_number",
        "cells",
    )


def dated_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sheets per year of orders: all of them, and most of the first quarter's, dates as serials or ISO text by turns."""
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate").cast("string"))
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(serial)
    gender = F.when(F.col("o_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F"))
    cells = F.array(text, (F.col("o_custkey") % 90).cast("string"), gender, F.col("o_orderpriority"))
    header = F.array(*[F.lit(c) for c in ("Apprehension Date", "Age", "Gender", "Citizenship")])

    def sheet(rows: DataFrame, name: str) -> DataFrame:
        file = F.concat(F.lit("year_"), F.col("y"), F.lit(".xlsx")).alias("source_file")
        heads = rows.select("y").distinct().select(file, F.lit(name).alias("source_sheet"), F.lit(1).cast("bigint").alias("row_number"), header.alias("cells"))
        return heads.unionAll(rows.select(file, F.lit(name), F.col("o_orderkey").cast("bigint") + 2, cells))

    quarter = orders.where((F.month("o_orderdate") <= 3) & (F.col("o_orderkey") % 10 != 0))
    return sheet(orders, "all").unionAll(sheet(quarter, "q1"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part per event type, and a second, slightly thinner release of one week of each."""
    source = table(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))

    def part(df: DataFrame, sheet: str, step: int) -> DataFrame:
        ordinal = (F.ascii("event_type") * 100 + step).cast("string")  # four digits or five
        return df.select(
            F.concat_ws("_", ordinal, "event_type", F.lit(sheet)).alias("part_file"),
            F.concat("event_type", F.lit(".xlsx")).alias("source_file"),
            F.lit(sheet).alias("source_sheet"),
            "event_date",
            "event_id",
        )

    in_week = F.col("event_date").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"))
    return part(source, "all", 0).unionAll(part(source.where(in_week & (F.col("value") >= 1)), "w2", 1))


def benchmark_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two benchmark releases by fiscal year and month, which share some years.

    Small months are withheld, the counts of May are missing from the older release, the newer one disagrees in every fourth
    month and announces a month after the last.
    """
    orders = table(spark, sf_dir, "orders")
    month, year = F.month("o_orderdate"), F.year("o_orderdate")
    counts = (
        orders.groupBy(
            (year + F.when(month >= 10, 1).otherwise(0)).alias("fy"),
            month.alias("m"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit("OTHER")).otherwise(F.lit("MAIN")).alias("component"),
        )
        .agg(F.count("*").alias("n"))
        .withColumn("mean", F.avg("n").over(Window.partitionBy("component")))
        .where("n >= 0.9 * mean")
        .withColumn("month_abbreviation", F.initcap(F.get(F.array(*[F.lit(m) for m in MONTHS]), F.col("m") - 1)))
    )

    def release(name: str, day: str, rows: DataFrame, count: Column) -> DataFrame:
        return rows.select(
            F.lit(name).alias("benchmark_id"),
            F.lit(day).cast("date").alias("release_date"),
            F.concat(F.lit("FY"), F.col("fy").cast("string")).alias("fiscal_year_text"),
            "month_abbreviation",
            "component",
            count.cast("bigint").alias("encounter_count"),
        )

    revised = F.when(F.col("m") % 4 == 0, F.col("n") + 1).otherwise(F.col("n"))
    first = release("r1", "2000-01-01", counts.where("fy % 3 <> 0"), F.when(F.col("m") != 5, F.col("n")))
    second = release("r2", "2001-01-01", counts.where("fy % 3 <> 1"), revised)
    last = orders.agg((F.max(year) + 2).cast("string").alias("fy")).select(
        F.lit("r2").alias("benchmark_id"), F.lit("2001-01-01").cast("date").alias("release_date"), F.concat(F.lit("FY"), "fy").alias("fiscal_year_text"),
        F.lit("Jan").alias("month_abbreviation"), F.lit("MAIN").alias("component"), F.lit(5).cast("bigint").alias("encounter_count"),
    )
    return first.unionAll(second).unionAll(last)
