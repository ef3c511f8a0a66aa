"""Typed tables: one projection from a declared spec, column order, profile, and audits of failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.convert import CONVERTERS, FALSE_TOKENS, TRUE_TOKENS
from gridloom.functions.text import MISSING_TOKENS, clean_text, is_missing_token, redaction_flag, tidy
from gridloom.plans.spec import TableSpec


def column_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Wanted columns first, the rest after them."""
    wanted = [c for c in order if c in df.columns]
    return df.select(*wanted, *[c for c in df.columns if c not in wanted])


def column_order_report(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``column, position, state``: kept columns in final order, plus those missing from or extra to the order."""
    kept = [(c, "ordered") for c in order if c in df.columns]
    extra = [(c, "extra") for c in df.columns if c not in order]
    rows = [(c, i, state) for i, (c, state) in enumerate(kept + extra, 1)]
    rows += [(c, None, "missing") for c in order if c not in df.columns]
    structs = [F.struct(F.lit(c).alias("column"), F.lit(i).cast("int").alias("position"), F.lit(s).alias("state")) for c, i, s in rows]
    return df.sparkSession.range(1).select(F.inline(F.array(*structs)))


def _texts(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def _with_flags(values: dict[str, Column], flagged: Sequence[str]) -> list[Column]:
    output = []
    for c, value in values.items():
        output.append(value.alias(c))
        if c in flagged:
            output.append(F.col(f"{c}_redacted"))
    return output


def typed_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Text table to typed table, flags next to their column.

    The cleaned text is a projection of its own, so each conversion refers to it without recomputing it. Columns are
    typed one by one at any width: who reads one column scans and converts that column alone. Very wide
    tables want ``RECOMMENDED_CONF``, which keeps generated methods small enough for the JVM to compile.
    """
    ordered = column_order(df, spec.order)
    flagged = [c for c in ordered.columns if c in spec.redaction_flags]
    cleaned = ordered.select(
        *[clean_text(F.col(c)).alias(c) for c in ordered.columns],
        *[redaction_flag(F.col(c)).alias(f"{c}_redacted") for c in flagged],
    )
    return cleaned.select(*_with_flags({c: CONVERTERS[spec.kind(c)](F.col(c)) for c in ordered.columns}, flagged))


def audit(df: DataFrame, spec: TableSpec, kinds: Sequence[str]) -> DataFrame:
    """Values of the given kinds that no conversion accepts: ``column, raw_value, n``.

    One scan serves all columns: a row's values are cleaned as an array and unfolded, filtered to the
    failures, and counted with map-side combining. Missing-value tokens are not failures.
    """
    by_kind = {k: [c for c in df.columns if spec.kind(c) == k] for k in kinds}
    columns = [c for names in by_kind.values() for c in names]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, raw_value string, n bigint")
    value = F.col("raw_value")
    failed, last = F.when(F.lit(False), F.lit(False)), 0
    for kind, names in by_kind.items():
        last += len(names)
        if kind == "logical":
            unknown = ~F.upper(value).isin(*TRUE_TOKENS, *FALSE_TOKENS, *MISSING_TOKENS)
        else:
            unknown = CONVERTERS[kind](value).isNull()
        failed = failed.when(F.col("_index") < last, unknown)
    unfolded = df.select(F.posexplode(F.transform(_texts(columns), tidy)).alias("_index", "raw_value"))
    names = F.array(*[F.lit(c) for c in columns])
    return (
        unfolded.where((value != "") & ~is_missing_token(value))
        .where(failed)
        .groupBy("_index", "raw_value")
        .agg(F.count("*").alias("n"))
        .select(F.get(names, F.col("_index")).alias("column"), "raw_value", "n")
    )


def audit_datetime(df: DataFrame, spec: TableSpec) -> DataFrame:
    return audit(df, spec, ["datetime"])


def audit_date(df: DataFrame, spec: TableSpec) -> DataFrame:
    return audit(df, spec, ["date"])


def audit_time(df: DataFrame, spec: TableSpec) -> DataFrame:
    return audit(df, spec, ["time"])


def audit_logical(df: DataFrame, spec: TableSpec) -> DataFrame:
    return audit(df, spec, ["logical"])


def audit_numeric(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Integer and double failures together, most frequent first."""
    return audit(df, spec, ["integer", "double"]).orderBy(F.desc("n"), "column", "raw_value")


def audit_all(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every kind in one pass."""
    return audit(df, spec, [k for k in CONVERTERS if k != "text"])


def type_tally(df: DataFrame) -> DataFrame:
    """Number of columns of each type, from the schema alone."""
    types = [f.dataType.simpleString() for f in df.schema.fields]
    rows = [F.struct(F.lit(t).alias("type"), F.lit(types.count(t)).cast("bigint").alias("n_columns")) for t in sorted(set(types))]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, and how many of the table's rows hold a value. One aggregation."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    columns = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("n_rows"),
            F.col(f.name).alias("n_values"),
        )
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return counts.select(F.inline(F.array(*columns)))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows in the order of all columns, so that a table shows the same rows each time. Tasks keep ``n`` rows each."""
    return df.orderBy(*[F.col(f"`{c}`") for c in df.columns]).limit(n)
