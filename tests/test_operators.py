"""Operators against brute force and hand-made cases."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridloom.catalog import inputs
from gridloom.operators import benchmark as bm
from gridloom.operators import compare as cmp
from gridloom.operators import crosswalk as cw
from gridloom.operators import grid as g
from gridloom.operators import links as lk
from gridloom.operators import lists as ls
from gridloom.operators import overlap as ov
from gridloom.operators import parts as pt
from gridloom.operators import report as rp
from gridloom.operators import typed as ty
from gridloom.operators.common import CheckFailed, first_names, keep_first, require_empty, with_ordinal
from gridloom.plans.profiles import APPREHENSIONS, INADMISSIBLES, PROFILES
from gridloom.plans.spec import TableSpec

DAY = dt.date(2024, 1, 1)


def tuples(df):
    return [tuple(r) for r in df.collect()]


# ---- helpers


def test_with_ordinal_numbers_every_row_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("k"))
    rows = sorted(tuples(with_ordinal(df, ["k"], "n")))
    assert [n for _, n in rows] == list(range(1, 5001))
    assert with_ordinal(df.where("false"), ["k"], "n").count() == 0


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    first = keep_first(df, ["k"], ["id"])
    assert sorted(tuples(first)) == [(0, 0), (1, 1)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_first_names(spark):
    df = spark.createDataFrame([("a", f"f{i}") for i in range(9)] + [("b", "z")], "k string, v string")
    assert dict(tuples(first_names(df, ["k"], "v", 5, "names"))) == {"a": "f0 | f1 | f2 | f3 | f4", "b": "z"}


def test_require_empty(spark):
    require_empty(spark.range(0), "fine")
    with pytest.raises(CheckFailed, match="not fine"):
        require_empty(spark.range(1), "not fine")


# ---- links


URLS = [
    ("x.csv", "http://h.org/a/x.csv"), ("/x.csv", "http://h.org/x.csv"), ("../x.csv", "http://h.org/x.csv"),
    ("./x/../y.csv", "http://h.org/a/y.csv"), ("//o.org/x", "http://o.org/x"), ("https://o.org/x?a=/../b", "https://o.org/x?a=/../b"),
    ("?p=2", "http://h.org/a/page?p=2"), ("#top", "http://h.org/a/page?q=1#top"), ("mailto:a@b", "mailto:a@b"),
    ("/x.csv?v=../1", "http://h.org/x.csv?v=../1"), ("../../../x", "http://h.org/x"),
]


def test_absolute_url(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(URLS)], "i int, h string")
    got = df.orderBy("i").select(lk.absolute_url(F.col("h"), F.lit("http://h.org/a/page?q=1#s")))
    assert [r[0] for r in got.collect()] == [u for _, u in URLS]


HTML = """<body><a href="/d/apprehensions.xlsx">Nationwide <b>Apprehensions</b>&nbsp;FY25</a><a name="x">no</a>
<A class='k' HREF='demo.xlsx'>Apprehensions by
 Demographic</A><a href=/d/other.csv>Seizures</a><a href="/d/apprehensions.xlsx">t8 again</a><a href="/about">apprehensions</a></body>"""


def test_link_extract_and_classify(spark):
    pages = spark.createDataFrame([(1, "http://h.org/p/index", HTML)], "page_id long, url string, html string")
    links = lk.link_extract(pages)
    assert [(r.text, r.full_url) for r in links.orderBy("position").collect()] == [
        ("Nationwide Apprehensions FY25", "http://h.org/d/apprehensions.xlsx"),
        ("Apprehensions by Demographic", "http://h.org/p/demo.xlsx"),
        ("Seizures", "http://h.org/d/other.csv"),
        ("t8 again", "http://h.org/d/apprehensions.xlsx"),
        ("apprehensions", "http://h.org/about"),
    ]
    p = APPREHENSIONS
    kept = lk.link_classify(links, p.kind, p.link_terms, p.too_specific_terms)
    assert sorted((r.text, r.download_class) for r in kept.collect()) == [
        ("Apprehensions by Demographic", "manual_review"),
        ("Nationwide Apprehensions FY25", "include_apprehensions"),
    ]
    assert lk.link_new(kept, kept.limit(1)).count() == 1
    assert lk.link_filter_simple(links, "seizure").count() == 1


# ---- grids


def grid_of(spark, sheets):
    rows = [(f, s, i, cells) for (f, s), sheet in sheets.items() for i, cells in enumerate(sheet, 1)]
    return spark.createDataFrame(rows, "source_file string, source_sheet string, row_number long, cells array<string>")


def test_header_search_stops_after_the_first_rows(spark):
    header = ["Age", "Gender", "Citizenship"]
    grid = grid_of(spark, {
        ("a.xlsx", "late"): [["x"]] * 100 + [header],
        ("a.xlsx", "edge"): [["x"]] * 99 + [header],
        ("~$a.xlsx", "lock"): [header],
    })
    found = {(r.source_sheet): r.header_row for r in g.header_detect(grid, APPREHENSIONS.header_terms).collect()}
    assert found == {"late": None, "edge": 100}
    failed = g.failed_sheets(g.grid_sheet_inventory(grid), g.header_rows(grid, APPREHENSIONS.header_terms))
    assert [r.source_sheet for r in failed.collect()] == ["late"]


def test_header_terms_with_blanks(spark):
    grid = grid_of(spark, {("i.xlsx", "s"): [["Field Office", "City Name", "Subject/Person ID"]]})
    assert g.header_rows(grid, INADMISSIBLES.header_terms).count() == 1
    assert g.header_rows(grid, INADMISSIBLES.header_terms, literal_terms=True).count() == 0
    assert g.header_rows(grid_of(spark, {("a", "s"): [["language", "agent", "page"]]}), ["age"], whole_words=True).count() == 0


def test_columns_repeated_headers_and_ragged_rows(spark):
    grid = grid_of(spark, {("a.xlsx", "s"): [
        ["Age", None, "Gender", "Age", " "], ["1", "x", "M", "2", "y"], ["age", "", "GENDER", "9", ""], ["3"],
    ]})
    headers = g.header_rows(grid, APPREHENSIONS.header_terms)
    inventory = g.column_inventory(grid, headers)
    assert [(r.clean_column, r.column_position, r.cell_position, r.ncol) for r in inventory.orderBy("column_position").collect()] == [
        ("age", 1, 1, 3), ("gender", 2, 3, 3), ("age_2", 3, 4, 3),
    ]
    canonical = inventory.withColumn("canonical_name", F.col("clean_column"))
    layouts = g.sheet_layouts(canonical, ["gender", "age", "age_2", "absent"])
    rows = g.standardize_part(grid, layouts, ["gender", "age", "age_2", "absent"])
    assert sorted(tuples(rows), key=str) == [("a.xlsx", "s", "M", "1", "2", None), ("a.xlsx", "s", None, "3", None, None)]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(None, " ", "x"), (None, "", None)], "a string, b string, c string")
    assert g.drop_empty_columns(df).columns == ["c"]


def test_inventory_keeps_the_old_entry(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")
    assert sorted(tuples(g.merge_inventory(old, new, ["k"]))) == [("a", 1), ("b", 3)]


# ---- crosswalk


def test_crosswalk_rules_of_the_profiles(spark):
    rules = {r.clean_column: r.canonical_name for r in cw.rules_frame(spark, APPREHENSIONS.crosswalk).collect()}
    assert rules["arrest_date_time"] == "arrest_datetime"
    assert rules["juvenile_18"] == "juvenile_18_indicator"
    assert rules["refferred_for_prosecution_under_8_usc_1325_or_8_usc_1326"] == "prosecution_indicator"
    for profile in PROFILES.values():
        variants = [v for vs in profile.crosswalk.values() for v in vs]
        assert len(variants) == len(set(variants))


def test_crosswalk_conflicts(spark):
    inventory = spark.createDataFrame(
        [("a", "s", "age"), ("a", "s", "app_age"), ("b", "s", "app_age")], "source_file string, source_sheet string, clean_column string"
    )
    conflicts = cw.crosswalk_conflicts(inventory, cw.rules_frame(spark, APPREHENSIONS.crosswalk))
    assert tuples(conflicts) == [("a", "s", "age", "age | app_age", 2)]


# ---- parts


def test_part_names_never_move(spark):
    sheets = lambda rows: spark.createDataFrame(rows, "source_file string, source_sheet string")
    first = pt.part_naming(sheets([("B file (1).xlsx", "Q1"), ("C.xlsx", "Q1")]))
    assert sorted(r.part_file for r in first.collect()) == ["0001_b_file_1_q1", "0002_c_q1"]
    later = pt.part_naming(sheets([("A.xlsx", "Q1"), ("C.xlsx", "Q1")]), first)
    assert [(r.ordinal, r.part_file) for r in later.collect()] == [(3, "0003_a_q1")]


def test_part_single_source_and_summary(spark):
    parts = spark.createDataFrame(
        [("p", "f", "s", "45123", None), ("p", "f", "s", "bad", " "), ("q", "f", "s", None, "x"), ("q", "g", "s", "", "x"), ("r", "f", "s", None, "x")],
        "part_file string, source_file string, source_sheet string, d1 string, d2 string",
    )
    assert tuples(pt.part_single_source(parts)) == [("q", 2, 2)]
    summary = {r.part_file: r for r in pt.part_summary(parts, ["d1", "d2"]).collect()}
    assert (summary["p"].date_column, summary["p"].min_date, summary["p"].non_empty_cols) == ("d1", dt.date(2023, 7, 16), "d1")
    assert (summary["r"].date_column, summary["r"].min_date, summary["r"].n_non_empty_cols) == ("d2", None, 1)


# ---- typing and audits


def test_audited_values_are_exactly_those_lost(spark):
    spec = TableSpec(date=("d",), integer=("i",), logical=("l",), redaction_flags=("d",))
    df = spark.createDataFrame(
        [("2024-01-05", "1", "Y", "t"), ("01/05/2024", "x", "maybe", " "), ("(b)(6)", "NA", "n/a", None), (None, "", "0", "u")],
        "d string, i string, l string, t string",
    )
    typed = ty.typed_table(df, spec)
    assert dict(typed.dtypes) == {"d": "date", "d_redacted": "boolean", "i": "int", "l": "boolean", "t": "string"}
    assert [r.d_redacted for r in typed.collect()] == [False, False, True, False]
    audited = {(c, v): n for c, v, n in tuples(ty.audit_all(df, spec))}
    assert audited == {("d", "01/05/2024"): 1, ("d", "(b)(6)"): 1, ("i", "x"): 1, ("l", "maybe"): 1}
    assert ty.audit_time(df, spec).count() == 0


def test_column_order_report(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert ty.column_order(df, ["c", "x", "a"]).columns == ["c", "a", "b"]
    assert sorted(tuples(ty.column_order_report(df, ["c", "x", "a"])), key=str) == [
        ("a", 2, "ordered"), ("b", 3, "extra"), ("c", 1, "ordered"), ("x", None, "missing"),
    ]


def test_one_column_of_a_wide_table_reads_one_column(spark, tmp_path):
    spec = PROFILES["apprehensions"].table
    spark.range(3).select(*[F.lit("45123.5").alias(c) for c in spec.order]).write.parquet(str(tmp_path / "wide"))
    typed = ty.typed_table(spark.read.parquet(str(tmp_path / "wide")), spec)
    plan = typed.select("age")._jdf.queryExecution().executedPlan().toString()
    assert len(spec.order) > 90 and "ReadSchema: struct<age:string>" in plan


def test_whole_column_lists_can_be_typed(spark):
    for profile in PROFILES.values():
        df = spark.range(3).select(*[F.lit("45123.5").alias(c) for c in profile.table.order])
        typed = ty.typed_table(df, profile.table)
        assert typed.count() == 3 and len(typed.collect()[0]) == len(typed.columns)
        assert sum(r.n_columns for r in ty.type_tally(typed).collect()) == len(typed.columns)


# ---- pair comparison


def pair_of(spark, seed):
    rng = random.Random(seed)
    schema = "k string, v string"
    rows = lambda n: [(rng.choice(["a", "b", None]), rng.choice(["1", "2", "3", None, " "])) for _ in range(n)]
    a, b = rows(60), rows(12)
    return a, b, spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


@pytest.mark.parametrize("seed", range(3))
def test_pair_operators_equal_brute_force(spark, seed):
    a, b, df_a, df_b = pair_of(spark, seed)
    columns = ["k", "v"]
    only_a, only_b = [r for r in a if r not in b], [r for r in b if r not in a]
    assert Counter(tuples(cmp.rows_only_in_a(df_a, df_b, columns))) == Counter(only_a)
    assert Counter(tuples(cmp.rows_only_in_b(df_a, df_b, columns))) == Counter(only_b)
    summary = cmp.pair_match_summary(df_a, df_b, columns).first()
    assert (summary.rows_a, summary.only_in_a, summary.matching_a) == (len(a), len(only_a), len(a) - len(only_a))
    for r in cmp.pair_value_diff(df_a, df_b, columns).collect():
        i = columns.index(r["column"])
        va, vb = {x[i] for x in only_a} - {None}, {x[i] for x in only_b} - {None}
        assert (r.values_only_in_a, r.values_only_in_b, r.identical_unique_values) == (len(va - vb), len(vb - va), va == vb)
    assert not cmp.pair_multiset_equal(df_a, df_b, columns).first().identical
    assert cmp.pair_multiset_equal(df_a, df_a.orderBy("k"), columns).first().identical


def test_a_row_with_very_many_copies_is_kept_whole(spark):
    a = spark.range(20000).select(F.lit("hot").alias("k")).unionAll(spark.range(5).select(F.lit("x").alias("k")))
    b = spark.range(1).select(F.lit("x").alias("k"))
    only = cmp.rows_only_in_a(a, b, ["k"])
    assert only.count() == 20000
    sizes = [len(p) for p in only.rdd.glom().collect()]
    assert max(sizes) < 20000


def test_shared_columns(spark):
    a = spark.createDataFrame([("x", " ", "1")], "m string, n string, o string")
    b = spark.createDataFrame([("y", "2", None)], "m string, n string, o string")
    assert cmp.shared_columns(a, b) == ["m"]
    assert sorted(tuples(cmp.pair_columns_only(a, b))) == [("n", "b"), ("o", "a")]
    with pytest.raises(CheckFailed):
        cmp.shared_columns(a.select("o"), b.select("o"))


# ---- overlap


def metadata_of(spark, seed, n=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        low = DAY + dt.timedelta(days=rng.randrange(0, 90, 5))
        rows.append((f"p{i:03}", low, low + dt.timedelta(days=rng.randrange(0, 60, 10)), i))
    rows.append(("undated", None, None, 1))
    return rows, spark.createDataFrame(rows, "part_file string, min_date date, max_date date, n_rows int")


@pytest.mark.parametrize("seed", range(3))
def test_containment_equals_brute_force(spark, seed):
    rows, metadata = metadata_of(spark, seed)
    dated = sorted([r for r in rows if r[1]], key=lambda r: (r[1], r[2], r[0]))
    covers = lambda big, small: big[1] <= small[1] and big[2] >= small[2]
    pairs = [
        (s[0], b[0]) for s in dated for b in dated
        if s[0] != b[0] and covers(b, s) and ((b[1], b[2]) != (s[1], s[2]) or s[0] < b[0])
    ]
    got = ov.contained_pairs(metadata).orderBy("pair_id").select("pair_id", "smaller_file", "larger_file")
    assert tuples(got) == [(i, *p) for i, p in enumerate(pairs, 1)]
    flags = {r.part_file: r.contained for r in ov.coverage_contained_flag(metadata).collect()}
    assert flags == {s[0]: any(s[0] != b[0] and covers(b, s) for b in dated) for s in dated}


@pytest.mark.parametrize(("seed", "piece"), [(1, 2), (2, 8), (3, 30)])
def test_cut_blocks_hold_the_same_pairs(spark, seed, piece):
    rows, metadata = metadata_of(spark, seed)
    many = metadata.unionAll(metadata.where("part_file < 'p010'").selectExpr("concat('same ', part_file)", "DATE'2024-01-01'", "DATE'2024-03-01'", "n_rows"))
    whole = sorted(tuples(ov.containing_pairs(many)), key=str)
    assert len(whole) > 100 and sorted(tuples(ov.containing_pairs(many, piece)), key=str) == whole
    assert ov.containing_pairs(many.limit(0), piece).count() == 0


def test_cut_pieces_are_in_proportion_to_the_pairs(spark):
    """Parts that end before all ranges begin to, one start day: nothing to be found, nothing to be compared."""
    day = dt.date(2020, 1, 1)
    rows = [(f"s{i}", day, day + dt.timedelta(days=900 + i), 1) for i in range(300)] + [(f"l{i}", day - dt.timedelta(days=i + 1), day + dt.timedelta(days=i + 1), 1) for i in range(300)]
    metadata = spark.createDataFrame(rows, "part_file string, min_date date, max_date date, n_rows int")
    ranges = metadata.select("part_file", "min_date", "max_date")
    smaller = ranges.selectExpr("part_file smaller_file", "max_date smaller_max_date", "0 level", "0 at")
    larger = ranges.selectExpr("part_file larger_file", "max_date larger_max_date", "0 level", "0 at")
    ends = ov._ends(smaller, larger)
    places, grid = ov._pieces(ends, 16)
    sizes = {r.slice: r.n for r in places.join(ends, ["level", "at", "end"]).groupBy("slice").agg(F.sum(F.col("s") + F.col("l")).alias("n")).collect()}
    assert sum(sizes.values()) == 1200 and max(sizes.values()) <= 2 * 16 and all(r.low <= r.high and r.parts_smaller * 16 >= 1 for r in grid.collect())
    found = ov.containing_pairs(metadata, 16)
    assert found.count() == sum(1 for a in rows for b in rows if a[0] != b[0] and b[1] <= a[1] and b[2] >= a[2] and (b[1:3] != a[1:3] or a[0] < b[0]))


def test_a_long_range_costs_its_rows(spark):
    long = spark.createDataFrame([("a", dt.date(1, 1, 1), dt.date(9999, 12, 31), "b", dt.date(1, 1, 1), dt.date(9999, 12, 31), 1)], "smaller_file string, smaller_min_date date, smaller_max_date date, larger_file string, larger_min_date date, larger_max_date date, pair_id long")
    counts = spark.createDataFrame([("a", DAY, 2), ("b", DAY, 2), ("b", DAY + dt.timedelta(days=1), 2), ("a", DAY + dt.timedelta(days=1), 2), ("b", DAY + dt.timedelta(days=5), 1)], "part_file string, event_date date, daily_count long")
    runs = tuples(ov.daily_intervals(long, counts).orderBy("from_date").select("from_date", "to_date", "smaller_daily_count", "larger_daily_count"))
    day = lambda n: DAY + dt.timedelta(days=n)
    assert runs == [(dt.date(1, 1, 1), day(-1), 0, 0), (DAY, day(1), 2, 2), (day(2), day(4), 0, 0), (day(5), day(5), 0, 1), (day(6), dt.date(9999, 12, 31), 0, 0)]
    assert ov.date_spine(long).count() == 3_652_059


def test_equal_parts_by_fingerprints(spark, monkeypatch):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", None, "y"), ("b", None, "y"), ("b", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), ("c", None, "y"), ("c", None, "y"), ("d", 1, None), ("e", None, "1"), ("f", 1, None)]
    parts = spark.createDataFrame(rows, "part_file string, n int, t string")
    expected = [("b", "a", 3), ("f", "d", 1)]
    assert sorted(tuples(pt.equal_parts(parts, ["n", "t"]))) == expected
    days = spark.createDataFrame([(p, DAY, DAY + dt.timedelta(days=int(p == "f")), 1) for p in "abcdef"], "part_file string, min_date date, max_date date, n_rows int")
    assert sorted(tuples(pt.equal_parts(parts, ["n", "t"], days))) == expected[:1]
    # Should hashes ever agree where rows do not, the rows decide.
    monkeypatch.setattr(pt, "fingerprints", lambda parts, columns: parts.groupBy("part_file").agg(F.count("*").alias("n_rows"), F.lit(0).alias("sum_1"), F.lit(0).alias("sum_2")))
    assert sorted(tuples(pt.equal_parts(parts, ["n", "t"]))) == expected


def test_daily_comparison_fills_absent_days(spark):
    events = spark.createDataFrame(
        [("a", DAY), ("a", DAY), ("a", DAY + dt.timedelta(days=2)), ("b", DAY), ("b", DAY + dt.timedelta(days=9)), ("c", None)],
        "part_file string, d date",
    )
    metadata = events.groupBy("part_file").agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"))
    pairs = ov.contained_pairs(metadata)
    comparison = ov.daily_comparison(pairs, ov.daily_counts(events, F.col("d"), pairs))
    rows = comparison.orderBy("event_date").select("smaller_daily_count", "larger_daily_count", "daily_counts_match")
    assert tuples(rows) == [(2, 1, False), (0, 0, True), (1, 0, False)]
    summary = ov.pair_summary(pairs, ov.daily_counts(events, F.col("d"), pairs)).first()
    assert (summary.days_compared, summary.differing_days, summary.total_count_difference) == (3, 2, 2)
    assert (summary.maximum_absolute_daily_difference, summary.all_daily_counts_match) == (1, False)


# ---- benchmark


def releases_of(spark, rows):
    return spark.createDataFrame(
        rows,
        "benchmark_id string, release_date date, fiscal_year_text string, month_abbreviation string, component string, encounter_count long",
    )


def test_newest_release_wins_and_months_are_checked(spark):
    rows = [
        ("r1", DAY, "2020", "OCT", "M", 5), ("r2", dt.date(2024, 6, 1), "2020", "Oct", "M", 3), ("r2", dt.date(2024, 6, 1), "2020", "oct", "M", 4),
        ("r1", DAY, "2020 (FYTD)", "JAN", "M", 8), ("r1", DAY, "2020", "OCT", "other", 100), ("r1", DAY, "2020", "Okt", "M", 1),
    ]
    union = bm.benchmark_union(releases_of(spark, rows), "M")
    assert bm.benchmark_invalid_months(union).count() == 1
    latest = bm.benchmark_latest(bm.fiscal_to_calendar(union.where("fiscal_month is not null")))
    assert sorted((r.month_start, r.benchmark_count) for r in latest.collect()) == [(dt.date(2019, 10, 1), 7), (dt.date(2020, 1, 1), 8)]


def test_cross_reference_arithmetic(spark):
    """Counts that are equal, off by a few, on one side only, and zero."""
    latest = spark.createDataFrame(
        [(2020, 10, dt.date(2019, 10, 1), 45139), (2020, 11, dt.date(2019, 11, 1), 42643), (2020, 12, dt.date(2019, 12, 1), 0), (2020, 1, dt.date(2020, 1, 1), 9)],
        "fiscal_year int, fiscal_month int, month_start date, benchmark_count long",
    )
    monthly = spark.createDataFrame(
        [(dt.date(2019, 10, 1), 45139), (dt.date(2019, 11, 1), 42610), (dt.date(2019, 12, 1), 2), (dt.date(2020, 10, 1), 1)],
        "month_start date, final_count long",
    )
    comparison = bm.cross_reference(latest, monthly)
    got = {r.month_start.isoformat(): (r.fiscal_year, r.difference, r.percent_difference, r.status) for r in comparison.collect()}
    assert got["2019-10-01"] == (2020, 0, 0.0, "exact match")
    assert got["2019-11-01"][1] == -33 and got["2019-11-01"][3] == "difference"
    assert got["2019-12-01"] == (2020, 2, None, "difference")
    assert got["2020-01-01"] == (2020, None, None, "missing from final")
    assert got["2020-10-01"] == (2021, None, None, "missing from benchmark")
    assert tuples(bm.cross_reference_summary(comparison)) == [(5, 1, 2, 2, 33)]


# ---- reports and lists


def test_week_starts_on_monday_and_by_file_fans_out(spark):
    events = spark.createDataFrame([("f", "s1", dt.date(2024, 1, 7)), ("f", "s1", dt.date(2024, 1, 8)), ("f", "s2", None)], "source_file string, source_sheet string, d date")
    weekly = rp.weekly_counts_by_source(events, F.col("d"))
    assert sorted(r.week_start for r in weekly.collect()) == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
    metadata = spark.createDataFrame([("f", "s1", "0001_f_s1"), ("f", "s2", "0002_f_s2")], "source_file string, source_sheet string, part_file string")
    assert rp.weekly_with_part(weekly, metadata).count() == 2
    assert rp.weekly_with_part(weekly, metadata, by_file=True).count() == 4
    last = rp.latest_week_per_part(rp.weekly_with_part(weekly, metadata), "2024-01-01").collect()
    assert [(r.part_number, r.week_start) for r in last] == [("0001", dt.date(2024, 1, 8))]


def test_collapse_keeps_nulls_and_splits_long_lists(spark):
    df = spark.createDataFrame([("g", i, None if i == 2 else str(i)) for i in range(6)] + [("h", 0, None)], "k string, o int, v string")
    folded = ls.collapse_multivalue(df, "v", order="o")
    assert sorted(tuples(folded)) == [("g", ["0", "1", None, "3", "4", "5"], 1), ("h", [None], 2)]
    text = folded.select("k", ls.list_to_text(F.col("v_list")))
    assert dict(tuples(text)) == {"g": "0, 1, NA, 3, 4, 5", "h": "NA"}
    parts = ls.collapse_multivalue(df, "v", order="o", group_id=None, split_every=4)
    assert sorted((r.k, r.list_part, len(r.v_list)) for r in parts.collect()) == [("g", 0, 4), ("g", 1, 2), ("h", 0, 1)]
