"""SQL twins of the registered queries, for a database that reads the same tables.

They are written from the meaning of each operator, mostly by plainer means than the Spark plans: row
comparison by correlated NOT EXISTS, containment by a self join, conversions by the database's own casts.
"""

from __future__ import annotations

from gridloom.catalog.inputs import TEXT_OF_KIND
from gridloom.plans.profiles import APPREHENSIONS

SERIAL_EPOCH = "date '1899-12-30'"


# ---- scalar text

def clean(c: str) -> str:
    marked = rf"regexp_replace(cast({c} as varchar), '\(b\)\s*\(7\)\s*\(\s*E\s*\)', '(b)(7)(E)', 'gi')"
    return rf"nullif(trim(regexp_replace({marked}, '\s+', ' ', 'g')), '')"


def squish(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[\s\x0B\x{{85}}\x{{A0}}\p{{Z}}]+', ' ', 'g'))"


def name(c: str) -> str:
    s = f"strip_accents({c})"
    s = f"replace(replace({s}, '\"', ''), '''', '')"
    s = f"replace(replace({s}, '%', '_percent_'), '#', '_number_')"
    s = rf"regexp_replace({s}, '([a-z])([A-Z])', '\1_\2', 'g')"
    s = rf"regexp_replace({s}, '([A-Z])([A-Z][a-z])', '\1_\2', 'g')"
    s = f"trim(regexp_replace(lower({s}), '[^a-z0-9]+', '_', 'g'), '_')"
    return rf"regexp_replace({s}, '^([0-9]|$)', 'x\1')"


def has_data(c: str) -> str:
    return rf"coalesce(regexp_matches(cast({c} as varchar), '[^\s\x0B\x{{85}}\x{{A0}}\p{{Z}}]'), false)"


# ---- conversions of cleaned text

def as_datetime(v: str) -> str:
    return (
        f"case when try_cast({v} as timestamp) is not null then try_cast({v} as timestamp) "
        f"when try_cast({v} as double) is not null then timestamp '1899-12-30' + "
        f"to_microseconds(cast(round(try_cast({v} as double) * 86400000000) as bigint)) end"
    )


def as_date(v: str) -> str:
    return (
        f"case when try_cast({v} as date) is not null then try_cast({v} as date) "
        f"when try_cast({v} as double) is not null then {SERIAL_EPOCH} + cast(trunc(try_cast({v} as double)) as integer) end"
    )


def as_us_date(v: str) -> str:
    return rf"coalesce({as_date(v)}, cast(try_strptime(regexp_extract({v}, '^\d{{1,2}}/\d{{1,2}}/\d{{4}}'), '%m/%d/%Y') as date))"


def as_time(v: str) -> str:
    d = f"try_cast({v} as double)"
    return (
        f"cast(case when try_cast({v} as time) is not null then try_cast({v} as time) when {d} is not null "
        f"then time '00:00:00' + to_microseconds(cast(round(({d} - floor({d})) * 86400000000) as bigint)) end as varchar)"
    )


TRUE, FALSE, MISSING = "('Y', 'YES', 'TRUE', 'T', '1')", "('N', 'NO', 'FALSE', 'F', '0')", "('NA', 'N/A', 'NULL')"


def as_logical(v: str) -> str:
    return f"case when upper({v}) in {TRUE} then true when upper({v}) in {FALSE} then false end"


def as_integer(v: str) -> str:
    return f"try_cast({v} as integer)"


def as_double(v: str) -> str:
    return f"try_cast({v} as double)"


def redacted(c: str) -> str:
    return rf"coalesce(regexp_matches(cast({c} as varchar), '\(b\)\s*\(\s*[0-9]+\s*\)', 'i'), false)"


def ladder(c: str) -> str:
    s = f"nullif({squish(c)}, '')"
    return (
        f"coalesce({SERIAL_EPOCH} + cast(floor(try_cast({s} as double)) as integer), "
        rf"try_cast(regexp_extract({s}, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}') as date), "
        rf"cast(try_strptime(regexp_extract({s}, '^\d{{1,2}}/\d{{1,2}}/\d{{4}}'), '%m/%d/%Y') as date))"
    )


# ---- inputs

RAW = """
raw_orders as (select *,
    cast(date_diff('day', date '1899-12-30', cast(o_orderdate as date)) as varchar) serial,
    strftime(o_orderdate, '%Y-%m-%d') iso, strftime(o_orderdate, '%m/%d/%Y') us, cast(o_custkey as varchar) cust
  from orders),
raw_all as (select *,
    cast(o_orderkey as varchar) record_id,
    concat('part_', cast(year(o_orderdate) as varchar), '.xlsx') source_file, 'sheet1' source_sheet,
    case o_orderkey % 8 when 0 then serial when 1 then iso when 2 then iso || ' 13:45:00' when 3 then us
      when 4 then '  ' when 5 then ' (B) (7)( e )' when 6 then 'n/a' else serial || '.25' end date_text,
    case o_orderkey % 6 when 0 then serial || '.5' when 1 then iso || ' 08:15' when 2 then iso || 'T23:59:59.125'
      when 3 then us || ' 10:00' when 4 then '(b)(6)' end stamp_text,
    case o_orderkey % 7 when 0 then 'Y' when 1 then ' no ' when 2 then 'TRUE' when 3 then '0' when 4 then 'N/A'
      when 5 then '(b)(6)' end flag_text,
    case o_orderkey % 6 when 0 then cust || '.0' when 1 then cust when 2 then cust || '.5' when 3 then 'unknown'
      when 4 then '-' || cust || '.5' else '' end int_text,
    case o_orderkey % 5 when 0 then cust || '.25' when 1 then '1e3' when 2 then '1,000' when 3 then 'null' else '-.5' end ratio_text,
    case o_orderkey % 5 when 0 then '13:45' when 1 then '07:08:09' when 2 then '0.75' when 3 then '45123.5'
      else '(b)(7)(E)' end time_text
  from raw_orders),
raw as (select record_id, source_file, source_sheet, date_text, stamp_text, flag_text, int_text, ratio_text, time_text from raw_all)"""

PARTS = RAW + """,
parts as (select lpad(cast(cast(regexp_extract(source_file, '[0-9]+') as integer) - 1991 as varchar), 4, '0') || '_' || source_file part_file,
    record_id, source_file, source_sheet, date_text, stamp_text,
    case when cast(regexp_extract(source_file, '[0-9]+') as integer) % 2 = 0 then flag_text end flag_text,
    int_text, ratio_text, time_text from raw)"""

DATED_PARTS = PARTS + """,
dated as (select *, case when flag_text is not null then date_text end flag_date from parts)"""

PAIR = RAW + """,
rel_a as (select source_file, source_sheet, date_text, stamp_text, flag_text, int_text, o_orderpriority note_a, cast(null as varchar) note_b from raw_all),
kept_b as (select source_file, source_sheet, date_text, stamp_text, flag_text,
    case when o_orderpriority = '5-LOW' then 'changed' else int_text end int_text, ' ' note_a, o_orderstatus note_b, o_orderpriority
  from raw_all where o_orderstatus <> 'P'),
rel_b as (select * exclude (o_orderpriority) from kept_b union all select * exclude (o_orderpriority) from kept_b where o_orderpriority = '1-URGENT')"""

COMPARED = ["source_file", "source_sheet", "date_text", "stamp_text", "flag_text", "int_text"]
PAIR_ALL = COMPARED + ["note_a", "note_b"]

GRID = """
grid_n as (select n_nationkey k, case when n_nationkey % 3 >= 1 then 3 else 2 end hdr from nation),
grid_c as (select *, c_nationkey k, case when c_nationkey % 3 >= 1 then 3 else 2 end hdr from customer),
grid_h as (select k, hdr, case when k % 2 = 0 then ['APP AGE', 'GENDER', '', 'Citizenship', 'Entry Status']
    else ['Age', ' Subject  Gender', '', 'CITIZENSHIP', 'STATUS_AT_ENTRY'] end cells from grid_n where k <> 24),
grid as (select concat('file_', cast(k % 5 as varchar), '.xlsx') source_file, concat('sheet_', cast(k as varchar)) source_sheet,
    cast(row_number as bigint) row_number, cells from (
  select k, 1 row_number, ['Release notice', null, '', '', ''] cells from grid_n
  union all select k, 2, ['gender notes', '', '', '', ''] from grid_n where hdr = 3
  union all select k, hdr, cells from grid_h
  union all select k, hdr + 2 * c_custkey + 2, [cast(c_custkey % 90 as varchar), case when c_acctbal < 0 then 'M' else 'F' end, '', c_mktsegment, cast(c_custkey as varchar)] from grid_c
  union all select c.k, c.hdr + 2 * c_custkey + 3, h.cells from grid_c c join grid_h h on c.k = h.k where c.c_mktsegment = 'BUILDING' and c.k % 4 = 0) g)"""

TERMS = (
    "event|citizenship|gender|age|indicator|sector|status|entry|disposition|transfer|juvenile|unaccompanied|family|fear"
    "|program|nationality|children"
)

SHEETS = GRID + """,
sheets as (select distinct source_file file_name, source_file, source_sheet from grid)"""

HEADERS = SHEETS + f""",
cells as (select source_file, source_sheet, row_number, unnest(cells) c, generate_subscripts(cells, 1) pos from grid),
headers as (select source_file, source_sheet, min(row_number) header_row from (
    select source_file, source_sheet, row_number from cells
    where row_number <= 100 and regexp_matches({name('c')}, '{TERMS}')
    group by all having count(*) >= 3) group by all)"""

INVENTORY = HEADERS + f""",
named as (select source_file, source_sheet, header_row, pos, {squish('c')} raw_column, {name(squish('c'))} base_name
  from cells join headers using (source_file, source_sheet) where row_number = header_row and {has_data('c')}),
inventory as (select source_file file_name, source_file, source_sheet, header_row, header_row - 1 rows_to_skip,
    count(*) over (partition by source_file, source_sheet) ncol, raw_column,
    case when row_number() over (partition by source_file, source_sheet, base_name order by pos) > 1
      then base_name || '_' || cast(row_number() over (partition by source_file, source_sheet, base_name order by pos) as varchar)
      else base_name end clean_column,
    cast(row_number() over (partition by source_file, source_sheet order by pos) as integer) column_position,
    cast(pos as integer) cell_position
  from named)"""

RULES = """,
rules as (select * from (values ('app_age', 'age'), ('subject_age', 'age'), ('subject_gender', 'gender'),
  ('status_at_entry', 'entry_status')) r(clean_column, canonical_name)),
columns_found as (select clean_column, raw_column, count(distinct file_name) n_files from inventory group by all),
crosswalk as (select c.*, coalesce(r.canonical_name, c.clean_column) canonical_name
  from columns_found c left join rules r using (clean_column))"""

WIDE = INVENTORY + RULES + f""",
mapped as (select i.*, coalesce(r.canonical_name, i.clean_column) canonical_name from inventory i left join rules r using (clean_column)),
cell_match as (select c.source_file, c.source_sheet, c.row_number, m.canonical_name, c.c value,
    coalesce(trim(regexp_replace(lower({squish('c.c')}), '[^a-z0-9]+', '_', 'g'), '_') = m.clean_column, false) same
  from cells c join mapped m on c.source_file = m.source_file and c.source_sheet = m.source_sheet and c.pos = m.cell_position
  where c.row_number > m.header_row),
kept_rows as (select source_file, source_sheet, row_number from cell_match group by all having count(*) filter (where same) < 2),
wide as (select source_file, source_sheet, row_number,
    max(value) filter (where canonical_name = 'age') age,
    max(value) filter (where canonical_name = 'citizenship') citizenship,
    max(value) filter (where canonical_name = 'entry_status') entry_status,
    max(value) filter (where canonical_name = 'gender') gender,
    cast(null as varchar) nationality
  from cell_match semi join kept_rows using (source_file, source_sheet, row_number) group by all)"""

EVENTS = """
ev as (select *, cast(ts as date) event_date, cast(ascii(event_type) * 100 as varchar) n0,
    cast(ascii(event_type) * 100 + 1 as varchar) n1 from events),
parts as (select n0 || '_' || event_type || '_all' part_file, event_type || '.xlsx' source_file, 'all' source_sheet, event_date, event_id from ev
  union all select n1 || '_' || event_type || '_w2', event_type || '.xlsx', 'w2', event_date, event_id from ev
  where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15' and value >= 1),
meta as (select part_file, source_file, source_sheet, count(*) n_rows, min(event_date) min_date, max(event_date) max_date from parts group by all)"""

PAIRS_OF_PARTS = """,
pairs as (select row_number() over (order by s.min_date, s.max_date, s.part_file, l.min_date, l.max_date, l.part_file) pair_id,
    s.part_file smaller_file, s.min_date smaller_min_date, s.max_date smaller_max_date,
    l.part_file larger_file, l.min_date larger_min_date, l.max_date larger_max_date
  from meta s, meta l
  where s.part_file <> l.part_file and l.min_date <= s.min_date and l.max_date >= s.max_date
    and (l.min_date < s.min_date or l.max_date > s.max_date or s.part_file < l.part_file)),
daily as (select part_file, event_date, count(*) daily_count from parts
  where part_file in (select smaller_file from pairs union select larger_file from pairs) group by all),
spine as (select *, cast(unnest(generate_series(smaller_min_date, smaller_max_date, interval 1 day)) as date) event_date from pairs),
compared as (select spine.*, coalesce(s.daily_count, 0) smaller_daily_count, coalesce(l.daily_count, 0) larger_daily_count
  from spine left join daily s on s.part_file = smaller_file and s.event_date = spine.event_date
  left join daily l on l.part_file = larger_file and l.event_date = spine.event_date)"""

PAIRS = EVENTS + PAIRS_OF_PARTS

DATED_SHEETS = """
ord as (select year(o_orderdate) y, month(o_orderdate) m, o_orderkey k, cast(o_orderdate as date) event_date from orders),
sheet_rows as (select 'year_' || cast(y as varchar) f, 'all' s, event_date from ord
  union all select 'year_' || cast(y as varchar), 'q1', event_date from ord where m <= 3 and k % 10 <> 0),
sheet_names as (select f, s, lpad(cast(row_number() over (order by f, s) as varchar), 4, '0') || '_' || f || '_' || s part_file from (select distinct f, s from sheet_rows) d),
parts as (select part_file, f || '.xlsx' source_file, s source_sheet, event_date from sheet_rows join sheet_names using (f, s)),
meta as (select part_file, source_file, source_sheet, count(*) n_rows, min(event_date) min_date, max(event_date) max_date from parts group by all)"""

WEEKLY = EVENTS + """,
weekly as (select source_file, source_sheet, cast(date_trunc('week', event_date) as date) week_start, count(*) event_count from parts group by all),
numbered as (select w.*, split_part(m.part_file, '_', 1) part_number from weekly w left join meta m using (source_file, source_sheet))"""

YEARLY = """
dates as (select cast((year(o_orderdate) - 1990) * 2500 as varchar) || '_year.parquet' part_file, cast(o_orderdate as date) d from orders
  union all select '0100_customer_' || cast(o_custkey as varchar), cast(o_orderdate as date) from orders),
meta as (select part_file, min(d) min_date, max(d) max_date, count(*) n_rows from dates group by all),
ranges as (select min_date, max_date, count(*) same from meta group by all),
flagged as (select m.*, r.same > 1 or exists (select 1 from ranges o where o.min_date <= m.min_date and o.max_date >= m.max_date
    and (o.min_date < m.min_date or o.max_date > m.max_date)) contained
  from meta m join ranges r using (min_date, max_date))"""

CONVERT = {"datetime": as_datetime, "date": as_date, "time": as_time, "logical": as_logical, "integer": as_integer, "double": as_double, "text": str}


def wide_typed(spec) -> str:
    """Every column of a wide table; the six dirty texts are converted once and stand under many names."""
    kinds = ", ".join(f"{convert('c_' + kind)} v_{kind}" for kind, convert in CONVERT.items())
    cleaned = ", ".join(f"{clean(TEXT_OF_KIND[kind])} c_{kind}, {redacted(TEXT_OF_KIND[kind])} r_{kind}" for kind in CONVERT)
    columns = [f"v_{spec.kind(c)} {c}" for c in spec.order] + [f"r_{spec.kind(c)} {c}_redacted" for c in spec.order if c in spec.redaction_flags]
    return f"""with {RAW}, cleaned as (select record_id, {cleaned} from raw), converted as (select *, {kinds} from cleaned)
select record_id, {', '.join(columns)} from converted"""


BENCHMARK = """
bm_counts as (select year(o_orderdate) + case when month(o_orderdate) >= 10 then 1 else 0 end fy, month(o_orderdate) m,
    case when o_orderpriority = '5-LOW' then 'OTHER' else 'MAIN' end component, count(*) n from orders group by all),
bm_large as (select * from bm_counts qualify n >= 0.9::double * avg(n) over (partition by component)),
bm_named as (select *, ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][m] month_abbreviation from bm_large),
releases as (
  select 'r1' benchmark_id, date '2000-01-01' release_date, 'FY' || cast(fy as varchar) fiscal_year_text, month_abbreviation, component,
    cast(case when m <> 5 then n end as bigint) encounter_count from bm_named where fy % 3 <> 0
  union all select 'r2', date '2001-01-01', 'FY' || cast(fy as varchar), month_abbreviation, component,
    cast(case when m % 4 = 0 then n + 1 else n end as bigint) from bm_named where fy % 3 <> 1
  union all select 'r2', date '2001-01-01', 'FY' || cast(max(year(o_orderdate)) + 2 as varchar), 'Jan', 'MAIN', 5 from orders),
bm as (select benchmark_id, release_date, cast(regexp_extract(fiscal_year_text, '[0-9]+') as integer) fiscal_year,
    cast(list_position(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'], month_abbreviation) as integer) fiscal_month,
    month_abbreviation, encounter_count from releases where component = 'MAIN'),
bm_dated as (select *, fiscal_year - case when fiscal_month >= 10 then 1 else 0 end calendar_year,
    make_date(fiscal_year - case when fiscal_month >= 10 then 1 else 0 end, fiscal_month, 1) month_start from bm),
latest as (select benchmark_id, release_date, fiscal_year, fiscal_month, month_start, cast(coalesce(sum(encounter_count), 0) as bigint) benchmark_count
  from bm_dated group by benchmark_id, release_date, fiscal_year, fiscal_month, month_start
  qualify row_number() over (partition by month_start order by release_date desc, benchmark_id desc) = 1),
monthly as (select cast(date_trunc('month', o_orderdate) as date) month_start, count(*) final_count from orders
  where o_orderpriority <> '5-LOW'
    and cast(o_orderdate as date) between (select min(month_start) from latest) and (select last_day(max(month_start)) from latest)
  group by all),
xref as (select cast(coalesce(fiscal_year, year(month_start) + case when month(month_start) >= 10 then 1 else 0 end) as integer) fiscal_year,
    cast(coalesce(fiscal_month, month(month_start)) as integer) fiscal_month, month_start, final_count, benchmark_count,
    final_count - benchmark_count difference, abs(final_count - benchmark_count) absolute_difference,
    case when benchmark_count <> 0 then 100.0::double * (final_count - benchmark_count) / benchmark_count end percent_difference,
    final_count = benchmark_count exact_match,
    case when final_count is null then 'missing from final' when benchmark_count is null then 'missing from benchmark'
      when final_count = benchmark_count then 'exact match' else 'difference' end status
  from latest l full join monthly using (month_start))"""

ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)[^>]*>(.*?)</a\s*>"""


def _unescape(c: str) -> str:
    for ref, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        c = f"replace({c}, '{ref}', '{char}')"
    return c


LINKS = f"""
anchors as (select page_id, url, unnest(regexp_extract_all(html, '{ANCHOR}', 1)) h, unnest(regexp_extract_all(html, '{ANCHOR}', 2)) t,
    generate_subscripts(regexp_extract_all(html, '{ANCHOR}', 1), 1) - 1 p from pages),
cleaned as (select page_id, url, cast(p as integer) "position", {squish(_unescape("regexp_replace(t, '<[^>]*>', '', 'g')"))} "text",
    {_unescape("trim(trim(h), '\"''')")} href from anchors),
links as (select page_id, url, "position", "text", href, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href full_url from cleaned),
classified as (select page_id, "position", "text", href, full_url, lower("text") text_lower, true is_text,
    regexp_matches(lower("text"), 'ing|tion|ment') is_too_specific,
    case when regexp_matches(lower("text"), 'ing|tion|ment') then 'manual_review' else 'include_text' end download_class,
    url from links where regexp_matches(full_url, '\\.com/|\\.net/') and regexp_matches(lower("text"), 'the|de|in')),
current_links as (select * exclude (url) from classified
  qualify row_number() over (partition by full_url order by page_id, "position") = 1),
known_links as (select * exclude (url) from classified where url like '%/en/%'
  qualify row_number() over (partition by full_url order by page_id, "position") = 1)"""

OUT = 'page_id, "position", "text", href, full_url'


def q(ctes: str, select: str) -> str:
    return f"with {ctes.strip()}\n{select}"


def equal_rows(a: str, b: str) -> str:
    return " and ".join(f"{a}.{c} is not distinct from {b}.{c}" for c in COMPARED)


def only_in(a: str, b: str) -> str:
    return f"select {', '.join(COMPARED)} from {a} where not exists (select 1 from {b} where {equal_rows(a, b)})"


def populated(rel: str) -> str:
    return " union all ".join(f'select \'{c}\' "column" from {rel} having bool_or({has_data(c)})' for c in PAIR_ALL if c not in ("source_file", "source_sheet"))


def values_of(rel: str) -> str:
    return " union all ".join(f'select \'{c}\' "column", {c} "value" from {rel} where {c} is not null' for c in COMPARED)


def conversion(columns: list[str], convert) -> str:
    cleaned = ", ".join(f"{clean(c)} {c}" for c in columns)
    return q(RAW, f"select record_id, {', '.join(f'{convert(c)} {c}' for c in columns)} from (select record_id, {cleaned} from raw) v")


def audit(columns: dict[str, str]) -> str:
    """``columns``: column name to the test that its cleaned value ``v`` is not recognised."""
    one = lambda c, bad: (
        f"select '{c}' \"column\", v raw_value, count(*) n from (select {clean(c)} v from raw) x "
        f"where v is not null and upper(v) not in {MISSING} and {bad} group by v"
    )
    return q(RAW, " union all ".join(one(c, bad) for c, bad in columns.items()))


BAD = {
    "datetime": "try_cast(v as timestamp) is null and try_cast(v as double) is null",
    "date": "try_cast(v as date) is null and try_cast(v as double) is null",
    "time": "try_cast(v as time) is null and try_cast(v as double) is null",
    "logical": f"upper(v) not in {TRUE} and upper(v) not in {FALSE}",
    "integer": "try_cast(v as integer) is null",
    "double": "try_cast(v as double) is null",
}

TYPED = f"""{RAW},
cleaned_text as (select record_id, source_file, source_sheet, {', '.join(f'{clean(c)} {c}' for c in ('date_text', 'stamp_text', 'time_text', 'flag_text', 'int_text', 'ratio_text'))},
    {redacted('date_text')} date_text_redacted, {redacted('flag_text')} flag_text_redacted from raw),
typed as (select {as_date('date_text')} date_text, date_text_redacted, {as_datetime('stamp_text')} stamp_text, {as_time('time_text')} time_text,
    {as_logical('flag_text')} flag_text, flag_text_redacted, {as_integer('int_text')} int_text, {as_double('ratio_text')} ratio_text,
    record_id, source_file, source_sheet from cleaned_text)"""

PROFILE = [
    ("date_text", "date"), ("date_text_redacted", "boolean"), ("stamp_text", "timestamp_ntz"), ("time_text", "string"),
    ("flag_text", "boolean"), ("flag_text_redacted", "boolean"), ("int_text", "int"), ("ratio_text", "double"),
    ("record_id", "string"), ("source_file", "string"), ("source_sheet", "string"),
]

PART_COLUMNS = ["record_id", "date_text", "stamp_text", "flag_text", "int_text", "ratio_text", "time_text"]


def non_empty(columns: list[str], rel: str) -> str:
    flags = ", ".join(f"case when bool_or({has_data(c)}) then '{c}' end" for c in columns)
    return f"select part_file, list_sort(list_filter([{flags}], lambda x: x is not null)) l from {rel} group by part_file"


PREFERRED = (
    f"select part_file, case when bool_or({has_data('flag_date')}) then 'flag_date' when bool_or({has_data('stamp_text')}) "
    f"then 'stamp_text' when bool_or({has_data('date_text')}) then 'date_text' end date_column from dated group by part_file"
)

CHARGES = """
items as (select o_orderkey order_key, o_orderpriority, l_linenumber line, case when l_returnflag <> 'N' then l_returnflag end charge
  from orders join lineitem on o_orderkey = l_orderkey)"""

ORACLE: dict[str, str] = {
    # sources, scans, sinks
    "link_extract": q(LINKS, f"select {OUT} from links"),
    "link_classify": q(LINKS, "select * from current_links"),
    "link_new": q(LINKS, 'select full_url, "text", download_class from current_links c where not exists (select 1 from known_links k where k.full_url = c.full_url)'),
    "link_manual_review_count": q(LINKS, "select count(*) new_links, count(*) filter (where download_class = 'manual_review') manual_review_links from current_links c where not exists (select 1 from known_links k where k.full_url = c.full_url)"),
    "link_inventory_update": q(LINKS, "select * from known_links union all select * from current_links c where not exists (select 1 from known_links k where k.full_url = c.full_url)"),
    "link_filter_simple": q(LINKS, f"""select {OUT} from links where regexp_matches(full_url, '\\.com/|\\.net/') and contains(lower("text"), 'the')
        qualify row_number() over (partition by full_url order by page_id, "position") = 1"""),
    "grid_sheet_inventory": q(SHEETS, "select * from sheets"),
    "scan_parts_union_by_name": q(PARTS, "select * from parts"),
    "scan_projected": "select event_type, cast(date_trunc('week', ts) as date) week_start, count(*) event_count from events group by all",
    "csv_scan_typed": q(BENCHMARK, "select fiscal_year_text, month_abbreviation, component, 'Title \"' || month_abbreviation || '\",' || chr(10) || 'as amended' title_of_authority, case when component = 'MAIN' then '' end encounter_type, cast(encounter_count as integer) encounter_count, benchmark_id, release_date from releases"),
    "sink_parquet": q(TYPED, "select * from typed"),
    "sink_csv": q(EVENTS, "select source_file, source_sheet, cast(date_trunc('week', event_date) as date) week_start, count(*) n from parts group by all"),
    "table_profile": q(TYPED, " union all ".join(
        f"select {i} \"position\", '{c}' \"column\", '{t}' \"type\", count(*) n_rows, count({c}) n_values from typed" for i, (c, t) in enumerate(PROFILE, 1))),
    "published_profile": q(TYPED, " union all ".join(
        f"select cast({i} as integer) \"position\", '{c}' \"column\", '{t}' \"type\", count(*) n_rows, count({c}) n_values from typed" for i, (c, t) in enumerate(PROFILE, 1))),
    "table_preview": q(TYPED, f"select * from typed order by {', '.join(f'{c} nulls first' for c, _ in PROFILE)} limit 50"),
    # profiling grids
    "clean_names": f"select doc_id, {name('text')} clean_name from documents",
    "header_detect": q(HEADERS, "select source_file, source_sheet, header_row from sheets left join headers using (source_file, source_sheet)"),
    "drop_empty_columns": q(HEADERS, f"select distinct source_file, source_sheet, cast(pos as integer) \"position\" from cells where {has_data('c')}"),
    "column_inventory": q(INVENTORY, "select * from inventory"),
    "failed_sheets": q(HEADERS, "select source_file, source_sheet, file_name, 'No likely header row found.' error_message from sheets anti join headers using (source_file, source_sheet)"),
    "profile_incremental": q(INVENTORY, "select *, case when source_file < 'file_3' then 'old' else 'new' end generation from inventory"),
    "distinct_columns": q(INVENTORY, "select clean_column, raw_column, count(distinct file_name) n_files, array_to_string(list_sort(list(distinct file_name))[1:5], ' | ') example_files from inventory group by all"),
    # crosswalk and standardisation
    "crosswalk_apply": q(INVENTORY + RULES, "select * from crosswalk"),
    "crosswalk_lost": q(INVENTORY + RULES, "select * from columns_found c where not exists (select 1 from inventory i where i.column_position <= 2 and i.clean_column = c.clean_column and i.raw_column = c.raw_column)"),
    "crosswalk_collapsed": q(INVENTORY + RULES, "select canonical_name, count(distinct clean_column) n_source_columns, array_to_string(list_sort(list(distinct clean_column)), ' | ') source_columns from crosswalk group by all having count(distinct clean_column) > 1"),
    "crosswalk_conflicts": q(INVENTORY, "select source_file, source_sheet, 'person' canonical_name, array_to_string(list_sort(list(distinct clean_column)), ' | ') source_columns, count(distinct clean_column) n_columns from inventory where clean_column in ('app_age', 'gender') group by all having count(distinct clean_column) > 1"),
    "repeat_header_drop": q(WIDE, "select source_file, source_sheet, row_number, (select string_agg(coalesce(x.c, ''), '|' order by x.pos) from cells x where x.source_file = k.source_file and x.source_sheet = k.source_sheet and x.row_number = k.row_number) cells_text from kept_rows k"),
    "standardize_part": q(WIDE, "select source_file, source_sheet, age, citizenship, entry_status, gender, nationality from wide"),
    "part_naming": q(SHEETS, f"select *, row_number() over (order by source_file, source_sheet) ordinal, lpad(cast(row_number() over (order by source_file, source_sheet) as varchar), 4, '0') || '_' || {name("replace(source_file, '.xlsx', '')")} || '_' || {name('source_sheet')} part_file from sheets"),
    "parts_incremental": q(SHEETS, f"select source_file, source_sheet, ordinal, lpad(cast(ordinal as varchar), 4, '0') || '_' || {name("replace(source_file, '.xlsx', '')")} || '_' || {name('source_sheet')} part_file from (select *, row_number() over (order by source_file >= 'file_3', source_file, source_sheet) ordinal from sheets) s"),
    "parts_built": q(WIDE, f"""select source_file, source_sheet, ordinal, lpad(cast(ordinal as varchar), 4, '0') || '_' || {name("replace(source_file, '.xlsx', '')")} || '_' || {name('source_sheet')} part_file, n_rows, columns
        from (select *, row_number() over (order by source_file >= 'file_3', source_file, source_sheet) ordinal from headers) h
        join (select source_file, source_sheet, count(*) n_rows from kept_rows group by all) using (source_file, source_sheet)
        join (select source_file, source_sheet, array_to_string(list_sort(list(distinct canonical_name)), '|') columns from mapped group by all) using (source_file, source_sheet)"""),
    "parts_check": q(HEADERS, "select (select count(*) from sheets) expected_parts, (select count(*) from headers) written_parts, (select count(*) from sheets) = (select count(*) from headers) complete"),
    # part metadata
    "parse_date_ladder": q(RAW, f"select record_id, {ladder('date_text')} event_date, {ladder('stamp_text')} stamp_date, {ladder("(chr(160) || date_text || chr(8195) || '(see 3/4)')")} noted_date, {ladder("(chr(160) || date_text || chr(8195))")} spaced_date from raw"),
    "non_empty_columns": q(PARTS, f"select part_file, cast(len(l) as integer) n_non_empty_cols, array_to_string(l, ' | ') non_empty_cols from ({non_empty(PART_COLUMNS, 'parts')}) x"),
    "preferred_date_column": q(DATED_PARTS, PREFERRED),
    "part_summary": q(DATED_PARTS, f"""select p.part_file, p.source_file, p.source_sheet, p.n_rows, d.date_column,
        case d.date_column when 'flag_date' then p.flag_min when 'stamp_text' then p.stamp_min when 'date_text' then p.date_min end min_date,
        case d.date_column when 'flag_date' then p.flag_max when 'stamp_text' then p.stamp_max when 'date_text' then p.date_max end max_date,
        cast(len(n.l) as integer) n_non_empty_cols, array_to_string(n.l, ' | ') non_empty_cols
      from (select part_file, source_file, source_sheet, count(*) n_rows,
          min({ladder('flag_date')}) flag_min, max({ladder('flag_date')}) flag_max, min({ladder('stamp_text')}) stamp_min,
          max({ladder('stamp_text')}) stamp_max, min({ladder('date_text')}) date_min, max({ladder('date_text')}) date_max
        from dated group by part_file, source_file, source_sheet) p
      join ({PREFERRED}) d using (part_file) join ({non_empty(PART_COLUMNS + ['flag_date'], 'dated')}) n using (part_file)"""),
    "part_single_source": q(PARTS, "select coalesce(flag_text, part_file) part_file, count(distinct source_file || '/' || source_sheet) n_sources, count(*) n_rows from parts group by 1 having count(distinct source_file || '/' || source_sheet) > 1"),
    "same_date_ranges": q(EVENTS, "select min_date, max_date, count(*) n_parts, string_agg(part_file || ' [rows: ' || cast(n_rows as varchar) || ']', ' | ' order by part_file) files_and_rows from meta group by all having count(*) > 1"),
    "equal_parts": q(PARTS + """,
        released as (select part_file p, * from parts union all select part_file || '_again', * from parts where cast(substr(source_file, 6, 4) as integer) % 2 = 0),
        folded as (select p, count(*) n_rows, list_sort(list(cast(struct_pack(record_id, source_file, source_sheet, date_text, stamp_text, flag_text, int_text, ratio_text, time_text) as varchar))) all_rows from released group by p)""",
        "select p part_file, (select min(o.p) from folded o where o.n_rows = f.n_rows and o.all_rows = f.all_rows) equal_to, n_rows from folded f where exists (select 1 from folded o where o.p < f.p and o.n_rows = f.n_rows and o.all_rows = f.all_rows)"),
    "same_date_range_members": q(EVENTS, "select min_date, max_date, part_file, n_rows, count(*) over (partition by min_date, max_date) n_parts from meta qualify count(*) over (partition by min_date, max_date) > 1"),
    # pair comparison
    "pair_shared_columns": q(PAIR, f'({populated("rel_a")}) intersect ({populated("rel_b")})'),
    "rows_only_in_a": q(PAIR, only_in("rel_a", "rel_b")),
    "rows_only_in_b": q(PAIR, only_in("rel_b", "rel_a")),
    "pair_match_summary": q(PAIR, f"""select *, rows_a - only_in_a matching_a, only_in_a = 0 and only_in_b = 0 all_match from (select
        (select count(*) from rel_a) rows_a, (select count(*) from rel_b) rows_b,
        (select count(*) from ({only_in("rel_a", "rel_b")}) a) only_in_a, (select count(*) from ({only_in("rel_b", "rel_a")}) b) only_in_b) t"""),
    "pair_columns_only": q(PAIR, f"""select "column", 'a' side from (({populated("rel_a")}) except ({populated("rel_b")})) x
        union all select "column", 'b' from (({populated("rel_b")}) except ({populated("rel_a")})) y"""),
    "pair_value_diff": q(PAIR + f""",
        ua as ({only_in("rel_a", "rel_b")}), ub as ({only_in("rel_b", "rel_a")}),
        va as (select distinct * from ({values_of("ua")}) x), vb as (select distinct * from ({values_of("ub")}) y)""",
        f"""select "column", count(*) filter (where side = 'a') values_only_in_a, count(*) filter (where side = 'b') values_only_in_b,
        count(side) = 0 identical_unique_values from (select unnest([{', '.join(f"'{c}'" for c in COMPARED)}]) "column") c
        left join (select 'a' side, * from (select * from va except select * from vb) x union all select 'b', * from (select * from vb except select * from va) y) d
        using ("column") group by 1"""),
    "pair_multiset_equal": q(PAIR + f""",
        ca as (select {', '.join(COMPARED)}, count(*) n from rel_a group by all), cb as (select {', '.join(COMPARED)}, count(*) n from rel_b group by all)""",
        f"select count(*) differing_rows, count(*) = 0 identical from ca full join cb on {equal_rows('ca', 'cb')} where ca.n is distinct from cb.n"),
    # stacking
    "parts_exclude": q(PARTS, "select * from parts where part_file not in ('0004_part_1995.xlsx', '0099_part_2090.xlsx')"),
    "parts_exclude_absent": q(PARTS, "select part_file from (values ('0004_part_1995.xlsx'), ('0099_part_2090.xlsx')) v(part_file) where part_file not in (select part_file from parts)"),
    "stack_audit": q(PARTS, "select part_file, count(*) n_rows from parts group by all"),
    "stack_reconcile": q(PARTS, "select count(*) expected_rows, count(*) filter (where part_file <> '0004_part_1995.xlsx') actual_rows, count(*) = count(*) filter (where part_file <> '0004_part_1995.xlsx') ok from parts"),
    # cleaning and typing
    "column_order": q(RAW, "select date_text, stamp_text, time_text, flag_text, int_text, ratio_text, record_id, source_file, source_sheet from raw"),
    "clean_text": q(RAW, f"select record_id, {', '.join(f'{clean(c)} {c}' for c in ('date_text', 'stamp_text', 'time_text', 'flag_text', 'int_text', 'ratio_text'))} from raw"),
    "to_datetime": conversion(["stamp_text", "date_text"], as_datetime),
    "to_date": conversion(["date_text", "stamp_text"], as_date),
    "to_date_us": conversion(["date_text", "stamp_text"], as_us_date),
    "to_time": conversion(["time_text", "stamp_text", "date_text"], as_time),
    "to_logical": conversion(["flag_text"], as_logical),
    "to_integer": conversion(["int_text", "ratio_text"], as_integer),
    "to_double": conversion(["ratio_text", "int_text"], as_double),
    "redaction_flag": q(RAW, f"select record_id, {', '.join(f'{redacted(c)} {c}_redacted' for c in ('date_text', 'stamp_text', 'flag_text', 'time_text'))} from raw"),
    "typed_table": q(TYPED, "select * from typed"),
    "typed_table_wide": wide_typed(APPREHENSIONS.table),
    "drop_empty_columns_table": q(PAIR, "select * exclude (note_b) from rel_a"),
    "audit_datetime": audit({"stamp_text": BAD["datetime"]}),
    "audit_date": audit({"date_text": BAD["date"]}),
    "audit_time": audit({"time_text": BAD["time"]}),
    "audit_logical": audit({"flag_text": BAD["logical"]}),
    "audit_numeric": audit({"int_text": BAD["integer"], "ratio_text": BAD["double"]}),
    "audit_all": audit({"stamp_text": BAD["datetime"], "date_text": BAD["date"], "time_text": BAD["time"], "flag_text": BAD["logical"], "int_text": BAD["integer"], "ratio_text": BAD["double"]}),
    # overlap validation
    "contained_pairs": q(PAIRS, "select * from pairs"),
    "event_date_coalesced": q(RAW, f"select record_id, coalesce({ladder('date_text')}, {ladder('stamp_text')}) event_date from raw"),
    "daily_counts": q(PAIRS, "select * from daily"),
    "date_spine": q(PAIRS, "select * from spine"),
    "daily_intervals": q(PAIRS, """select pair_id, min(event_date) from_date, max(event_date) to_date, smaller_daily_count, larger_daily_count
        from (select *, event_date - cast(row_number() over (partition by pair_id, smaller_daily_count, larger_daily_count order by event_date) as integer) run from compared) d
        group by pair_id, run, smaller_daily_count, larger_daily_count"""),
    "containing_pairs_cut": """with meta as (select cast(o_custkey % 600 as varchar) f, min(cast(o_orderdate as date)) lo, max(cast(o_orderdate as date)) hi from orders group by 1)
        select s.f smaller_file, l.f larger_file from meta s join meta l on l.lo <= s.lo and l.hi >= s.hi and s.f <> l.f where l.lo < s.lo or l.hi > s.hi or s.f < l.f""",
    "daily_comparison": q(PAIRS, "select *, smaller_daily_count - larger_daily_count count_difference, smaller_daily_count = larger_daily_count daily_counts_match from compared"),
    "pair_summary": q(PAIRS, """select pair_id, smaller_file, smaller_min_date, smaller_max_date, larger_file, larger_min_date, larger_max_date,
        count(*) days_compared, count(*) filter (where smaller_daily_count = larger_daily_count) matching_days,
        count(*) filter (where smaller_daily_count <> larger_daily_count) differing_days,
        round(avg(case when smaller_daily_count = larger_daily_count then 1 else 0 end) * 100, 6) percent_days_matching,
        cast(sum(smaller_daily_count) as bigint) smaller_records_in_range, cast(sum(larger_daily_count) as bigint) larger_records_in_range,
        cast(sum(smaller_daily_count) - sum(larger_daily_count) as bigint) total_count_difference,
        max(abs(smaller_daily_count - larger_daily_count)) maximum_absolute_daily_difference,
        bool_and(smaller_daily_count = larger_daily_count) all_daily_counts_match from compared group by all"""),
    # benchmark cross reference
    "benchmark_union": q(BENCHMARK, "select * from bm"),
    "fiscal_to_calendar": q(BENCHMARK, "select * from bm_dated"),
    "benchmark_invalid_months": q(BENCHMARK, "select benchmark_id, release_date, fiscal_year, cast(null as integer) fiscal_month, month_abbreviation || 'x' month_abbreviation, encounter_count from bm where month_abbreviation in ('Jan', 'Feb', 'Mar')"),
    "benchmark_latest": q(BENCHMARK, "select * from latest"),
    "monthly_in_range": q(BENCHMARK, "select * from monthly"),
    "cross_reference": q(BENCHMARK, "select * replace (round(percent_difference, 6) as percent_difference) from xref"),
    "cross_reference_summary": q(BENCHMARK, "select count(*) months_compared, count(*) filter (where exact_match) exact_matches, count(*) filter (where status = 'difference') differing_months, count(*) filter (where status in ('missing from final', 'missing from benchmark')) missing_months, max(absolute_difference) largest_absolute_difference from xref"),
    # reporting
    "monthly_counts_by_source": "select o_orderpriority source_file, cast(date_trunc('month', o_orderdate) as date) month_start, count(*) order_count from orders where cast(o_orderdate as date) >= date '1997-01-01' group by all",
    "weekly_counts_by_source": q(WEEKLY, "select * from weekly"),
    "weekly_with_part": q(WEEKLY, "select * from numbered"),
    "weekly_with_part_by_file": q(WEEKLY, "select w.*, p.part_number from weekly w left join (select distinct source_file, split_part(part_file, '_', 1) part_number from meta) p using (source_file)"),
    "latest_week_per_part": q(WEEKLY, "select * from numbered where week_start >= date '2024-01-01' qualify row_number() over (partition by part_number order by week_start desc, source_file, source_sheet) = 1"),
    "coverage_contained_flag": q(YEARLY, "select part_file, min_date, max_date, contained from flagged"),
    "coverage_timeline": q(YEARLY, "select regexp_replace(regexp_replace(part_file, '\\.parquet$', ''), '^[0-9]+_', '') part_label, min_date, max_date, n_rows, contained from flagged"),
    # older operators
    "collapse_multivalue": q(CHARGES, "select row_number() over (order by order_key, o_orderpriority) identifier, order_key, o_orderpriority, cast(count(*) as integer) n_charges, string_agg(coalesce(charge, '-'), ',' order by line, charge nulls first) charge_list from items group by order_key, o_orderpriority"),
    "collapse_multivalue_split": q(CHARGES, "select order_key, o_orderpriority, cast(line // 3 as bigint) list_part, string_agg(coalesce(charge, '-'), ',' order by line, charge nulls first) charge_list from items group by order_key, o_orderpriority, line // 3"),
    "list_to_text": q(CHARGES, "select order_key, string_agg(coalesce(charge, 'NA'), ', ' order by line, charge nulls first) charge from items group by order_key, o_orderpriority"),
    "tagged_union_cutoff": """select 'part1.xlsx' file, o_orderkey, cast(o_orderdate as date) o_orderdate, o_orderstatus, cast(null as double) o_totalprice from orders where o_orderdate < timestamp '1998-01-01'
        union all select 'part2.xlsx', o_orderkey, cast(o_orderdate as date), null, o_totalprice from orders""",
    # whole paths
    "release_monthly_counts": q(TYPED, "select source_file, cast(date_trunc('month', coalesce(cast(stamp_text as date), date_text)) as date) month_start, count(*) record_count from typed where coalesce(cast(stamp_text as date), date_text) >= date '1997-01-01' group by all"),
    "release_overlaps": q(DATED_SHEETS + PAIRS_OF_PARTS, """select smaller_file, larger_file, count(*) days_compared,
        count(*) filter (where smaller_daily_count = larger_daily_count) matching_days,
        cast(sum(smaller_daily_count) as bigint) smaller_records_in_range, cast(sum(larger_daily_count) as bigint) larger_records_in_range from compared group by all"""),
    "release_grid_to_typed": q(WIDE, f"select source_file, {clean('gender')} gender, {clean('citizenship')} citizenship, count(*) n_rows, cast(sum(try_cast({clean('age')} as integer)) as bigint) total_age, count(nationality) n_nationality from wide group by all"),
}
