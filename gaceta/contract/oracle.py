"""SQL twins of the registered queries, in DuckDB's dialect."""

from __future__ import annotations

import re

from gaceta.contract.articles import ARTICLES_SQL
from gaceta.contract.mojibake import TIDY, repaired_sql, spoiled_sql
from gaceta.params import GAZETTEER, REGION_ATTRIBUTES, STOP_WORDS, UNKNOWN_REGION, WEEKDAYS


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return ", ".join(_quote(i) for i in items)


def with_sql(parts: list[str], body: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + body


CLEAN = """
usable as (select * from articles where article_id is not null and publish_date is not null),
firsts as (
  select * exclude (rn) from (
    select *, row_number() over (partition by article_id order by _seq) as rn from usable)
  where rn = 1),
clean as (
  select *, cast(year(pub_date) as integer) as year, cast(month(pub_date) as integer) as month
  from (select *, cast(try_strptime(trim(publish_date), '%Y-%m-%d') as date) as pub_date from firsts)
  where pub_date is not null)"""

DATE_KEYS = """
date_keys as (
  select fecha, cast(row_number() over (order by first_seq) as integer) as date_id
  from (select publish_date as fecha, min(_seq) as first_seq from articles
        where publish_date is not null group by 1)),
dim_date as (
  select date_id, fecha,
    cast(year(d) as integer) as anio, cast(month(d) as integer) as mes,
    cast(day(d) as integer) as dia,
    list_extract([%s], cast(isodow(d) as integer)) as dia_semana,
    cast(week(d) as integer) as semana_anio
  from (select *, cast(try_strptime(trim(fecha), '%%Y-%%m-%%d') as date) as d from date_keys)
  where d is not null)""" % _list(WEEKDAYS)

SOURCE_KEYS = """
dim_source as (
  select source, cast(row_number() over (order by first_seq) as integer) as source_id
  from (select lower(source) as source, min(_seq) as first_seq from articles
        where source is not null group by 1))"""

_region_rows = ", ".join(
    f"({i}, {_quote(n)}, {_quote(REGION_ATTRIBUTES[n][0])}, {_quote(REGION_ATTRIBUTES[n][1])})"
    for i, n in enumerate([*GAZETTEER, UNKNOWN_REGION], start=1))
DIM_REGION = f"""
dim_region as (
  select * from (values {_region_rows}) as r(region_id, region_name, n_romano, abreviacion))"""

FOLD = r"regexp_replace(strip_accents(lower({0})), '[^\x00-\x7F]', '', 'g')"


def _hits(column: str, aliases: tuple[str, ...]) -> str:
    pattern = "|".join(rf"\b{a}\b" for a in aliases)
    return f"len(regexp_extract_all({column}, {_quote(pattern)}))"


def region_sql(gazetteer: dict[str, tuple[str, ...]], ids: list[int], name: str = "placed") -> str:
    """The articles of ``clean`` with region_id; ``ids`` of the regions in order, the default's last."""
    scores = ", ".join(f"3 * {_hits('ft', a)} + {_hits('fb', a)}" for a in gazetteer.values())
    return f"""
{name} as (
  select * exclude (ft, fb, scores, best), ([{', '.join(map(str, ids))}])[cast(case
      when best > 0 and len(list_filter(scores, lambda s: s = best)) = 1
      then list_position(scores, best) else {len(gazetteer) + 1} end as integer)] as region_id
  from (select *, list_max(scores) as best from (
    select *, [{scores}] as scores from (
      select *, {FOLD.format('title')} as ft, {FOLD.format('substring(body, 1, 800)')} as fb
      from clean))))"""


REGION = region_sql(GAZETTEER, [*range(1, len(GAZETTEER) + 2)])

FACT = """
fact as (
  select p.*, coalesce(k.date_id, -1) as date_id, coalesce(s.source_id, -1) as source_id
  from placed p
  left join dim_date k on k.fecha = p.publish_date
  left join dim_source s on s.source = lower(p.source))"""

_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _words(column: str) -> str:
    return f"cast(len(regexp_extract_all({column}, '[^{_WS}]+')) as integer)"


_TOKEN = "(?i)[a-záéíóúüñ]{3,}"
_single = [w for w in STOP_WORDS if re.fullmatch(_TOKEN, w)]


def tokens_of(*columns: str) -> str:
    return " || ".join(f"regexp_extract_all({c}, '{_TOKEN}')" for c in columns)


TERMS = f"""
terms as (
  select * from (
    select year, month, region_id, source_id, lower(unnest({tokens_of('title', 'body')})) as word
    from fact)
  where word not in ({_list(_single)}))"""

COUNTS = """
by_month as (select year, month, word, count(*) as n from terms group by all),
by_region as (select region_id, word, count(*) as n from terms group by all),
by_source as (select source_id, word, count(*) as n from terms group by all),
overall as (select word, count(*) as n from terms group by all),
by_day as (select d.fecha, count(*) as n from fact f join dim_date d using (date_id) group by 1)"""

ETL = [ARTICLES_SQL, CLEAN, DATE_KEYS, SOURCE_KEYS, DIM_REGION, REGION, FACT]
ANALYSIS = [*ETL, TERMS, COUNTS]

SERIES = """
series as (
  select fecha, n, case when c = {window} then a end as moving_avg,
    cast(coalesce(case when c = {window} then n >= {factor} * a end, false) as integer) as es_peak
  from (
    select fecha, n, count(*) over w as c, avg(n) over w as a from by_day
    window w as (order by fecha rows between {window} preceding and 1 preceding)))"""


def day_sql(table: str, column: str) -> str:
    return (f"by_day as (select strftime({column}, '%Y-%m-%d') as fecha, count(*) as n "
            f"from {table} where {column} is not null group by 1)")


_SERIES_OUT = "select fecha, n, round(moving_avg, 6) as moving_avg, es_peak from series"
_PEAKS_OUT = """select fecha, n, round(moving_avg, 6) as moving_avg,
  round(n / moving_avg, 6) as factor from series where es_peak = 1"""

_FACT_OUT = f"""select article_id, date_id, source_id, region_id, md5(title) as title_md5,
  md5(body) as body_md5, {_words('title')} as title_word_count,
  {_words('body')} as body_word_count, year, month from fact"""

_METRICS_OUT = """select
  (select count(*) from articles) as raw_rows,
  (select count(*) from articles) - (select count(*) from usable) as skipped_null,
  (select count(*) from usable) - (select count(*) from firsts) as skipped_dup,
  (select count(*) from firsts) - (select count(*) from clean) as bad_date,
  (select count(*) from clean) as written"""

_TOP_OUT = """select year, month, rank, word as term, n from (
  select *, cast(row_number() over (partition by year, month order by n desc, word) as integer)
    as rank from by_month) where rank <= 20"""

_REGION_WORDS_OUT = """select region_id, region_name, rank, word, regional_n, global_n,
  round(regional_n / global_n, 6) as ratio from (
  select r.region_id, d.region_name, r.word, r.n as regional_n, o.n as global_n,
    cast(row_number() over (partition by r.region_id order by r.n desc, r.word) as integer) as rank
  from by_region r join overall o using (word) join dim_region d using (region_id)
  where o.n >= 10) where rank <= 20"""

_KL_OUT = """select source_id, source, round(kl, 6) as kl from (
  select b.source_id, coalesce(d.source, 'id=' || b.source_id) as source,
    sum(case when o.n >= 10
        then (b.n / t.total) * ln((b.n / t.total) / (o.n / (select sum(n) from overall)))
        else 0 end) as kl
  from by_source b join overall o using (word)
  join (select source_id, sum(n) as total from by_source group by 1) t using (source_id)
  left join dim_source d using (source_id) group by 1, 2)"""

_REPORT_TOP = f"""select year || '-' || lpad(month::varchar, 2, '0') || ', ' || term || ', ' || n as value
  from ({_TOP_OUT})"""

_REPORT_REGION = f"""
  select '  ' || word || ': regional=' || regional_n || ', global=' || global_n || ', ratio='
    || printf('%.4f', regional_n / global_n) as value from ({_REGION_WORDS_OUT})
  union all select 'Región: ' || region_name from (select distinct region_name from ({_REGION_WORDS_OUT}))
  union all select '' from (select distinct region_name from ({_REGION_WORDS_OUT}))"""

_REPORT_KL = f"""select source as fuente, printf('%.6f', kl) as kl_divergencia from ({_KL_OUT})"""

_REPORT_PEAKS = """select fecha, n as articulos, printf('%.1f', moving_avg) as promedio_movil_7d,
  printf('%.2f', n / moving_avg) || 'x' as factor from series where es_peak = 1"""

_REPORT_SERIES = """select fecha, n as articulos,
  coalesce(printf('%.1f', moving_avg), '') as promedio_movil_7d, es_peak from series"""

_CHECK = """select {name} as "check", {v} = 0 as passed, cast({v} as bigint) as violations"""


def _orphans(key: str, dim: str, where: str = "") -> str:
    return (f"(select count(*) from fact where {key} not in "
            f"(select {key} from {dim} {where}))")


_REFERENTIAL_OUT = _CHECK.format(name="'1-referential'", v="violations") + f""" from (select
  {_orphans('date_id', 'dim_date', "where fecha <> '2023-01-02'")}
  + {_orphans('source_id', 'dim_source')} + {_orphans('region_id', 'dim_region')} as violations)"""

_ROW_COUNT_OUT = " union all ".join(
    _CHECK.format(name="'2-row-count'", v="violations") + f""", variant from (
      select greatest((select count(*) from fact) - {raw}, 0) as violations, '{variant}' as variant)"""
    for variant, raw in (("raw", "(select count(*) from articles)"),
                         ("short", "((select count(*) from fact) - 3)")))

_PK_OUT = " union all ".join(
    _CHECK.format(name=f"'3-primary-key/{dim}'", v="violations") +
    f" from (select count(*) - count(distinct {key}) as violations from {rows})"
    for dim, key, rows in (
        ("dim_date", "date_id",
         "(select date_id from dim_date union all select date_id from dim_date where mes = 2)"),
        ("dim_source", "source_id", "dim_source"),
        ("dim_region", "region_id", "(select region_id from dim_region union all select region_id from dim_region where region_id > 15)")))

_PARTITIONS_OUT = _CHECK.format(name="'4-partitions'", v="violations") + """ from (
  select count(*) as violations from (
    select distinct anio, mes from fact join dim_date using (date_id)) m
  where not exists (select 1 from fact f where f.year = m.anio and f.month = m.mes
                    and not (f.year = 2023 and f.month = 1)))"""

_UNIQUE_OUT = _CHECK.format(name="'5-unique-articles'", v="violations") + """ from (
  select count(*) - count(distinct article_id) as violations from (
    select article_id from fact union all select article_id from fact where month = 1))"""


def runs_sql(run: str) -> list[str]:
    """What several runs load: ``run`` numbers the run a row is in by its month ``m`` (0: no date).

    Each run keeps the first row of an article; an article that an earlier run has loaded
    is not loaded again. Ids go by run, then by place.
    """
    first = "min(run * 1000000000000 + _seq)"
    return [ARTICLES_SQL, f"""
tagged as (
  select *, {run} as run from (
    select *, coalesce(month(pub_date), 0) as m from (
      select *, cast(try_strptime(trim(publish_date), '%Y-%m-%d') as date) as pub_date from articles))),
usable as (select * from tagged where article_id is not null and publish_date is not null),
firsts as (
  select * from usable qualify row_number() over (partition by run, article_id order by _seq) = 1),
dated as (
  select *, cast(year(pub_date) as integer) as year, cast(month(pub_date) as integer) as month
  from firsts where pub_date is not null),
clean as (select * from dated qualify row_number() over (partition by article_id order by run) = 1),
dim_source as (
  select source, cast(row_number() over (order by first_seq) as integer) as source_id
  from (select lower(source) as source, {first} as first_seq from tagged
        where source is not null group by 1)),
dim_date as (
  select fecha, cast(row_number() over (order by first_seq) as integer) as date_id
  from (select publish_date as fecha, {first} as first_seq from tagged
        where publish_date is not null group by 1))"""]


_TWO_RUNS = runs_sql("case when m between 1 and 6 then 1 else 2 end")
_TWO_RUNS_OUT = "select article_id, publish_date as fecha, lower(source) as source, year, month from clean"

# Of an article in both halves, the first half's month decides; the later row is kept there.
_HALVES = runs_sql("1 + _seq % 2")
_HALVES_OUT = """select article_id, md5(body) as body_md5, year, month from dated d
where not exists (select 1 from dated o where o.article_id = d.article_id and (
  d.run = 1 and o.run = 2 and o.year = d.year and o.month = d.month
  or d.run = 2 and o.run = 1 and not (o.year = d.year and o.month = d.month)))"""

_FEWER = {n: a for n, a in GAZETTEER.items() if n != "Valparaiso"} | {"Puerto": ("valparaiso",)}
_ONE = {"Metropolitana": GAZETTEER["Metropolitana"]}
_PLACES = [*GAZETTEER, UNKNOWN_REGION]


def _named_regions(ids: dict[str, int]) -> str:
    return ", ".join(f"({i}, {_quote(n)})" for n, i in ids.items())


# A region that comes new gets the next id; the one left out keeps its own.
_VERSION_IDS = {n: i for i, n in enumerate([*_PLACES, "Puerto"], start=1)}
_VERSIONS = [
    *runs_sql("case when m <= 4 then 1 when m <= 8 then 2 else 3 end"), REGION,
    region_sql(_FEWER, [_VERSION_IDS[n] for n in [*_FEWER, UNKNOWN_REGION]], "placed_anew")]
_VERSIONS_OUT = f"""select article_id, region_id, region_version, year, month, region_name from (
  select *, 1 as region_version from placed where run <> 2
  union all select *, 2 from placed_anew where run = 2)
join (values {_named_regions(_VERSION_IDS)}) r(region_id, region_name) using (region_id)"""

_RESCORED_IDS = {n: i for i, n in enumerate(
    ["Metropolitana", UNKNOWN_REGION, *[n for n in GAZETTEER if n != "Metropolitana"]], start=1)}
_RESCORED = [
    ARTICLES_SQL, CLEAN, region_sql(_ONE, [1, 2]),
    region_sql(GAZETTEER, [_RESCORED_IDS[n] for n in _PLACES], "placed_anew")]
_RESCORED_OUT = f"""select article_id, region_id, region_version, year, month, region_name from (
  select *, 1 as region_version from placed where year <> 2023
  union all select *, 2 from placed_anew where year = 2023)
join (values {_named_regions(_RESCORED_IDS)}) r(region_id, region_name) using (region_id)"""

_LATE = [*runs_sql("case when m <= 9 then 1 else 2 end"), DIM_REGION, REGION, FACT]

# Lines with too many fields drop out before anything else; short ones are only counted.
_CSV_METRICS_SQL = """
lines as (select * from articles where _seq % 10 <> 3),
lusable as (select * from lines where article_id is not null and publish_date is not null),
lfirsts as (select * from lusable qualify row_number() over (partition by article_id order by _seq) = 1),
lclean as (select * from lfirsts where try_strptime(trim(publish_date), '%Y-%m-%d') is not null)"""

_CSV_METRICS_OUT = """select
  (select count(*) from articles) as raw_rows,
  (select count(*) from articles) - (select count(*) from lines) as malformed,
  (select count(*) from lines) - (select count(*) from lusable) as skipped_null,
  (select count(*) from lusable) - (select count(*) from lfirsts) as skipped_dup,
  (select count(*) from lfirsts) - (select count(*) from lclean) as bad_date,
  (select count(*) from lclean) as written,
  (select count(*) from articles where _seq % 10 = 4) as padded"""

_JOB_FILES_OUT = " union all ".join(
    f"select '{name}' as file, {value} as value from ({rows})" for name, value, rows in (
        ("top_terms_month", "value", _REPORT_TOP), ("words_region", "value", _REPORT_REGION),
        ("words_global", "word || ',' || n", "select * from overall"),
        ("kl_source", "fuente || ',' || kl_divergencia", _REPORT_KL),
        ("peaks", "fecha || ',' || articulos || ',' || promedio_movil_7d || ',' || factor", _REPORT_PEAKS),
        ("daily_series", "fecha || ',' || articulos || ',' || promedio_movil_7d || ',' || es_peak",
         _REPORT_SERIES)))

_LOST = _orphans("source_id", "dim_source")
def _report_sql(facts: str, rows: str) -> str:
    return f"""select *, bool_and(passed) over () as all_passed from (
  select '1-referential' as "check", {_LOST} = 0 as passed, cast({_LOST} as bigint) as violations,
    case when {_LOST} = 0 then 'every id has its dimension row'
      else 'facts without a dimension row: date=0, source=' || {_LOST} || ', region=0' end as detail
  union all select '2-row-count', true, 0,
    {facts} || ' facts of ' || {rows} || ' rows read'
  union all select '3-primary-key/dim_' || unnest(['date', 'source', 'region']), true, 0, 'each id once'
  union all select '4-partitions', true, 0,
    'months found on disk: ' || (select count(distinct (year, month)) from fact)
  union all select '5-unique-articles', true, 0, 'each article once')"""


_REPORT_OUT = _report_sql("(select count(*) from fact)", "(select count(*) from articles)")
_REPORT_LATE_OUT = "select * exclude (all_passed) from (" + _report_sql(
    "(select count(*) from fact where run = 2)", "(select count(*) from tagged where run = 2)") + ")"
_TOP_WIDE_OUT = _TOP_OUT.replace("rank <= 20", "rank <= 1001")


def oracle_sql() -> dict[str, str]:
    articles, clean = [ARTICLES_SQL], [ARTICLES_SQL, CLEAN]
    levels = " union all ".join(
        f"select '{name}' as level, {cols}, word, n from {table}" for name, cols, table in (
            ("month", "year, month, null::int as region_id, null::int as source_id", "by_month"),
            ("region", "null::int as year, null::int as month, region_id, null::int as source_id",
             "by_region"),
            ("source", "null::int as year, null::int as month, null::int as region_id, source_id",
             "by_source"),
            ("global", "null::int as year, null::int as month, null::int as region_id, "
             "null::int as source_id", "overall")))
    return {
        "scan_project": with_sql(articles, "select publish_date, lower(source) as source, _seq from articles"),
        "reject_null_keys": with_sql(clean, "select article_id, publish_date, _seq from usable"),
        "dedup_first": with_sql(clean, "select article_id, publish_date, _seq, md5(body) as body_md5 from firsts"),
        "dedup_shuffled": with_sql(clean, "select article_id, publish_date, _seq, md5(body) as body_md5 from firsts"),
        "parse_dates": with_sql(clean, "select article_id, cast(pub_date as varchar) as pub_date, year, month, _seq from clean"),
        "etl_metrics": with_sql(clean, _METRICS_OUT),
        "first_seen_keys": with_sql(
            [ARTICLES_SQL, DATE_KEYS, SOURCE_KEYS],
            "select 'date' as kind, fecha as value, date_id as id from date_keys "
            "union all select 'source', source, source_id from dim_source"),
        "dim_date": with_sql([ARTICLES_SQL, DATE_KEYS], "select * from dim_date"),
        "dim_source": with_sql([ARTICLES_SQL, SOURCE_KEYS], "select source_id, source from dim_source"),
        "dim_region": with_sql(
            ETL, "select d.*, count(f.region_id) as articles from dim_region d "
                 "left join fact f using (region_id) group by all"),
        "lookup_default": with_sql(ETL, "select article_id, date_id, source_id from fact"),
        "fold_text": f"select doc_id, md5({FOLD.format('text')}) as folded_md5, "
                     f"length({FOLD.format('text')}) as folded_length from documents",
        "word_count": f"select doc_id, {_words('text')} as words from documents",
        "tokens": "select doc_id, word, count(*) as n from (select doc_id, "
                  f"lower(unnest({tokens_of('text')})) as word from documents) "
                  f"where word not in ({_list(_single)}) group by all",
        "repair_text": f"""with spoiled as (select doc_id, {spoiled_sql()} as bad from documents),
            repaired as (select doc_id, length(bad) as spoiled_length,
              {repaired_sql('bad')} as text from spoiled)
            select doc_id, spoiled_length, md5(text) as repaired_md5,
              length(text) as repaired_length from repaired""",
        "tidy_text": f"select doc_id, md5(text || {_quote('ñ' + TIDY)}) as tidy_md5 from documents",
        "assign_region": with_sql(
            [*clean, DIM_REGION, REGION],
            "select article_id, region_id, region_name from placed join dim_region using (region_id)"),
        "fact_news": with_sql(ETL, _FACT_OUT),
        "etl_csv_roundtrip": with_sql(ETL, _FACT_OUT),
        "etl_two_runs": with_sql(_TWO_RUNS, _TWO_RUNS_OUT),
        "etl_merge_halves": with_sql(_HALVES, _HALVES_OUT),
        "etl_region_versions": with_sql(_VERSIONS, _VERSIONS_OUT),
        "etl_regions_rescored": with_sql(_RESCORED, _RESCORED_OUT),
        "counts_incremental": with_sql([*_LATE, TERMS, COUNTS], levels),
        "check_incremental": with_sql(_LATE, _REPORT_LATE_OUT),
        "top_terms_wide": with_sql(ANALYSIS, _TOP_WIDE_OUT),
        "etl_metrics_csv": with_sql([ARTICLES_SQL, _CSV_METRICS_SQL], _CSV_METRICS_OUT),
        "job_files": with_sql([*ANALYSIS, SERIES.format(window=7, factor=1.5)], _JOB_FILES_OUT),
        "scan_years": with_sql(
            ETL, "select year, month, region_id, count(*) as articles from fact "
                 "where year = 2023 group by all"),
        "counts_month": with_sql(ANALYSIS, "select * from by_month"),
        "counts_region": with_sql(ANALYSIS, "select * from by_region"),
        "counts_source": with_sql(ANALYSIS, "select * from by_source"),
        "counts_global": with_sql(ANALYSIS, "select * from overall"),
        "counts_day": with_sql(ANALYSIS, "select * from by_day"),
        "counts_one_pass": with_sql(ANALYSIS, levels),
        "counts_reused": with_sql(ANALYSIS, levels),
        "top_k_terms_month": with_sql(ANALYSIS, _TOP_OUT),
        "dist_words_region": with_sql(ANALYSIS, _REGION_WORDS_OUT),
        "dist_global": with_sql(ANALYSIS, "select word as palabra, n as f_g from overall"),
        "kl_source": with_sql(ANALYSIS, _KL_OUT),
        "daily_series": with_sql(
            [day_sql("orders", "o_orderdate"), SERIES.format(window=7, factor=1.5)], _SERIES_OUT),
        "peaks": with_sql(
            [day_sql("orders", "o_orderdate"), SERIES.format(window=7, factor=1.5)], _PEAKS_OUT),
        "peaks_events": with_sql(
            [day_sql("events", "ts"), SERIES.format(window=7, factor=1.05)], _PEAKS_OUT),
        "peaks_articles": with_sql([*ANALYSIS, SERIES.format(window=7, factor=1.5)], _SERIES_OUT),
        "report_top_terms": with_sql(ANALYSIS, _REPORT_TOP),
        "report_region_words": with_sql(ANALYSIS, _REPORT_REGION),
        "report_kl": with_sql(ANALYSIS, _REPORT_KL),
        "report_peaks": with_sql(
            [day_sql("orders", "o_orderdate"), SERIES.format(window=7, factor=1.5)], _REPORT_PEAKS),
        "report_series": with_sql(
            [day_sql("orders", "o_orderdate"), SERIES.format(window=7, factor=1.5)], _REPORT_SERIES),
        "check_referential": with_sql(ETL, _REFERENTIAL_OUT),
        "check_rowcount": with_sql(ETL, _ROW_COUNT_OUT),
        "check_pk": with_sql(ETL, _PK_OUT),
        "check_partitions": with_sql(ETL, _PARTITIONS_OUT),
        "check_unique_articles": with_sql(ETL, _UNIQUE_OUT),
        "check_report": with_sql(ETL, _REPORT_OUT),
    }
