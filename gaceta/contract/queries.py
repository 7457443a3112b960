"""The registered queries: (spark, sf_dir) -> DataFrame over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaceta import session
from gaceta.contract.articles import article_view, documents
from gaceta.contract.mojibake import UNTIDY, misread, spoil
from gaceta.functions import dates, text
from gaceta.operators import analysis, checks, classify, clean, counts, keys
from gaceta.operators.fact import build_fact
from gaceta.params import Params, QueryParams, TokenParams
from gaceta.plans import analytics, etl
from gaceta.schema import RAW_COLUMNS
from gaceta.sources import reports
from gaceta.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
PARAMS = Params()
LEVEL_COLUMNS = ["level", "year", "month", "region_id", "source_id", "word", "n"]


def _dims(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    dates = session.materialize(keys.dim_date(keys.date_keys(raw)))
    sources = session.materialize(keys.dim_source(keys.source_keys(raw)))
    return dates, sources


def _fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    dates, sources = _dims(article_view(spark, sf_dir))
    return build_fact(article_view(spark, sf_dir), dates, sources, PARAMS), dates, sources


# --- scans and rejection ---

def scan_project(spark, sf_dir):
    return article_view(spark, sf_dir).select("publish_date", F.lower("source").alias("source"), "_seq")


def reject_null_keys(spark, sf_dir):
    kept = clean.reject_null_keys(article_view(spark, sf_dir))
    return kept.select("article_id", "publish_date", "_seq")


def dedup_first(spark, sf_dir):
    kept = clean.keep_first(clean.reject_null_keys(article_view(spark, sf_dir)))
    return kept.select("article_id", "publish_date", "_seq", F.md5("body").alias("body_md5"))


def dedup_shuffled(spark, sf_dir):
    """``dedup_first`` as it runs when nothing is small enough to be broadcast."""
    kept = clean.keep_first(clean.reject_null_keys(article_view(spark, sf_dir)), limit=0)
    return kept.select("article_id", "publish_date", "_seq", F.md5("body").alias("body_md5"))


def parse_dates(spark, sf_dir):
    narrow = article_view(spark, sf_dir).select("article_id", "publish_date", "_seq")
    dated = clean.parse_dates(clean.keep_first(clean.reject_null_keys(narrow)))
    return dated.select(
        "article_id", F.col("pub_date").cast("string").alias("pub_date"), "year", "month", "_seq")


def etl_metrics(spark, sf_dir):
    return clean.rejection_counts(article_view(spark, sf_dir)).drop("malformed", "padded")


# --- dimensions and keys ---

def first_seen_keys(spark, sf_dir):
    raw = article_view(spark, sf_dir)
    dates = keys.date_keys(raw).select(
        F.lit("date").alias("kind"), F.col("fecha").alias("value"), F.col("date_id").alias("id"))
    sources = keys.source_keys(raw).select(
        F.lit("source").alias("kind"), F.col("source").alias("value"), F.col("source_id").alias("id"))
    return dates.unionByName(sources)


def dim_date(spark, sf_dir):
    return keys.dim_date(keys.date_keys(article_view(spark, sf_dir))).orderBy("fecha")


def dim_source(spark, sf_dir):
    return keys.dim_source(keys.source_keys(article_view(spark, sf_dir))).orderBy("source_id")


def dim_region(spark, sf_dir):
    """The region dimension with the number of articles each region has."""
    placed = classify.assign_region(clean.clean_articles(article_view(spark, sf_dir)))
    per_region = placed.groupBy("region_id").agg(F.count(F.lit(1)).alias("articles"))
    dim = keys.dim_region(spark, PARAMS.regions)
    return dim.join(per_region, "region_id", "left").withColumn(
        "articles", F.coalesce("articles", F.lit(0)))


def lookup_default(spark, sf_dir):
    raw = article_view(spark, sf_dir)
    dates, sources = _dims(raw)
    rows = clean.parse_dates(clean.keep_first(clean.reject_null_keys(
        raw.select("article_id", "publish_date", "source", "_seq"))))
    keyed = rows.withColumns({"fecha": F.col("publish_date"), "source": F.lower("source")})
    keyed = keys.lookup_ids(keyed, dates, "fecha", "date_id")
    keyed = keys.lookup_ids(keyed, sources, "source", "source_id")
    return keyed.select("article_id", "date_id", "source_id")


# --- text functions ---

def fold_text(spark, sf_dir):
    folded = documents(spark, sf_dir).select("doc_id", text.fold(F.col("text")).alias("folded"))
    return folded.select(
        "doc_id", F.md5("folded").alias("folded_md5"),
        F.length("folded").cast("long").alias("folded_length"))


def word_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.word_count(F.col("text")).alias("words"))


def tokens(spark, sf_dir):
    rows = counts.token_rows(documents(spark, sf_dir), ["doc_id"], PARAMS.tokens, texts=("text",))
    return rows.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def repair_text(spark, sf_dir):
    spoiled = documents(spark, sf_dir).select(
        "doc_id", spoil(F.col("text"), F.col("doc_id")).alias("bad"))
    repaired = spoiled.select(
        "doc_id", F.length("bad").cast("long").alias("spoiled_length"),
        text.repair(F.col("bad")).alias("text"))
    return repaired.select(
        "doc_id", "spoiled_length", F.md5("text").alias("repaired_md5"),
        F.length("text").cast("long").alias("repaired_length"))


def tidy_text(spark, sf_dir):
    """Quotes, line ends, full-width forms and control characters in texts under repair."""
    spoiled = F.concat(F.col("text"), F.lit(misread("ñ") + UNTIDY))
    return documents(spark, sf_dir).select("doc_id", F.md5(text.repair(spoiled)).alias("tidy_md5"))


def assign_region(spark, sf_dir):
    placed = classify.assign_region(clean.clean_articles(article_view(spark, sf_dir)))
    return placed.select("article_id", "region_id", "region_name")


# --- fact table ---

def _fact_columns(fact: DataFrame) -> DataFrame:
    return fact.select(
        "article_id", "date_id", "source_id", "region_id",
        F.md5("title").alias("title_md5"), F.md5("body").alias("body_md5"),
        "title_word_count", "body_word_count", "year", "month")


def fact_news(spark, sf_dir):
    return _fact_columns(_fact(spark, sf_dir)[0])


def etl_csv_roundtrip(spark, sf_dir):
    """The whole job: articles to CSV files, CSV to warehouse, and the fact read back."""
    csv = _write_csv(article_view(spark, sf_dir), session.scratch_path(spark, "articles-csv"))
    result = etl.run_etl(spark, csv, session.scratch_path(spark, "warehouse"), PARAMS)
    return _fact_columns(result.warehouse.fact(spark))


def _write_csv(articles: DataFrame, path: str) -> str:
    articles.orderBy("_seq").select(*RAW_COLUMNS).write.csv(
        path, header=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def _load(spark, articles: DataFrame, house: str, params: Params = PARAMS, **options) -> etl.EtlResult:
    csv = _write_csv(articles, session.scratch_path(spark, "articles-csv"))
    return etl.run_etl(spark, csv, house, params, **options)


def _month_of(articles: DataFrame) -> DataFrame:
    return articles.withColumn("_month", F.coalesce(F.month(dates.parse_day(F.col("publish_date"))), F.lit(0)))


def _named(spark, house: Warehouse) -> DataFrame:
    fact = house.fact(spark).select("article_id", "date_id", "source_id", "year", "month")
    dim_date = house.read(spark, "dim_date").select("date_id", "fecha")
    named = session.lookup_join(fact, session.materialize(dim_date), "date_id", spread="article_id")
    named = session.lookup_join(named, house.read(spark, "dim_source"), "source_id", spread="article_id")
    return named.select("article_id", "fecha", "source", "year", "month")


def etl_two_runs(spark, sf_dir):
    """Three runs into one warehouse, the last of which brings articles that are there already.

    First the months to June, then the others. Then articles of February to June again under
    another date, and the whole of January once more as it was.
    """
    articles = _month_of(article_view(spark, sf_dir))
    house = session.scratch_path(spark, "warehouse")
    early = F.col("_month").between(1, 6)
    _load(spark, articles.where(early), house)
    _load(spark, articles.where(~early), house)
    moved = articles.where("_month between 2 and 6 and _seq % 5 = 0").withColumn(
        "publish_date", F.concat(F.lit("2031-12-"), F.substring("publish_date", 9, 2)))
    return _named(spark, _load(
        spark, moved.unionByName(articles.where("_month = 1")), house).warehouse)


def etl_merge_halves(spark, sf_dir):
    """Every month loaded in two halves, the second merged into what the first has written."""
    articles = article_view(spark, sf_dir)
    house = session.scratch_path(spark, "warehouse")
    _load(spark, articles.where("_seq % 2 = 0"), house)
    result = _load(spark, articles.where("_seq % 2 = 1"), house, overwrite="merge")
    return result.warehouse.fact(spark).select(
        "article_id", F.md5("body").alias("body_md5"), "year", "month")


def etl_region_versions(spark, sf_dir):
    """Two runs with two gazetteers, and a third that is the first's: whose region an article is in.

    The second leaves out a region and adds another. Its months are not scored anew.
    """
    articles = _month_of(article_view(spark, sf_dir))
    house = session.scratch_path(spark, "warehouse")
    regions = PARAMS.regions.gazetteer
    fewer = {n: a for n, a in regions.items() if n != "Valparaiso"} | {"Puerto": ("valparaiso",)}
    changed = replace(PARAMS, regions=replace(PARAMS.regions, gazetteer=fewer))
    for months, params in (((0, 4), PARAMS), ((5, 8), changed), ((9, 12), PARAMS)):
        _load(spark, articles.where(F.col("_month").between(*months)), house, params)
    return _region_names(spark, Warehouse(house))


def _region_names(spark, house: Warehouse) -> DataFrame:
    placed = house.fact(spark).select("article_id", "region_id", "region_version", "year", "month")
    return placed.join(
        F.broadcast(house.read(spark, "dim_region").select("region_id", "region_name")), "region_id")


def etl_regions_rescored(spark, sf_dir):
    """All articles loaded with a gazetteer of one region, then those of 2023 placed anew."""
    house = session.scratch_path(spark, "warehouse")
    one = {"Metropolitana": PARAMS.regions.gazetteer["Metropolitana"]}
    poor = replace(PARAMS, regions=replace(PARAMS.regions, gazetteer=one))
    _load(spark, article_view(spark, sf_dir), house, poor)
    etl.rescore_regions(spark, house, PARAMS, years=(2023, 2023))
    return _region_names(spark, Warehouse(house))


def counts_incremental(spark, sf_dir):
    """Counts after a second run: only its months are counted, and sums are of all months."""
    articles = _month_of(article_view(spark, sf_dir))
    house = session.scratch_path(spark, "warehouse")
    for months in ((0, 9), (10, 12)):
        _load(spark, articles.where(F.col("_month").between(*months)), house)
        kept = analytics.warehouse_counts(spark, Warehouse(house), PARAMS)
    return _levels(kept)


def check_incremental(spark, sf_dir):
    """The report after a second run, in which only the new months' facts were looked at."""
    articles = _month_of(article_view(spark, sf_dir))
    house = session.scratch_path(spark, "warehouse")
    for months in ((0, 9), (10, 12)):
        report = _load(spark, articles.where(F.col("_month").between(*months)), house).checks
    return report


def etl_metrics_csv(spark, sf_dir):
    """All counters of CSVs in which some lines have too many fields and some too few."""
    kind = F.col("_seq") % 10
    quoted = lambda c: F.coalesce(
        F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
    fields = [quoted(F.col(c)) for c in RAW_COLUMNS]
    line = (
        F.when(kind == 3, F.concat_ws(",", *fields, F.lit("x"), F.lit('"y,z"')))
        .when(kind == 4, F.concat_ws(",", *fields[:3])).otherwise(F.concat_ws(",", *fields)))
    header = ",".join(RAW_COLUMNS)
    ordered = article_view(spark, sf_dir).orderBy("_seq").select(line.alias("value"))
    # Every file starts with the header.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    path = session.scratch_path(spark, "articles-csv")
    ordered.select(F.when(first, F.concat(F.lit(f"{header}\n"), "value")).otherwise(F.col("value"))) \
        .write.text(path)
    result = etl.run_etl(spark, path, session.scratch_path(spark, "warehouse"), PARAMS)
    return result.metrics.drop("skipped_known")


def job_files(spark, sf_dir):
    """The whole job from CSVs to result files, and what the files hold, line by line."""
    csv = _write_csv(article_view(spark, sf_dir), session.scratch_path(spark, "articles-csv"))
    folder = session.scratch_path(spark, "results")
    analytics.run_all(spark, csv, session.scratch_path(spark, "warehouse"), folder, PARAMS)
    texts = [spark.read.text(f"{folder}/{name}").select(F.lit(name).alias("file"), "value")
             for name in ("top_terms_month", "words_region")]
    tables = {name: spark.read.option("header", True).option("emptyValue", "").csv(f"{folder}/{name}")
              for name in ("words_global", "kl_source", "peaks", "daily_series")}
    lines = [table.select(F.lit(name).alias("file"), F.concat_ws(",", *[
        F.coalesce(c, F.lit("")) for c in table.columns]).alias("value")) for name, table in tables.items()]
    return reduce(DataFrame.unionByName, [*texts, *lines])


def scan_years(spark, sf_dir):
    """One year of a partitioned fact table: other years' files are never opened."""
    return _built_warehouse(spark, sf_dir).fact(spark, years=(2023, 2023)).groupBy("year", "month", "region_id").agg(
        F.count(F.lit(1)).alias("articles"))


# --- counts ---

def _count_query(level: str) -> Query:
    def run(spark, sf_dir):
        fact = _fact(spark, sf_dir)[0]
        return counts.count_terms(fact, counts.LEVELS[level], PARAMS.tokens)

    return run


def counts_day(spark, sf_dir):
    fact, dates, _ = _fact(spark, sf_dir)
    return counts.articles_per_day(fact, dates)


def counts_one_pass(spark, sf_dir):
    return counts.grouped_counts(_fact(spark, sf_dir)[0], PARAMS.tokens).select(*LEVEL_COLUMNS)


def _built_warehouse(spark, sf_dir) -> Warehouse:
    fact, dates, sources = _fact(spark, sf_dir)
    run = Warehouse(session.scratch_path(spark, "warehouse")).begin(spark)
    run.write_fact(fact, None)
    run.replace("dim_date", dates)
    run.replace("dim_source", sources)
    run.replace("dim_region", keys.dim_region(spark, PARAMS.regions))
    run.publish()
    return Warehouse(run.root)


def counts_reused(spark, sf_dir):
    """Counts picked up from a store that also holds those of other parameters."""
    house = _built_warehouse(spark, sf_dir)
    analytics.warehouse_counts(spark, house, Params(
        tokens=TokenParams(min_length=6), query=QueryParams(years=(2023, 2023))))
    analytics.warehouse_counts(spark, house, PARAMS)
    kept = analytics.warehouse_counts(spark, house, PARAMS)
    return _levels(kept)


def _levels(kept: analytics.Counts) -> DataFrame:
    parts = {"month": kept.month, "region": kept.region, "source": kept.source, "global": kept.world}
    filled = [df.withColumn("level", F.lit(level)) for level, df in parts.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), filled)
    return union.select(*LEVEL_COLUMNS)


# --- the four queries ---

def top_k_terms_month(spark, sf_dir):
    monthly = counts.count_terms(
        clean.clean_articles(article_view(spark, sf_dir)), counts.MONTH, PARAMS.tokens)
    return analysis.top_terms_by_month(monthly, PARAMS.query)


def top_terms_wide(spark, sf_dir):
    """More terms per month than Spark cuts off in every task."""
    monthly = session.materialize(counts.count_terms(
        clean.clean_articles(article_view(spark, sf_dir)), counts.MONTH, PARAMS.tokens))
    return analysis.top_terms_by_month(monthly, replace(PARAMS.query, top_k=analysis.TASK_RANKS + 1))


def dist_words_region(spark, sf_dir):
    return _rounded(_region_words(spark, sf_dir), "ratio")


def dist_global(spark, sf_dir):
    articles = clean.clean_articles(article_view(spark, sf_dir))
    return reports.global_table(counts.count_terms(articles, [], PARAMS.tokens))


def _kl(spark, sf_dir) -> DataFrame:
    keys_only = article_view(spark, sf_dir)
    sources = session.materialize(keys.dim_source(keys.source_keys(keys_only)))
    articles = clean.clean_articles(article_view(spark, sf_dir))
    articles = articles.withColumn("source", F.lower("source"))
    keyed = keys.lookup_ids(articles, sources, "source", "source_id")
    by_source = session.materialize(counts.count_terms(keyed, counts.SOURCE, PARAMS.tokens))
    return analysis.kl_by_source(by_source, counts.resum(by_source, []), sources, PARAMS.query)


def kl_source(spark, sf_dir):
    return _rounded(_kl(spark, sf_dir), "kl")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- result files, as the lines and rows they hold ---

def report_top_terms(spark, sf_dir):
    return reports.top_terms_lines(top_k_terms_month(spark, sf_dir))


def _region_words(spark, sf_dir) -> DataFrame:
    placed = classify.assign_region(clean.clean_articles(article_view(spark, sf_dir)))
    regional = session.materialize(counts.count_terms(placed, counts.REGION, PARAMS.tokens))
    return analysis.words_by_region(
        regional, counts.resum(regional, []), keys.dim_region(spark, PARAMS.regions), PARAMS.query)


def report_region_words(spark, sf_dir):
    return reports.region_lines(session.materialize(_region_words(spark, sf_dir)))


def report_kl(spark, sf_dir):
    return reports.kl_table(_kl(spark, sf_dir))


def report_peaks(spark, sf_dir):
    return reports.peaks_table(analysis.volume_peaks(_orders_per_day(spark, sf_dir)))


def report_series(spark, sf_dir):
    return reports.series_table(analysis.daily_series(_orders_per_day(spark, sf_dir)))


def _orders_per_day(spark, sf_dir) -> DataFrame:
    return counts.rows_per_day(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")


def daily_series(spark, sf_dir):
    return _rounded(analysis.daily_series(_orders_per_day(spark, sf_dir)), "moving_avg")


def peaks(spark, sf_dir):
    return _rounded(analysis.volume_peaks(_orders_per_day(spark, sf_dir)), "moving_avg", "factor")


def peaks_events(spark, sf_dir):
    daily = counts.rows_per_day(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")
    return _rounded(analysis.volume_peaks(daily, QueryParams(factor=1.05)), "moving_avg", "factor")


def peaks_articles(spark, sf_dir):
    """The daily series of the articles themselves; only their keys are read."""
    raw = article_view(spark, sf_dir).select("article_id", "publish_date", "_seq")
    dates = session.materialize(keys.dim_date(keys.date_keys(raw)))
    kept = clean.parse_dates(clean.keep_first(clean.reject_null_keys(raw)))
    keyed = keys.lookup_ids(kept.withColumn("fecha", F.col("publish_date")), dates, "fecha", "date_id")
    daily = counts.articles_per_day(keyed, dates)
    return _rounded(analysis.daily_series(daily), "moving_avg")


# --- checks, each with a fault put in ---

def _fact_keys(spark, sf_dir, *columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Materialised key columns of the fact table, for checks that read them repeatedly."""
    raw = article_view(spark, sf_dir)
    dates, sources = _dims(article_view(spark, sf_dir))
    fact = build_fact(raw, dates, sources, PARAMS)
    return session.materialize(fact.select(*columns)), dates, sources


def check_referential(spark, sf_dir):
    fact, dates, sources = _fact_keys(spark, sf_dir, "date_id", "source_id", "region_id")
    lacking = dates.where("fecha <> '2023-01-02'")
    report = checks.check_referential(fact, lacking, sources, keys.dim_region(spark, PARAMS.regions))
    return report.drop("detail")


def check_rowcount(spark, sf_dir):
    fact, _, _ = _fact_keys(spark, sf_dir, "article_id")
    raw = article_view(spark, sf_dir).agg(F.count(F.lit(1)).alias("raw_rows"))
    short = fact.agg((F.count(F.lit(1)) - 3).alias("raw_rows"))
    variants = {"raw": raw, "short": short}
    return reduce(DataFrame.unionByName, [
        checks.check_row_count(fact, rows).drop("detail").withColumn("variant", F.lit(name))
        for name, rows in variants.items()
    ])


def check_pk(spark, sf_dir):
    dates_dim, sources = _dims(article_view(spark, sf_dir))
    doubled = dates_dim.unionByName(dates_dim.where("mes = 2"))
    regions = keys.dim_region(spark, PARAMS.regions)
    return reduce(DataFrame.unionByName, [
        checks.check_primary_key(doubled, "dim_date", "date_id"),
        checks.check_primary_key(sources, "dim_source", "source_id"),
        checks.check_primary_key(
            regions.unionByName(regions.where("region_id > 15")), "dim_region", "region_id"),
    ]).drop("detail")


def check_partitions(spark, sf_dir):
    fact, dates, _ = _fact_keys(spark, sf_dir, "date_id", "year", "month")
    present = fact.where("not (year = 2023 and month = 1)")
    return checks.check_partitions(fact, dates, present).drop("detail")


def check_unique_articles(spark, sf_dir):
    fact, _, _ = _fact_keys(spark, sf_dir, "article_id", "month")
    doubled = fact.unionByName(fact.where("month = 1"))
    return checks.check_unique_articles(doubled).drop("detail")


def check_report(spark, sf_dir):
    """All checks of a warehouse on disk, with their words and the overall verdict."""
    house = _built_warehouse(spark, sf_dir)
    raw = article_view(spark, sf_dir).agg(F.count(F.lit(1)).alias("raw_rows"))
    report = session.materialize(checks.check_warehouse(
        house.fact(spark), *[house.read(spark, f"dim_{d}") for d in ("date", "source", "region")],
        raw_rows=raw, partitions=house.fact_partitions(spark)))
    return report.withColumn("all_passed", F.lit(checks.all_passed(report)))


def queries() -> dict[str, Query]:
    plain = [
        scan_project, reject_null_keys, dedup_first, dedup_shuffled, parse_dates, etl_metrics,
        first_seen_keys, dim_date, dim_source, dim_region, lookup_default,
        fold_text, word_count, tokens, repair_text, tidy_text, assign_region,
        fact_news, etl_csv_roundtrip, etl_two_runs, etl_metrics_csv, job_files, scan_years,
        etl_merge_halves, etl_region_versions, etl_regions_rescored,
        counts_day, counts_one_pass, counts_reused, counts_incremental,
        top_k_terms_month, top_terms_wide, dist_words_region, dist_global, kl_source,
        daily_series, peaks, peaks_events, peaks_articles,
        report_top_terms, report_region_words, report_kl, report_peaks, report_series,
        check_referential, check_rowcount, check_pk, check_partitions, check_unique_articles,
        check_report, check_incremental,
    ]
    levels = {f"counts_{level}": _count_query(level) for level in counts.LEVELS}
    return {q.__name__: q for q in plain} | levels
