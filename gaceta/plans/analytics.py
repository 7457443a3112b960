"""From a warehouse to the four query results, by way of reusable counts."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaceta.operators import analysis, counts
from gaceta.params import Params
from gaceta.plans.etl import EtlResult, run_etl
from gaceta.sources import reports
from gaceta.sources.warehouse import FACT, CountStore, Part, PartStore, Warehouse

DAY = "day"
MONTH_TERMS = ["year", "month", "region_id", "source_id", "word", "n"]
TERMS = "region_id int, source_id int, word string, n long"


@dataclass(frozen=True)
class Counts:
    month: DataFrame
    region: DataFrame
    source: DataFrame
    world: DataFrame
    day: DataFrame


@dataclass(frozen=True)
class Results:
    top_terms: DataFrame
    region_words: DataFrame
    global_words: DataFrame
    kl: DataFrame
    peaks: DataFrame
    series: DataFrame


def _hash(*said) -> str:
    return hashlib.sha256(repr(said).encode()).hexdigest()[:32]


def month_counts(spark: SparkSession, warehouse: Warehouse, params: Params) -> PartStore:
    """Counts kept per month of the fact, for one set of term parameters."""
    return PartStore(spark, warehouse.path(f"month_terms/{_hash(params.tokens)}"))


def count_months(
    spark: SparkSession, warehouse: Warehouse, params: Params = Params(), again: bool = False,
) -> list[Part]:
    """Count the months whose facts have not been counted yet, or all of them; which they were.

    No other month's text is read.
    """
    house = warehouse.pinned(spark)
    parts = house.parts_of(spark, FACT, params.query.years)
    store = month_counts(spark, house, params)
    missing = parts if again else store.missing(parts)
    if missing:
        fact = house.fact(spark, parts=missing)
        store.add(missing, {
            "terms": counts.grouped_counts(fact, params.tokens, counts.MONTH_LEVELS).select(*MONTH_TERMS),
            "day": fact.groupBy("year", "month", "date_id").agg(F.count(F.lit(1)).alias("n"))})
    return missing


def warehouse_counts(
    spark: SparkSession, warehouse: Warehouse, params: Params = Params(), refresh: bool = False,
) -> Counts:
    """The five counts, from the store if a finished run is there, else computed and kept.

    They are stored for the term parameters and the months they were made from, each as one
    run wrote it; others are not taken for them. What is not there is summed from the counts
    of single months, of which only those of new or changed months are made.
    """
    house = warehouse.pinned(spark)
    parts = house.parts_of(spark, FACT, params.query.years)
    named = sorted((p.year, p.month, p.run) for p in parts)
    store = CountStore(spark, house.path("counts"), _hash(params.tokens, params.query.years, named))
    run = None if refresh else store.current()
    if run is None:
        run = store.new_run()
        count_months(spark, house, params, again=refresh)
        months = month_counts(spark, house, params)
        store.write(run, "terms", counts.months_summed(months.read("terms", TERMS, parts)), by="level")
        per_id = months.read("day", "date_id int, n long", parts)
        store.write(run, DAY, counts.days_summed(per_id, house.read(spark, "dim_date")))
        store.publish(run)
    terms = store.read(run, "terms", counts.GROUPED_SCHEMA)
    return Counts(
        *[counts.level_counts(terms, level) for level in ("month", "region", "source", "global")],
        store.read(run, DAY, counts.DAY_SCHEMA),
    )


def write_counts_json(c: Counts, folder: str) -> None:
    """The five counts as JSON lines, for tools that do not read Parquet."""
    for name, table in vars(c).items():
        table.write.mode("overwrite").json(f"{folder}/{name}")


def read_counts_json(spark: SparkSession, folder: str) -> Counts:
    keys = {
        "month": "year int, month int, word string", "region": "region_id int, word string",
        "source": "source_id int, word string", "world": "word string", "day": "fecha string",
    }
    return Counts(**{
        name: spark.read.schema(f"{columns}, n long").json(f"{folder}/{name}")
        for name, columns in keys.items()
    })


def query_results(
    spark: SparkSession, warehouse: Warehouse, params: Params = Params(), refresh: bool = False,
) -> Results:
    warehouse = warehouse.pinned(spark)
    c = warehouse_counts(spark, warehouse, params, refresh)
    q = params.query
    return Results(
        top_terms=analysis.top_terms_by_month(c.month, q),
        region_words=analysis.words_by_region(
            c.region, c.world, warehouse.read(spark, "dim_region"), q),
        global_words=c.world,
        kl=analysis.kl_by_source(c.source, c.world, warehouse.read(spark, "dim_source"), q),
        peaks=analysis.volume_peaks(c.day, q),
        series=analysis.daily_series(c.day, q),
    )


def write_results(results: Results, folder: str, window: int = 7) -> None:
    """The result files: two text reports and four CSV tables."""
    reports.write_text(reports.top_terms_lines(results.top_terms), f"{folder}/top_terms_month")
    reports.write_text(reports.region_lines(results.region_words), f"{folder}/words_region")
    reports.write_csv(reports.global_table(results.global_words), f"{folder}/words_global")
    reports.write_csv(reports.kl_table(results.kl), f"{folder}/kl_source")
    reports.write_csv(reports.peaks_table(results.peaks, window), f"{folder}/peaks")
    reports.write_csv(reports.series_table(results.series, window), f"{folder}/daily_series")


def run_queries(
    spark: SparkSession, warehouse: str, folder: str | None = None, params: Params = Params(),
    refresh: bool = False,
) -> Results:
    """Answer the queries on an existing warehouse; write the result files if asked to."""
    results = query_results(spark, Warehouse(warehouse), params, refresh)
    if folder:
        write_results(results, folder, params.query.window)
    return results


def run_all(
    spark: SparkSession, articles: str | list[str], warehouse: str, folder: str | None = None,
    params: Params = Params(), **etl_options,
) -> tuple[EtlResult, Results]:
    """Build the warehouse, then answer the queries; only the months of this run are counted."""
    etl = run_etl(spark, articles, warehouse, params, **etl_options)
    return etl, run_queries(spark, warehouse, folder, params)
