"""From article CSVs to a checked warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaceta import session
from gaceta.operators import checks, clean, keys, part_stats
from gaceta.operators.classify import assign_region
from gaceta.operators.fact import build_fact
from gaceta.operators.membership import IndexParams
from gaceta.params import Params, RegionParams
from gaceta.schema import FACT_SCHEMA
from gaceta.sources.article_index import ArticleIndex
from gaceta.sources.articles import land_articles, require_positions, scan_articles
from gaceta.sources.warehouse import FACT, Part, PartStore, Run, Warehouse

MODES = ("dynamic", "static", "merge")


class CheckFailure(Exception):
    """A data-quality check did not pass."""


@dataclass(frozen=True)
class EtlResult:
    warehouse: Warehouse
    metrics: DataFrame
    checks: DataFrame


def build_dimensions(run: Run, raw: DataFrame, params: Params) -> None:
    """Add what is new to the dimensions. Keys come from all readable rows, rejected ones included.

    A value keeps the id it was first given, in every later run; date texts that are no
    dates use ids too, which is why all keys are stored next to the dimensions.
    """
    def add(table: str, order: str, found, dimension) -> None:
        fresh = session.materialize(found(run.before.known(run.spark, f"{table}_keys")))
        run.append(f"{table}_keys", fresh, order)
        run.append(table, dimension(fresh), order)

    session.together(
        lambda: add("dim_date", "fecha", lambda known: keys.date_keys(
            raw, params.canonical_dates, known), keys.dim_date),
        lambda: add("dim_source", "source_id", lambda known: keys.source_keys(raw, known), keys.dim_source))


def register_regions(run: Run, params: RegionParams) -> tuple[dict[str, int], int]:
    """Ids of the gazetteer's regions and its version; what is new of either is added.

    Regions that a gazetteer leaves out keep their rows and ids, for facts that have them.
    """
    known = run.before.known(run.spark, "dim_region")
    given = {r["region_name"]: r["region_id"] for r in known.collect()} if known is not None else {}
    ids = keys.region_ids(params, given)
    fresh = {name: i for name, i in ids.items() if name not in given}
    run.append("dim_region", keys.dim_region(run.spark, params, fresh), "region_id")

    known = run.before.known(run.spark, "gazetteers")
    versions = {r["definition"]: r["region_version"] for r in known.collect()} if known is not None else {}
    version = versions.get(params.definition, max(versions.values(), default=0) + 1)
    if params.definition not in versions:
        row = run.spark.createDataFrame([(version, params.definition)], "region_version int, definition string")
        run.append("gazetteers", row.coalesce(1), "region_version")
    return ids, version


def article_index(run: Run, params: IndexParams, parts: list[Part]) -> ArticleIndex:
    """The warehouse's index of article ids, holding ``parts``; its sizes are those of the first run."""
    known = run.before.known(run.spark, "index_params")
    if known is None:
        row = [(params.buckets, params.words, params.probes)]
        known = run.replace("index_params", run.spark.createDataFrame(
            row, "buckets int, words int, probes int").coalesce(1))
    index = ArticleIndex(run.spark, run.root, IndexParams(**known.first().asDict()))
    index.update(run.before, parts)
    return index


def _cleaned_keys(usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(article_id, _seq) of later copies, and (article_id, _seq, year, month) of the rows left."""
    narrow = clean.reject_null_keys(usable.select("article_id", "publish_date", "_seq"))
    copies = session.materialize(clean.later_copies(narrow))
    cleaned = clean.parse_dates(clean.without_rows(narrow, copies))
    return copies, session.materialize(cleaned.select("article_id", "_seq", "year", "month"))


def _months(rows: DataFrame) -> set[tuple[int, int]]:
    """The months that rows fall in; the calendar bounds them."""
    return {(r["year"], r["month"]) for r in rows.select("year", "month").distinct().collect()}


def _merged(run: Run, fact: DataFrame, loaded: DataFrame, months: set[tuple[int, int]]) -> DataFrame:
    """``fact`` and the rows its months already have, but for the articles it brings itself."""
    touched = [p for p in run.before.parts_of(run.spark, FACT) if (p.year, p.month) in months]
    if not touched:
        return fact
    ids = session.materialize(loaded.select("article_id").distinct())
    small = session.fits_broadcast(ids)
    old = run.before.fact(run.spark, parts=touched).join(
        ids.hint("broadcast" if small else "shuffle_hash"), "article_id", "left_anti")
    return old.select(*fact.columns).unionByName(fact)


def folded_checks(
    spark: SparkSession, house: Warehouse, index: ArticleIndex, raw_rows: DataFrame, months: DataFrame,
) -> DataFrame:
    """The check report of a warehouse; only months whose facts are new to it are scanned."""
    parts = house.parts_of(spark, FACT)
    store = PartStore(spark, house.path("fact_stats"))

    def note_stats() -> None:
        if fresh := store.missing(parts):
            store.add(fresh, {"stats": part_stats.part_stats(house.fact(spark, parts=fresh))})

    session.together(lambda: index.update(house, parts), note_stats)
    return checks.fold_checks(
        store.read("stats", part_stats.STATS, parts), index.repeats(parts),
        *[house.read(spark, f"dim_{d}") for d in ("date", "source", "region")],
        raw_rows=raw_rows, partitions=house.fact_partitions(spark), months=months)


def run_etl(
    spark: SparkSession, articles: str | list[str], warehouse: str, params: Params = Params(),
    multi_line: bool = True, order_column: str | None = None, overwrite: str = "dynamic",
    raise_on_failure: bool = False,
) -> EtlResult:
    """Land the CSVs once, then build dimensions, fact table, counters and checks.

    The CSV text is parsed one time. Everything after it reads the landed Parquet copy,
    where each step scans only its own columns. All tables are published together at the
    end: a run that breaks off, or that fails its checks with ``raise_on_failure``, leaves
    the warehouse as it was. Intermediate tables are deleted.

    ``overwrite``: "dynamic" replaces the months the new articles fall in and leaves others,
    "static" replaces all months. "merge" adds to the months: only those touched are written
    anew, articles they already have are replaced by new rows of the same id, others stay.
    An article that the warehouse holds in a month that stays is not loaded a second time
    under another month; it counts as ``skipped_known``.
    """
    if overwrite not in MODES:
        raise ValueError(f"overwrite is one of {MODES}")
    run = Warehouse(warehouse).begin(spark)
    with session.job_scratch(spark):
        scanned = scan_articles(spark, articles, multi_line, order_column=order_column)
        landed = land_articles(scanned, session.scratch_path(spark, "raw-articles"))
        if order_column:
            require_positions(landed)
        usable = landed.where("not _over_long")
        parts = [] if overwrite == "static" else run.before.parts_of(spark, FACT)
        # Which rows are loaded is settled on narrow columns.
        _, (ids, version), index, (copies, cleaned) = session.together(
            lambda: build_dimensions(run, usable, params),
            lambda: register_regions(run, params.regions),
            lambda: article_index(run, params.index, parts),
            lambda: _cleaned_keys(usable))
        months = _months(cleaned)
        month_rows = spark.createDataFrame(sorted(months), "year int, month int")
        repeats = session.materialize(clean.repeats_elsewhere(
            cleaned, index.find(cleaned, parts), month_rows if overwrite == "dynamic" else None))
        left_out = session.materialize(copies.unionByName(repeats))

        fact = build_fact(
            usable, run.house.read(spark, "dim_date"), run.house.read(spark, "dim_source"), params,
            left_out, ids, version)
        if overwrite == "merge":
            loaded = clean.without_rows(cleaned, repeats)
            months = _months(loaded)
            fact = _merged(run, fact, loaded, months)
        run.write_fact(fact, None if overwrite == "static" else months)

        known = repeats.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        metrics = clean.rejection_counts(landed, "_over_long", "_padded").withColumns({
            "written": F.col("written") - known, "skipped_known": known})
        raw_rows = landed.agg(F.count(F.lit(1)).alias("raw_rows"))
        # Merged months hold rows of earlier runs too, which no row read now accounts for.
        counted = month_rows.limit(0) if overwrite == "merge" else month_rows
        house = run.house
        _, report = session.together(
            lambda: run.replace("etl_metrics", metrics),
            lambda: run.replace("checks", folded_checks(spark, house, index, raw_rows, counted).coalesce(1)))
    if raise_on_failure and not checks.all_passed(report):
        raise CheckFailure(str([r.asDict() for r in report.where("not passed").toLocalIterator()]))
    house = run.publish()
    return EtlResult(Warehouse(warehouse), house.read(spark, "etl_metrics"), house.read(spark, "checks"))


def rescore_regions(
    spark: SparkSession, warehouse: str, params: Params = Params(),
    years: tuple[int, int] | None = None,
) -> list[tuple[int, int]]:
    """Place the articles of months scored with another gazetteer anew; the months it wrote.

    Only the version of the facts is read to find these months, and only they are written.
    """
    run = Warehouse(warehouse).begin(spark)
    ids, version = register_regions(run, params.regions)
    fact = run.before.fact(spark, years)
    stale = _months(fact.where(~F.col("region_version").eqNullSafe(F.lit(version))))
    if stale:
        parts = [p for p in run.before.parts_of(spark, FACT) if (p.year, p.month) in stale]
        placed = assign_region(
            run.before.fact(spark, parts=parts), params=params.regions, region_ids=ids)
        placed = placed.withColumn("region_version", F.lit(version))
        run.write_fact(placed.select(*FACT_SCHEMA.names, "year", "month"), stale)
        run.publish()
    return sorted(stale)
