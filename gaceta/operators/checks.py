"""Data-quality checks of a warehouse; each gives rows (check, passed, violations, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta.operators import part_stats


def _report(counted: DataFrame, name: str, violations: Column, good: Column, bad: Column) -> DataFrame:
    found = F.coalesce(violations, F.lit(0)).cast("long")
    return counted.select(
        F.lit(name).alias("check"),
        (found == 0).alias("passed"),
        found.alias("violations"),
        F.when(found == 0, good).otherwise(bad).alias("detail"),
    )


def orphans(per_id: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """(key, n) of the fact ids that the dimension lacks; ``per_id`` has (key, n facts).

    An id that a third of the facts share is one row by then.
    """
    return per_id.join(dim.select(key), key, "left_anti")


def _per_id(fact: DataFrame, name: str) -> DataFrame:
    return fact.groupBy(f"{name}_id").agg(F.count(F.lit(1)).alias("n"))


def check_referential(
    fact: DataFrame, dim_date: DataFrame, dim_source: DataFrame, dim_region: DataFrame,
) -> DataFrame:
    dims = {"date": dim_date, "source": dim_source, "region": dim_region}
    return _referential({name: _per_id(fact, name) for name in dims}, dims)


def _referential(per_id: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    lost = [
        orphans(per_id[name], dim, f"{name}_id").select(F.lit(name).alias("dim"), "n")
        for name, dim in dims.items()
    ]
    count = lambda name: F.coalesce(F.sum(F.when(F.col("dim") == name, F.col("n"))), F.lit(0))
    totals = reduce(DataFrame.unionByName, lost).agg(*[count(name).alias(name) for name in dims])
    parts = [x for name in dims for x in (F.lit(f"{name}="), F.col(name), F.lit(", "))][:-1]
    return _report(
        totals, "1-referential", sum(F.col(name) for name in dims),
        F.lit("every id has its dimension row"),
        F.concat(F.lit("facts without a dimension row: "), *parts),
    )


def check_row_count(
    fact: DataFrame, raw_rows: DataFrame, months: DataFrame | None = None,
) -> DataFrame:
    """``raw_rows``: a one-row table with the column ``raw_rows``.

    ``months`` (year, month) limits the facts to the months that came from those rows.
    """
    if months is not None:
        fact = fact.join(months.select("year", "month").distinct(), ["year", "month"], "left_semi")
    return _row_count(fact.agg(F.count(F.lit(1)).alias("rows")), raw_rows)


def _row_count(rows: DataFrame, raw_rows: DataFrame) -> DataFrame:
    counted = rows.withColumn("raw", raw_rows.select("raw_rows").scalar())
    text = F.concat(F.col("rows"), F.lit(" facts of "), F.col("raw"), F.lit(" rows read"))
    return _report(
        counted, "2-row-count", F.greatest(F.col("rows") - F.col("raw"), F.lit(0)), text, text)


def check_primary_key(dim: DataFrame, name: str, key: str) -> DataFrame:
    counted = dim.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("dups"))
    return _report(
        counted, f"3-primary-key/{name}", F.col("dups"),
        F.lit("each id once"), F.concat(F.lit("ids too many: "), F.col("dups")),
    )


def check_partitions(fact: DataFrame, dim_date: DataFrame, partitions: DataFrame) -> DataFrame:
    """Every month the facts' dates fall in must be a partition (``year``, ``month``)."""
    return _partitions(_per_id(fact, "date"), dim_date, partitions)


def _partitions(per_date: DataFrame, dim_date: DataFrame, partitions: DataFrame) -> DataFrame:
    months = (
        per_date.join(dim_date.select("date_id", "anio", "mes"), "date_id")
        .groupBy(F.col("anio").alias("year"), F.col("mes").alias("month")).agg(F.sum("n").alias("n"))
    )
    present = partitions.select("year", "month").distinct().withColumn("present", F.lit(1))
    counted = months.join(present, ["year", "month"], "left").agg(
        F.count(F.lit(1)).alias("months"), F.count_if(F.col("present").isNull()).alias("missing"))
    return _report(
        counted, "4-partitions", F.col("missing"),
        F.concat(F.lit("months found on disk: "), F.col("months")),
        F.concat(F.lit("months not on disk: "), F.col("missing")),
    )


def check_unique_articles(fact: DataFrame) -> DataFrame:
    return _unique_articles(fact.agg((F.count(F.lit(1)) - F.count_distinct("article_id")).alias("dups")))


def _unique_articles(counted: DataFrame) -> DataFrame:
    return _report(
        counted, "5-unique-articles", F.col("dups"),
        F.lit("each article once"), F.concat(F.lit("articles too many: "), F.col("dups")),
    )


def check_warehouse(
    fact: DataFrame, dim_date: DataFrame, dim_source: DataFrame, dim_region: DataFrame,
    raw_rows: DataFrame, partitions: DataFrame | None = None, months: DataFrame | None = None,
) -> DataFrame:
    """All checks, one row each."""
    return reduce(DataFrame.unionByName, [
        check_referential(fact, dim_date, dim_source, dim_region),
        check_row_count(fact, raw_rows, months),
        check_primary_key(dim_date, "dim_date", "date_id"),
        check_primary_key(dim_source, "dim_source", "source_id"),
        check_primary_key(dim_region, "dim_region", "region_id"),
        check_partitions(fact, dim_date, fact if partitions is None else partitions),
        check_unique_articles(fact),
    ])


def fold_checks(
    stats: DataFrame, repeats: DataFrame, dim_date: DataFrame, dim_source: DataFrame,
    dim_region: DataFrame, raw_rows: DataFrame, partitions: DataFrame, months: DataFrame,
) -> DataFrame:
    """The report of ``check_warehouse`` from what is kept of every month, without the facts.

    ``stats``: rows of ``part_stats`` of all months. ``repeats`` (article_id, year, month,
    other_year, other_month): articles that two months hold.
    """
    dims = {"date": dim_date, "source": dim_source, "region": dim_region}
    recent = stats.join(months.select("year", "month").distinct(), ["year", "month"], "left_semi")
    place = lambda y, m: F.struct(F.col(y).alias("year"), F.col(m).alias("month"))
    ends = F.explode(F.array(place("year", "month"), place("other_year", "other_month"))).alias("at")
    # An article in so many months has one fact less than that too many.
    held = repeats.select("article_id", ends).distinct().groupBy("article_id").agg(
        (F.count(F.lit(1)) - 1).alias("n"))
    over = held.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return reduce(DataFrame.unionByName, [
        _referential({name: part_stats.per_id(stats, name) for name in dims}, dims),
        _row_count(part_stats.total(recent, "rows").select(F.col("n").alias("rows")), raw_rows),
        check_primary_key(dim_date, "dim_date", "date_id"),
        check_primary_key(dim_source, "dim_source", "source_id"),
        check_primary_key(dim_region, "dim_region", "region_id"),
        _partitions(part_stats.per_id(stats, "date"), dim_date, partitions),
        _unique_articles(part_stats.total(stats, "copies").select(
            (F.col("n") + over.select("n").scalar()).alias("dups"))),
    ])


def all_passed(report: DataFrame) -> bool:
    return bool(report.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("ok")).first()["ok"])
