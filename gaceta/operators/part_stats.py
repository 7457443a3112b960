"""What the checks need to know of a month of facts, small enough to be kept and added up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = ("date", "source", "region")
MONTH = ["year", "month"]
STATS = "kind string, id int, n long, least string, most string"


def part_stats(fact: DataFrame) -> DataFrame:
    """(year, month, kind, id, n, least, most), in two scans of narrow columns.

    Kinds ``date``, ``source``, ``region``: facts per dimension id. Kind ``rows``: facts, with
    the least and the largest article id. Kind ``copies``: facts beyond one per article id.
    """
    each = F.explode(F.array(*[
        F.struct(F.lit(dim).alias("kind"), F.col(f"{dim}_id").alias("id")) for dim in DIMS])).alias("e")
    per_id = fact.select(*MONTH, each).groupBy(*MONTH, "e.kind", "e.id").agg(F.count(F.lit(1)).alias("n")) \
        .select(*MONTH, "kind", "id", "n", *[F.lit(None).cast("string").alias(c) for c in ("least", "most")])
    per_month = fact.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("article_id").alias("articles"),
        F.min("article_id").alias("least"), F.max("article_id").alias("most"))
    whole = lambda kind, n: per_month.select(
        *MONTH, F.lit(kind).alias("kind"), F.lit(None).cast("int").alias("id"), n.alias("n"), "least", "most")
    return reduce(DataFrame.unionByName, [
        per_id, whole("rows", F.col("rows")), whole("copies", F.col("rows") - F.col("articles"))])


def per_id(stats: DataFrame, dim: str) -> DataFrame:
    """(<dim>_id, n): the facts of every id, over all months."""
    own = stats.where(F.col("kind") == dim)
    return own.groupBy(F.col("id").alias(f"{dim}_id")).agg(F.sum("n").alias("n"))


def total(stats: DataFrame, kind: str) -> DataFrame:
    """One row: n."""
    return stats.where(F.col("kind") == kind).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
