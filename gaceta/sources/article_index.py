"""Which articles the warehouse holds, and in which month: looked up without reading the fact's text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaceta import session
from gaceta.operators import membership
from gaceta.operators.membership import IndexParams
from gaceta.sources.warehouse import PartStore, Part, Warehouse

KEYS = "article_id string, bucket int"
REPEATS = "article_id string, other_year int, other_month int, other_run string"


class ArticleIndex:
    """Article ids of the fact's parts, dealt into hash buckets, with a Bloom filter in front.

    A lookup asks the filter first. What it does not rule out, the ids that are there and
    about one in a hundred others, is joined exactly with the buckets these fall into; files
    of other buckets are not read.
    """

    def __init__(self, spark: SparkSession, root: str, params: IndexParams):
        self.spark, self.params = spark, params
        size = f"{params.buckets}-{params.words}-{params.probes}"
        # Indexes of other sizes are others: a filter is of no use with different probes.
        self.store = PartStore(spark, f"{root}/article_index/{size}")

    def update(self, house: Warehouse, parts: list[Part]) -> None:
        """Take in the parts of a warehouse that are not indexed yet; only their ids are read.

        Ids that another part holds as well are noted as repeats.
        """
        fresh = self.store.missing(parts)
        if not fresh:
            return
        known = [p for p in parts if p not in fresh]
        ids = session.materialize(house.fact(self.spark, parts=fresh).select("article_id", "year", "month"))
        rows = ids.where("article_id is not null").withColumn(
            "bucket", membership.bucket(F.col("article_id"), self.params))
        self.store.add(fresh, {
            "keys": rows.repartition("bucket"),
            "filter": membership.make_filter(ids.where("article_id is not null"), "article_id", self.params),
            "repeats": self._repeats(ids, fresh, known),
        }, by={"keys": "bucket"})

    def _repeats(self, ids: DataFrame, fresh: list[Part], known: list[Part]) -> DataFrame:
        """(article_id, year, month, other_*) of ids in a fresh part and another one."""
        elsewhere = self.find(ids, known).select(
            "article_id", F.col("year").alias("other_year"), F.col("month").alias("other_month"),
            F.col("fact_run").alias("other_run"))
        met = ids.distinct().join(elsewhere, "article_id")
        # Months of one id among the fresh parts: the first stands for them all.
        month = F.struct("year", "month")
        several = ids.groupBy("article_id").agg(F.min(month).alias("least"), F.max(month).alias("most")) \
            .where("article_id is not null and least <> most").select("article_id", "least")
        names = self.spark.createDataFrame(
            [(p.year, p.month, p.run) for p in fresh], "other_year int, other_month int, other_run string")
        among = ids.distinct().join(several, "article_id").where(month != F.col("least")).select(
            "article_id", "year", "month", F.col("least.year").alias("other_year"),
            F.col("least.month").alias("other_month")).join(F.broadcast(names), ["other_year", "other_month"])
        return met.unionByName(among)

    def find(self, ids: DataFrame, parts: list[Part]) -> DataFrame:
        """(article_id, year, month, fact_run) of the ids that ``parts``, all indexed, hold."""
        if not parts:
            return self.spark.createDataFrame([], f"article_id string, {PartStore.DONE}")
        filters = session.materialize(membership.merge_filters(
            self.store.read_whole("filter", membership.FILTER_SCHEMA, parts)))
        maybe = session.materialize(membership.maybe_members(ids, "article_id", filters, self.params))
        # At most as many as there are buckets.
        buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]
        keys = self.store.read("keys", KEYS, parts).where(F.col("bucket").isin(buckets))
        if session.fits_broadcast(maybe):
            maybe = F.broadcast(maybe)
        return keys.join(maybe, ["bucket", "article_id"], "left_semi").select(
            "article_id", "year", "month", "fact_run").distinct()

    def repeats(self, parts: list[Part]) -> DataFrame:
        """(article_id, year, month, fact_run, other_*) of ids in two of the parts."""
        live = self.spark.createDataFrame(
            [(p.year, p.month, p.run) for p in parts], "other_year int, other_month int, other_run string")
        rows = self.store.read("repeats", REPEATS, parts)
        return rows.join(F.broadcast(live), ["other_year", "other_month", "other_run"], "left_semi")
