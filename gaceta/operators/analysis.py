"""The four analytical queries, from tidy counts to result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaceta import session
from gaceta.params import QueryParams


# Ranks up to this are cut off in every task by Spark itself (its default threshold).
TASK_RANKS = 1000


def top_per_group(
    counts: DataFrame, groups: list[str], k: int, salts: int = session.SALTS,
) -> DataFrame:
    """The ``k`` most frequent words per group with their rank; ties by word.

    Spark keeps k rows per group in every task before it shuffles, so a group that
    holds most of the rows sends no more of them than any other. It does not do so for a
    large k. Then each group is ranked in ``salts`` pieces first, and only the first k of
    every piece are ranked together.
    """
    rank = lambda *keys: F.row_number().over(
        W.partitionBy(*keys).orderBy(F.desc("n"), F.asc("word")))
    if k > TASK_RANKS:
        salt = F.pmod(F.xxhash64("word"), F.lit(salts))
        pieces = counts.withColumn("_salt", salt).withColumn("_place", rank(*groups, "_salt"))
        counts = pieces.where(F.col("_place") <= k).drop("_salt", "_place")
    # Without columns to group by, all rows are one group.
    return counts.withColumn("rank", rank(*groups)).where(F.col("rank") <= k)


def name_or_id(df: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Attach a dimension's name; an id the dimension lacks shows as ``id=<n>``."""
    fallback = F.concat(F.lit("id="), F.col(key).cast("string"))
    return df.join(dim.select(key, name), key, "left").withColumn(name, F.coalesce(name, fallback))


def top_terms_by_month(monthly: DataFrame, params: QueryParams = QueryParams()) -> DataFrame:
    """(year, month, rank, term, n)"""
    top = top_per_group(monthly, ["year", "month"], params.top_k)
    return top.select("year", "month", "rank", F.col("word").alias("term"), "n")


def frequent_words(global_counts: DataFrame, min_freq: int) -> DataFrame:
    return global_counts.where(F.col("n") >= min_freq).select("word", F.col("n").alias("global_n"))


def words_by_region(
    regional: DataFrame, global_counts: DataFrame, dim_region: DataFrame,
    params: QueryParams = QueryParams(),
) -> DataFrame:
    """(region_id, region_name, rank, word, regional_n, global_n, ratio)"""
    common = regional.join(frequent_words(global_counts, params.min_freq), "word")
    top = top_per_group(common, ["region_id"], params.region_top)
    # At most region_top rows per region and one dimension row per region.
    return name_or_id(top, dim_region, "region_id", "region_name").select(
        "region_id", "region_name", "rank", "word", F.col("n").alias("regional_n"), "global_n",
        (F.col("n") / F.col("global_n")).alias("ratio"),
    )


def kl_by_source(
    by_source: DataFrame, global_counts: DataFrame, dim_source: DataFrame,
    params: QueryParams = QueryParams(),
) -> DataFrame:
    """(source_id, source, kl): divergence of each source's words from all words.

    With p = n/N_s and q = g/N the sum of p*ln(p/q) over frequent words equals
    (sum n*ln(n/g) + ln(N/N_s) * sum n) / N_s, so one grouping after the join gives all.
    Rare words are left out of the sums but count in N_s and N.
    """
    total = global_counts.agg(F.sum("n")).scalar()
    joined = by_source.join(frequent_words(global_counts, params.min_freq), "word", "left")
    n, frequent = F.col("n"), F.col("global_n").isNotNull()
    per_source = joined.groupBy("source_id").agg(
        F.sum(n).alias("_all"),
        F.sum(F.when(frequent, n).otherwise(0)).alias("_frequent"),
        F.sum(F.when(frequent, n * F.log(n / F.col("global_n"))).otherwise(0.0)).alias("_weighted"),
    )
    kl = (F.col("_weighted") + F.log(total / F.col("_all")) * F.col("_frequent")) / F.col("_all")
    return name_or_id(
        per_source.select("source_id", kl.alias("kl")), dim_source, "source_id", "source"
    ).select("source_id", "source", "kl")


def daily_series(daily: DataFrame, params: QueryParams = QueryParams()) -> DataFrame:
    """(fecha, n, moving_avg, es_peak) over the previous ``window`` rows.

    The window has one ordering and no partition: ``daily`` holds one row per calendar
    day (under 4 million for all four-digit years), whatever the number of articles.
    """
    previous = W.orderBy("fecha").rowsBetween(-params.window, -1)
    full = F.count("n").over(previous) == params.window
    averaged = daily.withColumn("moving_avg", F.when(full, F.avg("n").over(previous)))
    peak = F.coalesce(F.col("n") >= F.col("moving_avg") * params.factor, F.lit(False))
    return averaged.select("fecha", "n", "moving_avg", peak.cast("int").alias("es_peak"))


def volume_peaks(daily: DataFrame, params: QueryParams = QueryParams()) -> DataFrame:
    """(fecha, n, moving_avg, factor) of the days that reach ``factor`` times the average."""
    return daily_series(daily, params).where("es_peak = 1").select(
        "fecha", "n", "moving_avg", F.try_divide(F.col("n"), F.col("moving_avg")).alias("factor"))
