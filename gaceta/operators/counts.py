"""Term and article counts, as tidy rows (keys, word, n)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaceta.functions.text import words
from gaceta.params import TokenParams

MONTH = ["year", "month"]
REGION = ["region_id"]
SOURCE = ["source_id"]
GROUPED_SCHEMA = "year int, month int, region_id int, source_id int, word string, n long, level string"
DAY_SCHEMA = "fecha string, n long"
# What is kept of a month: counts by all keys, of which every level is a sum.
MONTH_LEVELS = {"all": [*MONTH, *REGION, *SOURCE]}
LEVELS = {"month": MONTH, "region": REGION, "source": SOURCE, "global": []}
# Counts by all keys that one task sums up on every level; their sums fit its memory.
TASK_SUMS = 1 << 19


def token_rows(
    articles: DataFrame, keys: list[str], params: TokenParams = TokenParams(),
    texts: tuple[str, ...] = ("title", "body"),
) -> DataFrame:
    """One row per term. Each text is cut on its own, so no term spans two of them.

    The words are a column before they become rows: Spark then compiles the rows' part, up to
    their first sums, into one loop. A plain ``explode`` of that column would have Spark cut
    every text a second time, to see beforehand which ones hold no word.
    """
    found = F.concat(*[words(F.col(t), params) for t in texts])
    rows = articles.select(*keys, found.alias("_words")).select(*keys, F.explode_outer("_words").alias("word"))
    rows = rows.where(F.col("word").isNotNull())
    return rows.where(~F.col("word").isin(*params.stop_words)) if params.stop_words else rows


def count_terms(
    articles: DataFrame, keys: list[str], params: TokenParams = TokenParams(),
) -> DataFrame:
    """(keys, word, n); partial sums per task come before the shuffle."""
    rows = token_rows(articles, keys, params)
    return rows.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def resum(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys, "word").agg(F.sum("n").alias("n"))


def grouped_counts(
    articles: DataFrame, params: TokenParams = TokenParams(),
    levels: dict[str, list[str]] = LEVELS,
) -> DataFrame:
    """Term counts on several levels from one pass over the text, told apart by ``level``.

    Words are counted by all keys first. Only these sums, not every word of the text, are
    copied for each level and summed up again.
    """
    keys = [*MONTH, *REGION, *SOURCE]
    finest = count_terms(articles, keys, params)
    if [*levels.values()] == [keys]:
        return finest.select(F.lit([*levels][0]).alias("level"), *keys, "word", "n")
    return _summed(finest, levels)


def _summed(finest: DataFrame, levels: dict[str, list[str]], pieces: int | None = None) -> DataFrame:
    """Sums of counts by all keys on several levels, told apart by ``level``.

    All levels sum up by word, so one shuffle by word serves them all: the copies for each
    level are made and summed after it, where they are. A word has at most one row for
    every combination of keys, however often it is found.
    """
    keys = [*MONTH, *REGION, *SOURCE]
    of_level = lambda i, level: F.struct(F.lit(i).alias("_level"), *[
        (F.col(k) if k in level else F.lit(None).cast("int")).alias(k) for k in keys])
    copies = F.explode(F.array(*[of_level(i, level) for i, level in enumerate(levels.values())]))
    dealt = finest.repartition(pieces, "word") if pieces else finest.repartition("word")
    rows = dealt.select("word", "n", copies.alias("_copy")).select("word", "n", "_copy.*")
    sums = rows.groupBy("_level", *keys, "word").agg(F.sum("n").alias("n"))
    names = F.array(*[F.lit(name) for name in levels])
    return sums.select(F.get(names, F.col("_level")).alias("level"), *keys, "word", "n")


def level_counts(grouped: DataFrame, level: str) -> DataFrame:
    """One of the four counts out of ``grouped_counts``."""
    return grouped.where(F.col("level") == level).select(*LEVELS[level], "word", "n")


def months_summed(monthly: DataFrame) -> DataFrame:
    """``grouped_counts`` of all levels from those of single months on MONTH_LEVELS.

    ``monthly`` is a materialised table; its rows are counted to deal them into tasks.
    """
    return _summed(monthly, LEVELS, pieces=monthly.count() // TASK_SUMS + 1)


def articles_per_day(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """(fecha, n): articles by day; facts whose date has no dimension row are left out.

    Facts are counted per id first, so the join sees one row per day.
    """
    return days_summed(fact.groupBy("date_id").agg(F.count(F.lit(1)).alias("n")), dim_date)


def days_summed(per_id: DataFrame, dim_date: DataFrame) -> DataFrame:
    """(fecha, n) from articles per date id."""
    return (
        per_id.join(dim_date.select("date_id", "fecha"), "date_id")
        .groupBy("fecha").agg(F.sum("n").alias("n"))
    )


def rows_per_day(df: DataFrame, moment: str) -> DataFrame:
    """(fecha, n) of any table by a date or timestamp column."""
    day = F.date_format(F.to_date(moment), "yyyy-MM-dd").alias("fecha")
    return df.where(F.col(moment).isNotNull()).groupBy(day).agg(F.count(F.lit(1)).alias("n"))
