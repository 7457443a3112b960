"""An article table made from the driver's ``documents``: the same rows in Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# doc_id % 6 -> place named in the title (none for 5).
PLACES = ("Valparaíso", "Región de Los Ríos", "Ñuble y Temuco", "O'Higgins", "Santiago")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def article_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles with missing keys, repeats and bad dates, ``_seq`` being the doc id.

    Queries that read keys only do not read the texts: unused columns are pruned.
    """
    doc = F.col("doc_id")
    rest = lambda n: doc % n
    place = F.when(rest(6) == 0, PLACES[0])
    for i, name in enumerate(PLACES[1:], start=1):
        place = place.when(rest(6) == i, name)
    day = F.date_format(
        F.date_add(F.lit("2023-01-01").cast("date"), rest(1096).cast("int")), "yyyy-MM-dd")
    copied = F.when(rest(50) == 7, doc - 1).otherwise(doc)
    return documents(spark, sf_dir).select(
        F.when(rest(97) != 0, copied.cast("string")).alias("article_id"),
        F.when(rest(83) != 0, F.when(rest(89) == 0, "2023-02-30").otherwise(day))
        .alias("publish_date"),
        F.when(rest(101) != 0, F.when(rest(2) == 0, F.upper("source")).otherwise(F.col("source")))
        .alias("source"),
        F.concat_ws(" ", F.substring("text", 1, 60), place).alias("title"),
        F.col("text").alias("body"),
        doc.alias("_seq"),
    )


_PLACE_SQL = " ".join(
    f"when {i} then '{name.replace(chr(39), chr(39) * 2)}'" for i, name in enumerate(PLACES))

ARTICLES_SQL = f"""
articles as (
  select
    case when doc_id % 97 <> 0 then
      cast(case when doc_id % 50 = 7 then doc_id - 1 else doc_id end as varchar) end as article_id,
    case when doc_id % 83 <> 0 then
      case when doc_id % 89 = 0 then '2023-02-30'
           else strftime(date '2023-01-01' + cast(doc_id % 1096 as integer), '%Y-%m-%d') end
    end as publish_date,
    case when doc_id % 101 <> 0 then
      case when doc_id % 2 = 0 then upper(source) else source end end as source,
    concat_ws(' ', substring(text, 1, 60), case doc_id % 6 {_PLACE_SQL} end) as title,
    text as body,
    doc_id as _seq
  from documents)"""
