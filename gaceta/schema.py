"""Column names and types of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = ("article_id", "publish_date", "source", "title", "body")

FACT_SCHEMA = T.StructType([
    T.StructField("article_id", T.StringType()),
    T.StructField("date_id", T.IntegerType()),
    T.StructField("source_id", T.IntegerType()),
    T.StructField("region_id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("title_word_count", T.IntegerType()),
    T.StructField("body_word_count", T.IntegerType()),
    # The gazetteer that placed the article.
    T.StructField("region_version", T.IntegerType()),
])

# Partition columns as they come back from the path ("month=01" reads as 1).
PARTITION_FIELDS = [
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
]

REGION_SCHEMA = T.StructType([
    T.StructField("region_id", T.IntegerType()),
    T.StructField("region_name", T.StringType()),
    T.StructField("n_romano", T.StringType()),
    T.StructField("abreviacion", T.StringType()),
])

TABLE_SCHEMAS: dict[str, T.StructType | str] = {
    "dim_date": "date_id int, fecha string, anio int, mes int, dia int, dia_semana string, semana_anio int",
    "dim_date_keys": "date_id int, fecha string",
    "dim_source": "source_id int, source string",
    "dim_source_keys": "source_id int, source string",
    "dim_region": REGION_SCHEMA,
    "gazetteers": "region_version int, definition string",
    "checks": "check string, passed boolean, violations long, detail string",
    "etl_metrics": "raw_rows long, malformed long, skipped_null long, skipped_dup long, bad_date long, "
                   "written long, padded long, skipped_known long",
    "index_params": "buckets int, words int, probes int",
}
