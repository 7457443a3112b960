"""Result files: line-oriented text, the per-region report, CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta.functions.dates import two_digit_month


def _fixed(value: Column, digits: int) -> Column:
    """Fixed number of decimals, rounded from the exact binary value, ties to even."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def top_terms_lines(top: DataFrame) -> DataFrame:
    """``2023-01, chile, 23214`` in order of month and rank."""
    month = F.concat_ws("-", "year", two_digit_month(F.col("month")))
    return top.orderBy("year", "month", "rank").select(
        F.concat_ws(", ", month, "term", F.col("n").cast("string")).alias("value"))


def region_lines(words: DataFrame) -> DataFrame:
    """A heading, one indented line per word and a blank line for every region."""
    line = F.format_string(
        "  %s: regional=%d, global=%d, ratio=%s",
        "word", "regional_n", "global_n", _fixed(F.col("ratio"), 4))
    body = words.select("region_id", "rank", line.alias("value"))
    regions = words.select("region_id", "region_name").distinct()
    edges = regions.select("region_id", F.explode(F.array(
        F.struct(F.lit(0).alias("rank"), F.concat(F.lit("Región: "), "region_name").alias("value")),
        F.struct(F.lit(2**31 - 1).alias("rank"), F.lit("").alias("value")),
    )).alias("e")).select("region_id", "e.*")
    return body.unionByName(edges).orderBy("region_id", "rank").select("value")


def global_table(global_counts: DataFrame) -> DataFrame:
    return global_counts.select(F.col("word").alias("palabra"), F.col("n").alias("f_g"))


def kl_table(kl: DataFrame) -> DataFrame:
    return kl.orderBy(F.desc("kl"), "source").select(
        F.col("source").alias("fuente"), _fixed(F.col("kl"), 6).alias("kl_divergencia"))


def peaks_table(peaks: DataFrame, window: int = 7) -> DataFrame:
    return peaks.orderBy("fecha").select(
        "fecha",
        F.col("n").alias("articulos"),
        _fixed(F.col("moving_avg"), 1).alias(f"promedio_movil_{window}d"),
        F.concat(_fixed(F.col("factor"), 2), F.lit("x")).alias("factor"),
    )


def series_table(series: DataFrame, window: int = 7) -> DataFrame:
    average = F.when(F.col("moving_avg").isNotNull(), _fixed(F.col("moving_avg"), 1))
    return series.orderBy("fecha").select(
        "fecha",
        F.col("n").alias("articulos"),
        F.coalesce(average, F.lit("")).alias(f"promedio_movil_{window}d"),
        "es_peak",
    )


def write_text(lines: DataFrame, path: str) -> None:
    """Part files keep the order of ``lines``."""
    lines.write.mode("overwrite").text(path)


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
