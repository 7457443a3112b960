"""Raw article files: CSV in, one landed Parquet table out."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaceta import session
from gaceta.operators.clean import null_na_tokens
from gaceta.params import NA_TOKENS
from gaceta.schema import RAW_COLUMNS

# Row-group size of the landed table.
ROW_GROUP_BYTES = 32 << 20
_CORRUPT = "_corrupt"
# Larger files are worth a warning if each is to be read in one task.
LARGE_FILE_BYTES = 1 << 30
# A place in a file is the byte offset of the split + the row number in the task.
_ROW_MASK = (1 << 33) - 1


def _field_count(line: Column) -> Column:
    """Fields of a raw CSV line; commas inside quotes do not count."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def scan_articles(
    spark: SparkSession, path: str | list[str], multi_line: bool = True,
    na_tokens: tuple[str, ...] = NA_TOKENS, order_column: str | None = None,
) -> DataFrame:
    """Read article CSVs as text columns plus ``_seq``, ``_over_long`` and ``_padded``.

    The header names the columns; those the warehouse does not use are ignored. A line
    with too few fields is padded with nulls and flagged, one with too many is only flagged.
    ``_seq`` grows with file name and place in the file, or is ``order_column`` as a long,
    which must be there in every row and differ (``require_positions``).

    Quoted line breaks need ``multi_line``, which reads each file in one task: supply
    many files, or set it to False where no field holds a line break and files split.
    """
    if multi_line:
        _warn_of_large_files(spark, path)
    reader = spark.read.option("header", True).option("escape", '"')
    names = reader.option("multiLine", multi_line).csv(path).columns
    lacking = [c for c in RAW_COLUMNS if c not in names]
    if lacking:
        raise ValueError(f"article files lack the columns {lacking}")
    fields = [T.StructField(c, T.StringType()) for c in [*names, _CORRUPT]]
    # With pruning, a line is held against the selected columns only and none is too long.
    scan = spark.read.option("columnPruning", False).csv(
        path, schema=T.StructType(fields), header=True, enforceSchema=False, escape='"',
        multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT,
    )
    fields_found = F.coalesce(_field_count(F.col(_CORRUPT)), F.lit(len(names)))
    rows = scan.select(
        *RAW_COLUMNS,
        (fields_found > len(names)).alias("_over_long"),
        (fields_found < len(names)).alias("_padded"),
        *([F.col(order_column).cast("long").alias("_seq")] if order_column else [
            F.col("_metadata.file_path").alias("_file"),
            (F.col("_metadata.file_block_start")
             + F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))).alias("_offset"),
        ]),
    )
    if not order_column:
        rows = _number_files(rows, path)
    return null_na_tokens(rows, list(RAW_COLUMNS), na_tokens)


def _warn_of_large_files(spark: SparkSession, path: str | list[str]) -> None:
    large = session.list_files(spark, path).where(F.col("bytes") > LARGE_FILE_BYTES).agg(
        F.count(F.lit(1)).alias("files"), F.max("bytes").alias("bytes")).first()
    if large["files"]:
        warnings.warn(
            f"{large['files']} article files are larger than {LARGE_FILE_BYTES >> 20} MB, up to "
            f"{large['bytes'] >> 20} MB, and each will be read in one task; split them, or pass "
            "multi_line=False if no field holds a line break", stacklevel=3)


def _number_files(rows: DataFrame, path: str | list[str]) -> DataFrame:
    """``_seq`` from ``_file`` and ``_offset``: files in order of their names, end to end.

    A file's positions begin where those before it end: each takes its bytes, and as many
    again as one task may have read of other files. The running sum has one short row per
    file; it has no bound on their number. A row of an unlisted file fails the job.
    """
    spark = rows.sparkSession
    spare = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    starts = session.materialize(session.list_files(spark, path).select(
        F.col("file").alias("_file"),
        F.coalesce(F.sum(F.col("bytes") + spare).over(before), F.lit(0))
        .alias("_start")))
    joined = session.lookup_join(rows, starts, "_file", spread="_offset")
    unlisted = F.raise_error(F.concat(F.lit("file not listed: "), F.col("_file"))).cast("long")
    start = F.when(F.col("_start").isNull(), unlisted).otherwise(F.col("_start"))
    return joined.withColumn("_seq", start + F.col("_offset")).drop("_file", "_offset", "_start")


def require_positions(rows: DataFrame, seq: str = "_seq") -> None:
    """Raise unless every row has a position and no two share one."""
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count(seq).alias("placed"),
        F.count_distinct(seq).alias("places")).first()
    if found["rows"] != found["placed"] or found["rows"] != found["places"]:
        raise ValueError(
            f"order column: {found['rows'] - found['placed']} rows without a position, "
            f"{found['placed'] - found['places']} repeat one")


def land_articles(rows: DataFrame, path: str) -> DataFrame:
    """Write the scanned rows as Parquet and read them back; later steps use this copy.

    A file read in one task is written in one task; small row groups let it be read in many.
    """
    rows.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return rows.sparkSession.read.parquet(path)
