"""Surrogate keys: distinct values in first-seen order, dense ids, dimensions, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaceta import session
from gaceta.functions import dates
from gaceta.params import MISSING_ID, REGION_ATTRIBUTES, RegionParams
from gaceta.schema import REGION_SCHEMA

# Positions per numbering block: a block holds at most this many values.
BLOCK_BITS = 24


def first_seen(df: DataFrame, value: Column, name: str, seq: str = "_seq") -> DataFrame:
    """Distinct non-null values with the position of their first row."""
    return (
        df.select(value.alias(name), seq)
        .where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.min(seq).alias("first_seq"))
    )


def dense_ids(
    values: DataFrame, id_name: str, seq: str = "first_seq", after: int = 0,
) -> DataFrame:
    """Number rows after+1, after+2, ... by a unique long ``seq``, not sorting all in one task.

    Rows are numbered inside blocks of consecutive positions. Only the block sizes (one
    short row per 2**24 positions) are summed up in order on one task.
    """
    blocked = values.withColumn("_block", F.shiftright(seq, BLOCK_BITS))
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
        .select("_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(W.partitionBy("_block").orderBy(seq))
    return (
        blocked.withColumn("_inside", inside)
        .join(offsets, "_block")
        .select(
            (F.col("_offset") + F.col("_inside") + after).cast("int").alias(id_name),
            *[c for c in values.columns if c != seq],
        )
    )


def new_keys(found: DataFrame, value: str, id_name: str, known: DataFrame | None) -> DataFrame:
    """(id, value) of the ``first_seen`` values that ``known`` (id, value) lacks.

    They are numbered from the highest id ever given, so ids never change their meaning.
    """
    if known is None:
        return dense_ids(found, id_name)
    last = known.agg(F.max(id_name).alias("last")).first()["last"] or 0
    fresh = found.join(known.select(value), value, "left_anti")
    return dense_ids(fresh, id_name, after=last)


def date_keys(raw: DataFrame, canonical: bool = True, known: DataFrame | None = None) -> DataFrame:
    """(date_id, fecha) for every date text, also those no calendar knows."""
    key = dates.date_key(F.col("publish_date"), canonical)
    return new_keys(first_seen(raw, key, "fecha"), "fecha", "date_id", known)


def source_keys(raw: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(source_id, source) for every publisher, lower-cased."""
    return new_keys(first_seen(raw, F.lower("source"), "source"), "source", "source_id", known)


def dim_date(keys: DataFrame) -> DataFrame:
    """Calendar attributes of the keys that are dates; the other ids stay unused."""
    day = F.col("_day")
    return (
        keys.withColumn("_day", dates.parse_day(F.col("fecha")))
        .where(day.isNotNull())
        .select(
            "date_id",
            "fecha",
            F.year(day).alias("anio"),
            F.month(day).alias("mes"),
            F.dayofmonth(day).alias("dia"),
            dates.weekday_name(day).alias("dia_semana"),
            F.weekofyear(day).alias("semana_anio"),
        )
    )


def dim_source(keys: DataFrame) -> DataFrame:
    return keys.select("source_id", "source")


def region_ids(params: RegionParams, known: dict[str, int] | None = None) -> dict[str, int]:
    """Ids of a gazetteer's regions, the default label included.

    A name that is ``known`` keeps its id; others are numbered in order from the highest id
    ever given, so an id never changes its meaning, also if a region goes and comes back.
    """
    known = known or {}
    last = max(known.values(), default=0)
    fresh = [name for name in params.ids if name not in known]
    given = known | {name: last + i for i, name in enumerate(fresh, start=1)}
    return {name: given[name] for name in params.ids}


def dim_region(
    spark: SparkSession, params: RegionParams = RegionParams(), ids: dict[str, int] | None = None,
) -> DataFrame:
    """One row per gazetteer region, the default label last."""
    rows = [
        (i, name, *REGION_ATTRIBUTES.get(name, ("", "")))
        for name, i in (params.ids if ids is None else ids).items()
    ]
    return spark.createDataFrame(rows, REGION_SCHEMA)


def lookup_ids(
    rows: DataFrame, keys: DataFrame, on: str, id_name: str, seq: str = "_seq",
    default: int = MISSING_ID,
) -> DataFrame:
    """Attach a dimension id by value; rows without a match get ``default``."""
    joined = session.lookup_join(rows, keys.select(on, id_name), on, spread=seq)
    return joined.withColumn(id_name, F.coalesce(id_name, F.lit(default)).cast("int"))
