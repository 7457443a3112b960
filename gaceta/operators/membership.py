"""A Bloom filter as a table of words of bits: which values may be among those it was made of.

Values are dealt into buckets; each has a filter of its own, ``words`` longs of 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta import session

FILTER_SCHEMA = "bucket int, word int, bits long"
# A filter above this many bytes of row data is not broadcast.
FILTER_BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class IndexParams:
    """Sizes of an index, fixed when it is begun. The defaults suit some ten million values.

    About ten bits per value let one in a hundred unknown values pass the filter.
    """

    buckets: int = 64
    words: int = 1 << 15
    probes: int = 4


def bucket(value: Column, params: IndexParams) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(params.buckets)).cast("int")


def _probes(values: DataFrame, name: str, params: IndexParams) -> DataFrame:
    """The columns of ``values``, bucket, and per probe the word and the bit it falls on."""
    size = params.words * 64
    # Double hashing: the i-th place is first + i * step.
    step = F.xxhash64(name, F.lit(2)).bitwiseOR(F.lit(1))
    place = F.pmod(F.pmod(F.xxhash64(name, F.lit(1)), F.lit(size)) + F.col("_i") * F.pmod(step, F.lit(size)), F.lit(size))
    probed = values.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(params.probes - 1))))
    placed = probed.withColumn("_place", place)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_place") % 64).cast("int"))
    return placed.select(
        *values.columns, bucket(F.col(name), params).alias("bucket"),
        F.floor(F.col("_place") / 64).cast("int").alias("word"), one.alias("bit"))


def make_filter(values: DataFrame, name: str, params: IndexParams) -> DataFrame:
    """FILTER_SCHEMA of the values; filters of parts add up by ``merge_filters``."""
    return _probes(values.select(name), name, params).groupBy("bucket", "word").agg(
        F.bit_or("bit").alias("bits"))


def merge_filters(filters: DataFrame) -> DataFrame:
    return filters.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))


def maybe_members(values: DataFrame, name: str, filters: DataFrame, params: IndexParams) -> DataFrame:
    """(name, bucket) of the distinct values that the filter does not rule out.

    ``filters`` is a materialised table with one row per word. Values that are members are
    all there. Without a value's word in the table none of its bits is set. Hashes spread the
    places of distinct values evenly over the words, so no task gets a hot one.
    """
    distinct = values.select(name).where(F.col(name).isNotNull()).distinct()
    probes = _probes(distinct, name, params)
    small = session.fits_broadcast(filters, FILTER_BROADCAST_BYTES)
    met = probes.join(filters.hint("broadcast" if small else "merge"), ["bucket", "word"])
    met = met.where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    return met.groupBy(name, "bucket").agg(F.count(F.lit(1)).alias("_met")).where(
        F.col("_met") == params.probes).select(name, "bucket")
