"""Column expressions the operators share, and rows carried whole past an operator's own names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word is a run of anything but space and the five ASCII controls that break lines or columns.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(0)),
                      F.array().cast("array<string>"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """The input row as the struct ``row`` next to the operator's own columns.

    Whatever the input columns are called, they cannot clash with names used inside.
    """
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in own.items()])


def unpacked(df: DataFrame, columns: list[str], **own: Column) -> DataFrame:
    """Input columns back at top level; an operator's column replaces one of the same name."""
    return df.select(
        *[df["row"].getField(c).alias(c) for c in columns if c not in own],
        *[c.alias(n) for n, c in own.items()],
    )
