"""Bounded samples of labelled rows, the same ones on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_texts(
    docs: DataFrame, labels: DataFrame, targets: dict[str, Column], usable: Column, rows: int,
    seed: int = 11,
) -> DataFrame:
    """(doc_id, text, targets...) of at most ``rows`` ids, the first by a hash of the id.

    ``usable`` and ``targets`` are expressions over ``labels``. An id that is labelled more
    than once takes the smallest value of each target. Ids and their labels are few enough to
    be broadcast, since ``rows`` bounds them; texts are read whole. Of rows that share a
    chosen id the smallest text counts, so no more rows than ids come out.
    """
    chosen = (
        labels.where(usable & F.col("doc_id").isNotNull())
        .select("doc_id", *[c.cast("int").alias(n) for n, c in targets.items()])
        .groupBy("doc_id").agg(*[F.min(n).alias(n) for n in targets])
        .na.drop().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), *[F.min(n).alias(n) for n in targets])
