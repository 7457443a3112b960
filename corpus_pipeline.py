"""A training corpus from the ``documents`` table, stage by stage.

Every stage takes null and empty texts, repeated rows, empty tables and further columns, which
it does not pass on; what becomes of such rows stands with the operator it calls.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaceta import session  # noqa: E402
from gaceta.llm import bpe, mixing, quality, queries, radix_dedup, simhash  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, accepts."""
    params = quality.QualityParams()
    scored = quality.score(docs, queries.quality_model(spark, docs, sf_dir), params)
    return scored.where(F.col("score") >= params.threshold).select(*COLUMNS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    return radix_dedup.exact_duplicates(docs).where("kept").select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose 3-word SimHashes are linked at two bits or fewer: the one
    with the smallest doc_id, of rows that share it or have none the smallest digest.

    Rows are told apart by numbers unless their ids do, so a row goes only for its own text.
    """
    rows = docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    named = docs.withColumn("number", F.col("doc_id"))
    if rows["n"] != rows["ids"]:
        digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
        ordered = docs.orderBy(F.asc_nulls_last("doc_id"), digest)
        named = session.materialize(ordered.withColumn("number", F.monotonically_increasing_id()))
    found = simhash.near_duplicates(
        named.select(F.col("number").alias("doc_id"), "text"), simhash.NARROW)
    dropped = session.materialize(
        found.where("doc_id <> component_id").select(F.col("doc_id").alias("number")))
    small = session.fits_broadcast(dropped)
    return named.join(
        dropped.hint("broadcast" if small else "shuffle_hash"), "number", "left_anti").select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources get their target weights; shuffled."""
    return mixing.mix_sources(docs).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its token count and the digests of its ids and of the decoded text."""
    return bpe.digests(docs, queries.tokenizer_file())


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("BPE encoding and decoding", encode_stage),
]

# The classifier is trained, and no SQL has XXH64 or the tokenizer's merges: the tests hold
# every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    What the stages write on the way is deleted, but for the result.
    """
    docs = queries.table(spark, sf_dir, "documents")
    result = session.scratch_path(spark, "corpus")
    with session.job_scratch(spark):
        for _, stage in STAGES[:-1]:
            docs = session.materialize(stage(spark, docs, sf_dir))
        last = STAGES[-1][1](spark, docs, sf_dir)
        last.write.parquet(result)
    return spark.read.schema(last.schema).parquet(result)
