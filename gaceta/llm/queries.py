"""One registered query per operator: production parameters over the whole intended table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaceta.llm import (
    bpe, columns, decontaminate, divergence, host_rules, langmix, mixing, pseudonyms, quality,
    radix_dedup, simhash, toxicity, url_reputation, vector_codes,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """The classifier as the query and the pipeline fit it: not on rows of remainder 2."""
    learnable = columns.remainder(F.col("doc_id"), 4) != 2
    return quality.fit(docs, table(spark, sf_dir, "labels"), learnable)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    params = quality.QualityParams()
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), params, keep=["doc_id"])
    return scored.select(
        "doc_id", (columns.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page url; a page is bad where the label of its id says quality 0."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return url_reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes)


def tokenizer_file() -> str:
    """Path of the vocabulary that the encoding query and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file())


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A key for tests; production passes its own secret.
    return pseudonyms.pseudonymise(docs, pseudonyms.PseudonymParams(key="gaceta-pseudonyms"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.NARROW)
    digits = F.lpad(F.lower(F.hex("f0")), 16, "0")
    return linked.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents whose remainder modulo 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = columns.remainder(F.col("doc_id"), 5)
    found = langmix.identify(docs, langmix.fit(docs, fold != 0))
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = columns.ascii_lower(F.coalesce("text", F.lit("")))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.sha2(text.cast("binary"), 256).alias("text_sha256"))
    return radix_dedup.exact_duplicates(docs).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_quality(table(spark, sf_dir, "documents"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = vector_codes.compress(embeddings)
    numbers = ",".join(map(str, books.ravel().tolist()))
    return vector_codes.label_errors(coded).select(
        "row.vec_id", "code", "error", "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality, op2_url_filters, op3_bpe, op4_pseudonyms, op5_simhash, op6_language,
        op7_exact_dedup, op8_toxicity, op9_mix_sources, op10_host_rules, op11_decontaminate,
        op12_divergence, op13_vector_codes)}
