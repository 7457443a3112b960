"""Quality rules per document, and verdicts on the hosts whose documents keep failing them.

Built-in expressions only. Every text is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta import session
from gaceta.llm import columns, shrinkage

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class HostRuleParams:
    min_words: int = 10
    # Failed: more than this share of the words lies in repeated windows (per cent).
    max_repeat_percent: int = 20
    # A host is rejected when its failure rate exceeds this, by ``z`` posterior deviations.
    max_host_rate: float = 0.5
    z: float = 1.645


def repeated_window_words(words: Column) -> Column:
    """Number of words inside 5-word windows that occur twice or more in the array.

    Window hashes show in one pass whether anything can repeat at all; equal windows have
    equal hashes, so nothing is missed. Only then are the windows themselves sorted, so
    equal hashes of different windows do not count.
    """
    def window_hash(w: Column) -> Column:
        at = lambda i, j: F.get(w, i + j)
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[at(i, j) for j in range(WINDOW)]))

    def positions(w: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.struct(
                F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("s"), i.alias("i")))
        return columns.let(F.sort_array(pairs), same_as_neighbour)

    def same_as_neighbour(pairs: Column) -> Column:
        text = lambda i: F.get(pairs, i).getField("s")
        twice = F.filter(pairs, lambda p, i: F.coalesce(
            (p.getField("s") == text(i - 1)) | (p.getField("s") == text(i + 1)),
            p.getField("s") == text(i - 1), p.getField("s") == text(i + 1), F.lit(False)))
        return F.sort_array(F.transform(twice, lambda p: p.getField("i")))

    def covered(at: Column) -> Column:
        """Words under windows that start at the ascending positions ``at``."""
        steps = F.zip_with(
            F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1),
            lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.when(F.size(at) == 0, 0).otherwise(
            F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step))

    repeats = lambda hashes: F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(
        F.size(words) <= WINDOW, 0
    ).when(
        columns.let(window_hash(words), repeats), columns.let(positions(words), covered)
    ).otherwise(0).cast("long")


def document_rules(docs: DataFrame, params: HostRuleParams = HostRuleParams()) -> DataFrame:
    """(doc_id, host, counts, base_failed) for every row; a null text has no words.

    ``host`` is the column ``source``; rows without one share the empty host.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(columns.WORD))

    def counted(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_window_words(w).alias("n_repeat_words"),
        )

    stats = docs.select(
        "doc_id",
        F.coalesce(F.col("source"), F.lit("")).alias("host"),
        columns.let(columns.words(text), counted).alias("c"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        columns.let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
        .alias("n_dup_lines"),
    )
    failed = (F.col("c.n_words") < params.min_words) | (
        100 * F.col("c.n_repeat_words") > params.max_repeat_percent * F.col("c.n_words"))
    return stats.select(
        "doc_id", "host", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines",
        "c.n_repeat_words", failed.alias("base_failed"))


def host_verdicts(rules: DataFrame, params: HostRuleParams = HostRuleParams()) -> DataFrame:
    """(host, host_rate_bound, host_rejected) from the failures of all its documents."""
    hosts = rules.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("k"))
    mean, strength = shrinkage.beta_prior(hosts, "n", "k")
    bound = shrinkage.lower_bound(F.col("n"), F.col("k"), mean, strength, params.z)
    return hosts.select(
        "host", F.round(bound, 6).alias("host_rate_bound"),
        (bound > params.max_host_rate).alias("host_rejected"))


def host_quality(docs: DataFrame, params: HostRuleParams = HostRuleParams()) -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed`` and ``kept``.

    ``kept`` is false for documents that fail the rules themselves and for all documents
    of a rejected host. Null and empty texts have no words and fail. Repeated rows are
    counted and returned one by one; an empty table gives an empty result; other columns
    than doc_id, text and source are neither read nor returned.
    """
    rules = session.materialize(document_rules(docs, params))
    verdicts = session.materialize(host_verdicts(rules, params))
    judged = session.lookup_join(rules, verdicts, "host", spread="doc_id")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"),
        "host_rate_bound")
