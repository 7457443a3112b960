"""Language identification by mixtures: which languages a text is made of, and in what shares.

Each word is taken to come from one language, with the probability that the language's
letter trigrams give it. Expectation-maximisation finds the shares of the languages in a
text; the set of languages is the one of highest penalised likelihood.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta import session
from gaceta.llm.ngrams import word_ngrams

# Letters, and 1151 numerals and the like that are told apart afterwards.
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
REMEMBERED = 1 << 18
# Numbers in the table of words seen before: words times languages.
REMEMBERED_NUMBERS = 1 << 22


@dataclass(frozen=True)
class LanguageParams:
    buckets: int = 1 << 15
    smoothing: float = 0.5
    # A further language must raise the log-likelihood by this, times log(1 + words).
    penalty: float = 3.0
    iterations: int = 50
    tolerance: float = 1e-4
    # More distinct languages than this are refused: such a column names something else.
    max_languages: int = 256


def word_trigrams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of lower-case words, borders marked, and whose they are."""
    return word_ngrams(words, (3,), buckets, " ", " ")


def text_words(text: str) -> list[str]:
    """Runs of letters (general category L), lower-cased."""
    found = LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    # languages x buckets: log-probabilities of the trigrams.
    logs: np.ndarray


def trigram_counts(
    docs: DataFrame, usable: Column, params: LanguageParams = LanguageParams(),
) -> DataFrame:
    """(lang, bucket, n) over all usable rows with a language.

    Tasks add up their words first, a bounded number at a time, and then their trigrams.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter[str]] = defaultdict(Counter)
        sums: dict[str, np.ndarray] = {}

        def fold() -> None:
            for lang, counts in words.items():
                total = sums.setdefault(lang, np.zeros(params.buckets, np.int64))
                n = np.fromiter(counts.values(), np.float64, len(counts))
                buckets, owner = word_trigrams(list(counts), params.buckets)
                total += np.bincount(buckets, n[owner], params.buckets).astype(np.int64)
            words.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                words[lang].update(text_words(text.as_py()))
                if sum(map(len, words.values())) > REMEMBERED:
                    fold()
        fold()
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                ["lang", "bucket", "n"])

    learnable = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = learnable.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame, usable: Column, params: LanguageParams = LanguageParams(),
) -> LanguageModel:
    """The model of all languages that occur in usable rows.

    To the driver comes one row per language with at most ``buckets`` sums in it, however
    many rows there are. More than ``max_languages`` languages are an error, raised before
    anything is sent.
    """
    sums = session.materialize(trigram_counts(docs, usable, params))
    found = sums.select("lang").distinct().count()
    if found > params.max_languages:
        raise ValueError(
            f"column lang has {found} values, more than max_languages={params.max_languages}")
    per_language = sums.groupBy("lang").agg(
        F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("n"))
    table = per_language.toArrow().sort_by("lang")
    counts = np.full((table.num_rows, params.buckets), params.smoothing)
    for row, buckets, n in zip(counts, table["buckets"], table["n"]):
        row[buckets.values.to_numpy()] += n.values.to_numpy()
    return LanguageModel(
        table["lang"].to_pylist(), np.log(counts / counts.sum(axis=1, keepdims=True)))


class Mixtures:
    """Language sets and shares of texts, with the words seen before at hand."""

    def __init__(self, model: LanguageModel, params: LanguageParams):
        self.model, self.params = model, params
        self.table = np.zeros((0, len(model.languages)))
        self.index: dict[str, int] = {}
        self.room = min(REMEMBERED, REMEMBERED_NUMBERS // max(1, len(model.languages)))

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word (rows) in each language."""
        if len(self.index) > self.room:
            self.index, self.table = {}, self.table[:0]
        new = [w for w in words if w not in self.index]
        if new:
            if len(self.index) + len(new) > len(self.table):
                size = 2 * len(self.table) + len(new)
                self.table = np.vstack(
                    [self.table, np.zeros((size - len(self.table), self.table.shape[1]))])
            buckets, owner = word_trigrams(new, self.params.buckets)
            first = len(self.index)
            for column, logs in enumerate(self.model.logs):
                self.table[first:first + len(new), column] = np.bincount(
                    owner, logs[buckets], len(new))
            self.index.update(zip(new, range(first, first + len(new))))
        return self.table[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]

    def shares(self, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """Shares of the columns of ``p`` that make words (rows, n times each) most likely."""
        share, before, total = np.full(p.shape[1], 1 / p.shape[1]), -np.inf, n.sum()
        for _ in range(self.params.iterations):
            parts = p * share
            mixed = parts.sum(axis=1)
            likelihood = float(n @ np.log(mixed))
            if likelihood - before < self.params.tolerance * total ** 0.5:
                break
            before = likelihood
            share = (n / mixed) @ parts / total
        return share, likelihood

    def mixture(self, text: str) -> dict[str, float]:
        """Language -> share of the chosen set; empty without a letter or a language."""
        counts = Counter(text_words(text))
        if not counts or not self.model.languages:
            return {}
        logs = self.word_logs(list(counts))
        n = np.fromiter(counts.values(), float, len(counts))
        top = logs.max(axis=1)
        p = np.maximum(np.exp(logs - top[:, None]), 1e-30)  # per word, relative to its best
        single = n @ np.log(p)
        chosen, share = [int(np.argmax(single))], np.ones(1)
        likelihood, price = float(single.max()), self.params.penalty * np.log1p(n.sum())
        while len(chosen) < p.shape[1]:
            # What another language can gain at most; the likelihood is concave in shares.
            mixed = p[:, chosen] @ share
            bound = (n / mixed) @ p - n.sum()
            bound[chosen] = -np.inf
            best = None
            for j in np.flatnonzero(bound > price):
                s, found = self.shares(p[:, [*chosen, j]], n)
                if found - likelihood > price and (best is None or found > best[1]):
                    best = s, found, int(j)
            if best is None:
                break
            share, likelihood = best[0], best[1]
            chosen.append(best[2])
        return {self.model.languages[j]: float(s) for j, s in zip(chosen, share)}


def identify(
    docs: DataFrame, model: LanguageModel, params: LanguageParams = LanguageParams(),
) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row.

    ``languages`` maps each language of the chosen set to its share; ``lang_pred`` is the one
    of the largest share (of equal ones, the first by name) and ``score`` that share. A
    null text, and one without a letter, is ``und`` with score 0; so is every text when
    no language was learned. Whole texts are read; rows stay in their tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixtures = Mixtures(shared.value, params)
        for batch in batches:
            found = [mixtures.mixture(t.as_py() or "") for t in batch.column("text")]
            best = [min(m.items(), key=lambda x: (-x[1], x[0]), default=(UNKNOWN, 0.0)) for m in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([b[0] for b in best], pa.string()),
                 pa.array([b[1] for b in best], pa.float64()),
                 pa.array([sorted(m.items()) for m in found], pa.map_(pa.string(), pa.float64()))],
                ["doc_id", "lang_pred", "score", "languages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, languages map<string,double>")
