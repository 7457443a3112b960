"""Toxicity by classifier chains: linear models in sequence, each fed by the ones before.

A category's model sees the words of a text and the probabilities of all earlier
categories. Those it is trained with come from models that had not seen the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta.llm import samples

WORDS = re.compile(r"\w+")
REMEMBERED = 1 << 18


@dataclass(frozen=True)
class ToxicityParams:
    # Chain order: toxic in good prose, toxic in a text of low quality, toxic at all. The last
    # decides, and its model sees the probabilities of all before it.
    categories: tuple[str, ...] = ("toxic_prose", "toxic_junk", "toxic")
    # Labelled rows the chain is fitted on, at most.
    train_rows: int = 12000
    buckets: int = 1 << 18
    folds: int = 3
    # L1 penalty, in training rows: how much evidence a word needs to count at all.
    sparsity: float = 1.0
    steps: int = 60


def default_targets() -> dict[str, Column]:
    """The categories of ``ToxicityParams`` as expressions over (quality, toxic)."""
    toxic, good = F.col("toxic") > 0, F.col("quality") > 0
    return {"toxic_prose": toxic & good, "toxic_junk": toxic & ~good, "toxic": toxic}


def word_buckets(text: str, buckets: int) -> np.ndarray:
    """Buckets of the distinct lower-cased words of a text, ascending."""
    found = {crc32(w.encode()) % buckets for w in set(WORDS.findall(text.lower()))}
    return np.fromiter(sorted(found), np.int64, len(found))


class Sparse:
    """Rows of distinct bucket numbers, end to end."""

    def __init__(self, rows: list[np.ndarray], buckets: int):
        self.n, self.buckets = len(rows), buckets
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.at = np.concatenate([*rows, np.zeros(0, np.int64)])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.at], self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, errors[self.row], self.buckets)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_linear(
    x: Sparse, earlier: np.ndarray, y: np.ndarray, rows: np.ndarray, params: ToxicityParams,
) -> np.ndarray:
    """Weights (words, then earlier probabilities, then a constant) of a logistic model.

    Accelerated proximal gradient descent on the mean loss of ``rows``, with an L1 term on
    the words. Steps are scaled by how often a word occurs, so frequent words do not hold
    back rare ones.
    """
    use = np.zeros(x.n)
    use[rows] = 1.0
    n, m = max(1.0, use.sum()), earlier.shape[1]
    often = x.back(use) / n
    scale = 4.0 / np.concatenate([np.sqrt(often + 1 / n) * 8, np.full(m + 1, 16.0)])
    weights = np.zeros(x.buckets + m + 1)
    ahead, speed = weights.copy(), 1.0
    for _ in range(params.steps):
        odds = x.times(ahead[:x.buckets]) + earlier @ ahead[x.buckets:-1] + ahead[-1]
        errors = (sigmoid(odds) - y) * use
        slope = np.concatenate([x.back(errors), earlier.T @ errors, [errors.sum()]]) / n
        new = ahead - scale * slope
        words = new[:x.buckets]
        new[:x.buckets] = np.sign(words) * np.maximum(
            np.abs(words) - scale[:x.buckets] * params.sparsity / n, 0)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - weights)
        weights, speed = new, faster
    return weights


def predict_linear(x: Sparse, earlier: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return sigmoid(x.times(weights[:x.buckets]) + earlier @ weights[x.buckets:-1] + weights[-1])


@dataclass(frozen=True)
class Chain:
    # One weight vector per category, in chain order.
    weights: list[np.ndarray]
    # From this probability of the last category on, a text counts as toxic.
    threshold: float


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where texts not trained on are told apart best (F1), midway to the next one below."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    at = int(np.argmax(f1))
    below = p[order[at + 1]] if at + 1 < len(p) else 0.0
    return float((p[order[at]] + below) / 2)


def fit_chain(rows: list[np.ndarray], targets: np.ndarray, params: ToxicityParams) -> Chain:
    """The chain for ``targets`` (rows x categories)."""
    x = Sparse(rows, params.buckets)
    fold = np.arange(x.n) % params.folds
    earlier, weights = np.zeros((x.n, 0)), []
    for j in range(targets.shape[1]):
        y, held_out = targets[:, j].astype(float), np.zeros(x.n)
        for k in range(params.folds):
            part = fit_linear(x, earlier, y, np.flatnonzero(fold != k), params)
            held_out[fold == k] = predict_linear(x, earlier, part)[fold == k]
        weights.append(fit_linear(x, earlier, y, np.arange(x.n), params))
        earlier = np.column_stack([earlier, held_out])
    return Chain(weights, best_threshold(earlier[:, -1], targets[:, -1]))


class ChainScorer:
    """Probabilities of all categories for texts, one after the other."""

    def __init__(self, chain: Chain, params: ToxicityParams):
        self.params = params
        self.words = np.stack([w[:params.buckets] for w in chain.weights])
        self.rest = [w[params.buckets:] for w in chain.weights]
        # Only words that bear on some category need adding up.
        self.bears = self.words.any(axis=0)
        self.known: dict[str, int] = {}

    def probabilities(self, text: str) -> list[float]:
        distinct = set(WORDS.findall(text.lower()))
        if len(self.known) > REMEMBERED:
            self.known = {}
        for word in distinct.difference(self.known):
            bucket = crc32(word.encode()) % self.params.buckets
            self.known[word] = bucket if self.bears[bucket] else -1
        found = sorted(set(map(self.known.__getitem__, distinct)) - {-1})
        sums = self.words[:, found].sum(axis=1)
        out: list[float] = []
        for total, rest in zip(sums, self.rest):
            out.append(float(sigmoid(total + np.dot(rest[:-1], out) + rest[-1])))
        return out


def fit(
    docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(),
    targets: dict[str, Column] | None = None, usable: Column | None = None,
) -> Chain | None:
    """The chain, fitted on at most ``train_rows`` labelled rows; None without any.

    One task trains on the word buckets of these rows; only the weights, a fixed number of
    buckets, come to the driver.
    """
    targets = targets or default_targets()
    usable = F.lit(True) if usable is None else usable
    sample = samples.labelled_texts(docs, labels, targets, usable, params.train_rows)
    names = list(targets)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [word_buckets(t.as_py(), params.buckets).astype(np.int32).tobytes()
                     for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[batch.column(n) for n in names],
                 pa.array(found, pa.binary())], ["doc_id", *names, "buckets"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])]
        if not rows:
            return
        rows.sort()
        chain = fit_chain([np.frombuffer(row[-1], np.int32).astype(np.int64) for row in rows],
                          np.array([row[1:-1] for row in rows]), params)
        yield pa.RecordBatch.from_arrays(
            [pa.array([[w.tobytes() for w in chain.weights]], pa.list_(pa.binary())),
             pa.array([chain.threshold])], ["weights", "threshold"])

    model = (
        sample.mapInArrow(features, f"doc_id long, {', '.join(f'{n} int' for n in names)}, buckets binary")
        .repartition(1).mapInArrow(train, "weights array<binary>, threshold double").first())
    return model and Chain([np.frombuffer(w) for w in model["weights"]], model["threshold"])


def score(
    docs: DataFrame, chain: Chain | None, params: ToxicityParams = ToxicityParams(),
) -> DataFrame:
    """(doc_id, toxic, score, p_<category>...) of every row.

    ``score`` is the probability of the last category and ``toxic`` says whether it
    reaches the chain's threshold. Whole texts are read; null counts as empty. Without a trained
    chain all probabilities are 0. Rows stay in their tasks; other columns are not read.
    """
    names = [f"p_{c}" for c in params.categories]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(
        f"{n} double" for n in names)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # fixed number of buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ChainScorer(shared.value, params) if shared.value else None
        for batch in batches:
            p = np.array([scorer.probabilities(t.as_py() or "") if scorer else [0.0] * len(names)
                          for t in batch.column("text")]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, p.T)], ["doc_id", *names])

    scored = docs.select("doc_id", "text").mapInArrow(run, schema)
    last, threshold = F.col(names[-1]), chain.threshold if chain else 1.0
    return scored.select(
        "doc_id", (last >= threshold).alias("toxic"), last.alias("score"), *names)
