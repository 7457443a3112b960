"""Quality classifier: averaged vectors of hashed words and character n-grams, softmax output.

Trained by stochastic gradient descent in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaceta.llm import samples
from gaceta.llm.ngrams import word_ngrams

# Features that are not words: the end of every text, and a word that repeats the one before.
END, AGAIN = "\x00end", "\x00again"
# Words whose features a worker remembers before it starts over.
REMEMBERED = 1 << 18


@dataclass(frozen=True)
class QualityParams:
    # Labelled rows the model is fitted on, at most.
    train_rows: int = 5000
    buckets: int = 1 << 16
    dimension: int = 12
    shortest: int = 3
    longest: int = 4
    epochs: int = 12
    rate: float = 0.4
    threshold: float = 0.7
    seed: int = 5


def word_features(words: list[str], params: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its character n-grams, and the word each belongs to."""
    grams, owner = word_ngrams(
        words, tuple(range(params.shortest, params.longest + 1)), params.buckets)
    whole = np.fromiter((single(w, params) for w in words), np.int64, len(words))
    return np.concatenate([whole, grams]), np.concatenate([np.arange(len(words)), owner])


def single(feature: str, params: QualityParams) -> int:
    return crc32(feature.encode()) % params.buckets


def text_features(text: str, params: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text, ascending, and how often each occurs."""
    words = text.split()
    counts = Counter(words)
    n = np.fromiter(counts.values(), np.int64, len(counts))
    buckets, owner = word_features(list(counts), params)
    again = sum(map(eq, words, words[1:]))
    found, at = np.unique(
        np.append(buckets, [single(END, params), single(AGAIN, params)]), return_inverse=True)
    total = np.bincount(at, np.append(n[owner], [1, again]))
    some = total > 0
    return found[some].astype(np.int32), total[some].astype(np.int32)


def train(
    texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, params: QualityParams,
) -> np.ndarray:
    """What each bucket adds to the log-odds of label 1, times the features of the text.

    The model is softmax(output @ mean(vectors)). It is linear in the mean, so vectors and
    output weights fold into one number per bucket after training.
    """
    rng = np.random.default_rng(params.seed)
    d = params.dimension
    vectors = rng.uniform(-1 / d, 1 / d, (params.buckets, d))
    output = np.zeros((2, d))
    shares = [(i, (n / n.sum()).astype(np.float32)) for i, n in texts]
    steps, total = 0, params.epochs * len(texts)
    for _ in range(params.epochs):
        for k in rng.permutation(len(texts)):
            buckets, share = shares[k]
            rate = params.rate * (1 - steps / total)
            steps += 1
            mean = share @ vectors[buckets]
            scores = output @ mean
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[labels[k]] -= 1  # gradient of the loss by the scores
            vectors[buckets] -= rate * share[:, None] * (p @ output)[None, :] * len(share) ** 0.5
            output -= rate * np.outer(p, mean)
    return vectors @ (output[1] - output[0])


class Scorer:
    """Log-odds of texts, with the sums of words seen before at hand."""

    def __init__(self, weights: np.ndarray, params: QualityParams):
        self.params, self.weights = params, weights
        self.sums: dict[str, float] = {}
        self.sizes: dict[str, int] = {}
        self.end = float(weights[single(END, params)])
        self.again = float(weights[single(AGAIN, params)])

    def log_odds(self, text: str) -> float:
        words = text.split()
        if len(self.sums) > REMEMBERED:
            self.sums, self.sizes = {}, {}
        new = list(set(words).difference(self.sums))
        if new:
            buckets, owner = word_features(new, self.params)
            sums = np.bincount(owner, self.weights[buckets], len(new))
            self.sums.update(zip(new, sums.tolist()))
            self.sizes.update(zip(new, np.bincount(owner, minlength=len(new)).tolist()))
        again = sum(map(eq, words, words[1:]))
        total = sum(map(self.sums.__getitem__, words)) + self.end + again * self.again
        return total / (sum(map(self.sizes.__getitem__, words)) + 1 + again)


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, params: QualityParams = QualityParams(),
) -> tuple[np.ndarray | None, float]:
    """Bucket weights, and the share of label 1 in the sample (1.0 without labels).

    One task trains on the sample: at most ``train_rows`` rows of at most ``buckets`` pairs
    of integers. Only the weights come to the driver. They are None unless both labels occur.
    """
    sample = samples.labelled_texts(
        docs, labels, {"label": (F.col("quality") > 0)}, usable & F.col("quality").isNotNull(),
        params.train_rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t.as_py(), params) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array([f[0].tobytes() for f in found], pa.binary()),
                 pa.array([f[1].tobytes() for f in found], pa.binary())],
                ["doc_id", "label", "buckets", "counts"])

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])]
        if not rows:
            return
        rows.sort()
        y = np.array([row[1] for row in rows])
        weights = None
        if len(set(y.tolist())) == 2:
            texts = [tuple(np.frombuffer(x, np.int32) for x in row[2:]) for row in rows]
            weights = train(texts, y, params).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights], pa.binary()), pa.array([float(y.mean())])], ["weights", "share"])

    model = (
        sample.mapInArrow(features, "doc_id long, label int, buckets binary, counts binary")
        .repartition(1).mapInArrow(train_all, "weights binary, share double").first())
    if model is None:
        return None, 1.0
    weights = None if model["weights"] is None else np.frombuffer(model["weights"])
    return weights, model["share"]


def score(
    docs: DataFrame, model: tuple[np.ndarray | None, float],
    params: QualityParams = QualityParams(), keep: list[str] | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``score``: the probability that the label is 1.

    Whole texts are read; null counts as empty, and an empty text is scored by the end mark
    alone. Rows stay in their tasks, repeated ones are scored one by one, an empty table stays
    one. A model without weights gives every row the share of label 1. A column named score
    is replaced. ``keep``: the columns that come along, all if none are named; the text is
    sent to the workers once, and comes back only if it is among them.
    """
    weights, share = model
    names = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    column = lambda c: F.col(f"`{c}`")
    if weights is None:
        return docs.select(*map(column, names), F.lit(share).cast("double").alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # one number per bucket
    inputs = {c: f"in_{i}" for i, c in enumerate(names)}
    sent = inputs | ({} if "text" in inputs else {"text": "in_text"})
    numbered = docs.select(*[column(c).alias(i) for c, i in sent.items()])
    schema = T.StructType([*[numbered.schema[i] for i in inputs.values()], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, params)
        for batch in batches:
            odds = np.array([scorer.log_odds(t.as_py() or "") for t in batch.column(sent["text"])])
            p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            kept = [batch.column(i) for i in inputs.values()]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p, pa.float64())], schema.names)

    out = numbered.mapInArrow(run, schema)
    return out.select(*[F.col(i).alias(c) for c, i in inputs.items()], "score")
