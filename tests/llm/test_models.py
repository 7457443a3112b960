"""Trained operators: accuracy on rows they did not learn from, folds, edge rows."""

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaceta.llm import langmix, quality, queries, toxicity
from tests.llm.conftest import SF_MEDIUM

BARE = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def medium(spark):
    return queries.table(spark, SF_MEDIUM, "documents")


def fold(doc_id, modulus):
    return crc32(str(doc_id).encode()) % modulus


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF_MEDIUM, "labels").collect()}
    rows = queries.op1_quality(spark, SF_MEDIUM).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in test]) > 0.9
    assert np.mean([p for p, y in test if y == 1]) > 0.97


def test_quality_does_not_learn_from_held_out_rows(spark, medium):
    labels = queries.table(spark, SF_MEDIUM, "labels")
    learnable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    flipped = labels.withColumn("quality", F.when(learnable, F.col("quality")).otherwise(1 - F.col("quality")))
    small = quality.QualityParams(train_rows=60, epochs=1)
    one, _ = quality.fit(medium, labels, learnable, small)
    two, _ = quality.fit(medium, flipped, learnable, small)
    assert np.array_equal(one, two)


def test_quality_edges(spark, awkward, no_labels):
    model = quality.fit(awkward, no_labels, F.lit(True))
    assert model == (None, 1.0)
    assert {r.score for r in quality.score(awkward, model).collect()} == {1.0}
    labels = spark.createDataFrame([(3, 1), (3, 1), (13, 0), (7, 0), (None, 1), (4, None)], "doc_id long, quality int")
    model = quality.fit(awkward, labels, F.lit(True))
    scored = quality.score(awkward, model)
    assert scored.columns == [c for c in awkward.columns if c != "score"] + ["score"]
    rows = scored.collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").split()}) == 1
    assert quality.score(awkward.limit(0), model).collect() == []


def test_quality_weights_are_the_model():
    """The folded weights give what vectors, mean and softmax give."""
    params = quality.QualityParams(buckets=64, epochs=3)
    texts = [quality.text_features(t, params) for t in ("bueno bueno texto", "malo!! malo!!", "bueno", "malo!!")]
    weights = quality.train(texts, np.array([1, 0, 1, 0]), params)
    scorer = quality.Scorer(weights, params)
    for text in ("bueno bueno texto", "malo!! malo!!", ""):
        buckets, counts = quality.text_features(text, params)
        assert scorer.log_odds(text) == pytest.approx((counts * weights[buckets]).sum() / counts.sum())
    assert scorer.log_odds("bueno") > scorer.log_odds("malo!!")


def test_language_on_held_out_rows(spark, medium):
    langs = {r.doc_id: r.lang for r in medium.select("doc_id", "lang").collect()}
    rows = queries.op6_language(spark, SF_MEDIUM).collect()
    assert len(rows) == 1000 and all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    test = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert np.mean(test) > 0.98


def test_language_mixture_and_edges(spark, medium, awkward):
    model = langmix.fit(medium, F.lit(True))
    english, french = [
        " ".join(medium.where(F.col("lang") == lang).orderBy("doc_id").limit(4).toPandas().text)
        for lang in ("en", "fr")]
    take = lambda text, n: " ".join(text.split()[:n])
    docs = spark.createDataFrame([
        (1, take(english, 300), None), (2, f"{take(english, 300)} {take(french, 200)}", None),
        (3, None, None), (4, "123 !!! ...", None), (5, "", "x"), (5, "", "x")], BARE)
    rows = {r.doc_id: r for r in langmix.identify(docs, model).collect()}
    assert rows[1].lang_pred == "en" and rows[1].score > 0.95
    assert rows[2].lang_pred == "en" and set(rows[2].languages) == {"en", "fr"}
    assert 0.3 < rows[2].languages["fr"] < 0.5
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (3, 4, 5))
    assert langmix.identify(awkward, model).count() == awkward.count()
    none = langmix.fit(awkward.limit(0), F.lit(True))
    assert {r.lang_pred for r in langmix.identify(awkward, none).collect()} == {"und"}


def test_language_shares_raise_the_likelihood():
    rng = np.random.default_rng(1)
    model = langmix.LanguageModel(["a", "b", "c"], np.zeros((3, 8)))
    mixtures = langmix.Mixtures(model, langmix.LanguageParams(iterations=400, tolerance=1e-9))
    p, n = rng.uniform(0.01, 1, (50, 3)), rng.integers(1, 5, 50).astype(float)
    share, best = mixtures.shares(p, n)
    assert share.sum() == pytest.approx(1)
    for other in rng.dirichlet(np.ones(3), 300):
        assert n @ np.log(p @ other) <= best + 1e-3


def test_toxicity(spark, medium):
    labels = queries.table(spark, SF_MEDIUM, "labels")
    learnable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    chain = toxicity.fit(medium, labels, usable=learnable)
    rows = {r.doc_id: r for r in toxicity.score(medium, chain).collect()}
    assert len(rows) == 1000 and all(r.toxic == (r.score >= chain.threshold) for r in rows.values())
    truth = {r.doc_id: r.toxic for r in labels.collect() if fold(r.doc_id, 4) == 2}
    flagged = [truth[i] for i in truth if rows[i].toxic]
    # Of 1000 documents only 300 are labelled and learned from, 37 of them toxic.
    assert np.mean(flagged) > 0.7
    assert sum(flagged) > 0.5 * sum(truth.values())


def test_toxicity_chain_feeds_forward():
    rng = np.random.default_rng(4)
    rows, targets = [], []
    for _ in range(300):
        words = set(rng.integers(10, 200, 12).tolist())
        first = rng.random() < 0.3
        words |= {1} if first else set()
        rows.append(np.array(sorted(words)))
        targets.append((first, first))
    params = toxicity.ToxicityParams(categories=("one", "two"), buckets=256)
    chain = toxicity.fit_chain(rows, np.array(targets), params)
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert chain.weights[1][256] > 0  # the earlier category's probability counts
    assert 0 < chain.threshold < 1


def test_toxicity_edges(spark, awkward, no_labels):
    assert toxicity.fit(awkward, no_labels) is None
    rows = toxicity.score(awkward, None).collect()
    assert len(rows) == awkward.count() and not any(r.toxic for r in rows)
    labels = spark.createDataFrame([(3, 1, 1), (4, 1, 0), (7, 0, 0), (7, 0, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    chain = toxicity.fit(awkward, labels)
    assert toxicity.score(awkward, chain).count() == awkward.count()
    assert toxicity.score(awkward.limit(0), chain).collect() == []
