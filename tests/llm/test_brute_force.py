"""Models of language and toxicity against plain loops and all subsets."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaceta.llm import langmix, queries, shrinkage, toxicity
from tests.llm.conftest import SF_MEDIUM

PARAMS = langmix.LanguageParams()


def plain_bucket(gram: str) -> int:
    """The hash of ``ngrams`` one character at a time, in whole numbers."""
    h = len(gram)
    for c in gram:
        h = (h ^ ord(c)) * 16777619 % 2 ** 32
    h ^= h >> 15
    h = h * 0x2C1B3C6D % 2 ** 32
    return (h ^ h >> 13) % PARAMS.buckets


def plain_words(text: str) -> list[str]:
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def test_trigram_counts_against_a_plain_loop(spark, documents, awkward):
    docs = documents.select("doc_id", "text", "lang").union(awkward.select("doc_id", "text", "lang"))
    usable = F.coalesce("doc_id", F.lit(0)) % 3 != 1
    wanted: Counter = Counter()
    for row in docs.where(usable & F.col("lang").isNotNull()).collect():
        for word in plain_words(row.text or ""):
            marked = f" {word} "
            wanted.update((row.lang, marked[i:i + 3]) for i in range(len(marked) - 2))
    by_bucket: Counter = Counter()
    for (lang, gram), n in wanted.items():
        by_bucket[lang, plain_bucket(gram)] += n
    found = {(r.lang, r.bucket): r.n for r in langmix.trigram_counts(docs, usable).collect()}
    assert found == dict(by_bucket)

    model = langmix.fit(docs, usable)
    assert model.languages == sorted({lang for lang, _ in by_bucket})
    for lang, logs in zip(model.languages, model.logs):
        own = {b: n for (name, b), n in by_bucket.items() if name == lang}
        total = sum(own.values()) + PARAMS.smoothing * PARAMS.buckets
        probable = max(own, key=own.get)
        assert np.exp(logs).sum() == pytest.approx(1)
        assert logs[probable] == pytest.approx(np.log((own[probable] + PARAMS.smoothing) / total))


def test_language_sets_against_all_subsets(spark):
    docs = queries.table(spark, SF_MEDIUM, "documents")
    model = langmix.fit(docs, F.lit(True))
    mixtures = langmix.Mixtures(model, PARAMS)
    exact = langmix.Mixtures(model, langmix.LanguageParams(iterations=500, tolerance=1e-7))
    words = {lang: [w for r in docs.where(F.col("lang") == lang).orderBy("doc_id").limit(6).collect()
                    for w in (r.text or "").split()] for lang in model.languages}
    rng = np.random.default_rng(3)
    sizes = set()
    for _ in range(25):
        parts = rng.choice(model.languages, rng.integers(1, 4), replace=False)
        text = " ".join(w for lang in parts for w in words[lang][:int(rng.integers(15, 200))])
        counts = Counter(langmix.text_words(text))
        logs = mixtures.word_logs(list(counts))
        n = np.fromiter(counts.values(), float, len(counts))
        p = np.maximum(np.exp(logs - logs.max(axis=1)[:, None]), 1e-30)
        price = PARAMS.penalty * np.log1p(n.sum())
        worth = {
            chosen: exact.shares(p[:, chosen], n)[1] - price * (len(chosen) - 1)
            for k in range(1, len(model.languages) + 1)
            for chosen in combinations(range(len(model.languages)), k)}
        found = mixtures.mixture(text)
        chosen = tuple(sorted(model.languages.index(lang) for lang in found))
        assert worth[chosen] >= max(worth.values()) - 0.01 * price
        assert sum(found.values()) == pytest.approx(1)
        sizes.add(len(found))
    assert len(sizes) > 1


def test_too_many_languages_are_refused(spark):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.lit("el perro").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    with pytest.raises(ValueError, match="max_languages=39"):
        langmix.fit(docs, F.lit(True), langmix.LanguageParams(max_languages=39))
    assert len(langmix.fit(docs, F.lit(True), langmix.LanguageParams(max_languages=40)).languages) == 40


def test_forgetting_words_changes_no_language(spark, documents):
    model = langmix.fit(documents, F.lit(True))
    texts = [r.text or "" for r in documents.limit(60).collect()]
    wide, narrow = langmix.Mixtures(model, PARAMS), langmix.Mixtures(model, PARAMS)
    narrow.room = 50
    assert [wide.mixture(t) for t in texts] == [narrow.mixture(t) for t in texts]


def test_toxicity_scores_against_the_linear_models():
    params = toxicity.ToxicityParams(categories=("one", "two", "three"), buckets=512)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 300, rng.integers(0, 40))) for _ in range(120)]
    texts += ["", "W1 w1 W1", "w2, w3; w4"]
    rows = [toxicity.word_buckets(t, params.buckets) for t in texts]
    targets = np.array([[1 in r, i % 5 == 0, i % 3 == 0] for i, r in enumerate(rows)])
    chain = toxicity.fit_chain(rows, targets, params)
    scorer = toxicity.ChainScorer(chain, params)
    for text, row in zip(texts, rows):
        earlier: list[float] = []
        for weights in chain.weights:
            odds = sum(weights[b] for b in row)
            odds += sum(w * e for w, e in zip(weights[params.buckets:-1], earlier)) + weights[-1]
            earlier.append(1 / (1 + np.exp(-odds)))
        assert scorer.probabilities(text) == pytest.approx(earlier)


def test_fold_probabilities_come_from_models_without_the_row():
    params = toxicity.ToxicityParams(categories=("one", "two"), buckets=64, steps=15)
    rng = np.random.default_rng(6)
    rows = [np.unique(rng.integers(0, 64, 6)) for _ in range(30)]
    targets = rng.random((30, 2)) < 0.4
    chain = toxicity.fit_chain(rows, targets, params)
    x, none = toxicity.Sparse(rows, 64), np.zeros((30, 0))
    unseen = np.zeros(30)
    for i in range(30):
        others = [j for j in range(30) if j % params.folds != i % params.folds]
        model = toxicity.fit_linear(x, none, targets[:, 0].astype(float), np.array(others), params)
        unseen[i] = toxicity.predict_linear(x, none, model)[i]
    second = toxicity.fit_linear(x, unseen[:, None], targets[:, 1].astype(float), np.arange(30), params)
    assert chain.weights[1] == pytest.approx(second)


def test_priors_by_moments(spark):
    groups = [(10, 9), (10, 1), (20, 15), (5, 0), (0, 0)]
    df = spark.createDataFrame(groups, "n long, k long")
    value = lambda found: spark.range(1).select(*found).first()
    mean, strength = value(shrinkage.beta_prior(df, "n", "k"))
    n, k = np.array([g for g in groups if g[0]], float).T
    m = k.sum() / n.sum()
    spread = (n * (k / n - m) ** 2).sum() - m * (1 - m) * (len(n) - 1)
    room = m * (1 - m) * (n.sum() - (n ** 2).sum() / n.sum() - (len(n) - 1))
    assert mean == pytest.approx(m) and strength == pytest.approx(max(1.0, min(1000.0, room / spread - 1)))
    assert tuple(value(shrinkage.beta_prior(df.limit(0), "n", "k"))) == (0.5, 1.0)
    one = spark.createDataFrame([(4, 2)], "n long, k long")
    assert tuple(value(shrinkage.beta_prior(one, "n", "k"))) == (0.5, 1000.0)
