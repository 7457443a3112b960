"""Rows that earlier versions got wrong, and helpers against plain loops."""

import numpy as np
from pyspark.sql import functions as F

from gaceta.llm import langmix, mixing, ngrams, pseudonyms, quality, samples


def test_letters_are_letters():
    assert langmix.text_words("½²Ⅷ①") == []
    assert langmix.text_words("El ½Ñandú②corre ªº") == ["el", "ñandú", "corre", "ªº"]


def test_unlettered_texts_have_no_language(spark):
    docs = spark.createDataFrame([(1, "el perro", "es"), (2, "the dog", "en"), (3, "½²Ⅷ①", "en")],
                                 "doc_id long, text string, lang string")
    found = langmix.identify(docs, langmix.fit(docs, F.lit(True))).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "es", 2: "en", 3: "und"}


def test_one_phone_number_has_one_pseudonym(spark):
    numbers = ["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+44 2079 460958"]
    docs = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "doc_id long, text string")
    rows = pseudonyms.pseudonymise(docs, pseudonyms.PseudonymParams("secret")).collect()
    made = {"".join(c for c in r.text if c.isdigit()) for r in rows}
    assert len(made) == 1 and made.pop().startswith("44")
    assert [[c for c in r.text if not c.isdigit()] for r in rows] == [[c for c in n if not c.isdigit()] for n in numbers]


def test_rows_without_id_are_drawn_one_by_one(spark):
    docs = spark.range(2000).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit("a").alias("source"))
    params = mixing.MixParams(weights={"a": 1.0}, epochs=1.5)
    mixed = mixing.mix_sources(docs, params)
    n = mixed.count()
    assert abs(n - 3000) < 6 * 3000 ** 0.5
    assert len({r[0] for r in mixed.groupBy("text").count().select("count").collect()}) > 2
    spread = mixed.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 2 * n / len(spread) + 100


def test_a_sample_has_one_row_per_id(spark):
    docs = spark.range(300).select((F.col("id") % 3).alias("doc_id"), F.concat(F.lit("t"), 1000 + F.col("id")).alias("text"))
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 0)], "doc_id long, quality int")
    found = samples.labelled_texts(docs, labels, {"label": F.col("quality") > 0}, F.lit(True), 2).collect()
    assert len(found) == 2 and {r.text for r in found} <= {"t1000", "t1001", "t1002"}
    assert [c for c in found[0].asDict()] == ["doc_id", "text", "label"]


def test_quality_takes_odd_columns_and_returns_what_is_asked(spark):
    docs = spark.createDataFrame([(1, "uno dos", (1,)), (2, None, None)], "doc_id long, text string, `a b` struct<`x y`:int>")
    model = (np.zeros(quality.QualityParams().buckets + 1), 0.5)
    assert quality.score(docs, model).columns == ["doc_id", "text", "a b", "score"]
    assert quality.score(docs, model).count() == 2
    narrow = quality.score(docs, model, keep=["doc_id"])
    assert narrow.columns == ["doc_id", "score"] and narrow.count() == 2
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("in_text") >= 1 and "in_1" not in plan


def test_word_ngrams_against_a_plain_loop():
    words = ["a", "casa", "ñandú", "😀x", "palabras"]
    buckets, owner = ngrams.word_ngrams(words, (3, 4), 1 << 15, "<", ">")
    wanted = [max(0, len(w) + 2 - n + 1) for w in words for n in (3, 4)]
    assert len(buckets) == len(owner) == sum(wanted)
    for i, word in enumerate(words):
        marked = f"<{word}>"
        grams = {marked[j:j + n] for n in (3, 4) for j in range(len(marked) - n + 1)}
        own = set(buckets[owner == i].tolist())
        # The same grams of the word on its own, one word at a time.
        alone, _ = ngrams.word_ngrams([word], (3, 4), 1 << 15, "<", ">")
        assert own == set(alone.tolist()) and len(own) <= len(grams)
