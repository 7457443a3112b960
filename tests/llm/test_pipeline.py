"""Every stage of the pipeline on its own input, against brute force or what it must keep."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from gaceta import session
from gaceta.llm import mixing, quality, queries, simhash
from tests.llm.conftest import SF_MEDIUM
from tests.llm.test_dedup import components_by_hand, lowered


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage."""
    docs, found = queries.table(spark, SF_MEDIUM, "documents"), {}
    for name, stage in pipeline.STAGES:
        out = session.materialize(stage(spark, docs, SF_MEDIUM))
        found[name] = (docs, out)
        docs = out
    return found


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*pipeline.COLUMNS).collect()), key=repr)


def test_stages(steps):
    assert 4 <= len(pipeline.STAGES) <= 5
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.columns == list(pipeline.COLUMNS)
        assert set(rows_of(after)) <= set(rows_of(before))


def test_quality_stage(spark, steps):
    before, after = steps["quality classifier"]
    model = queries.quality_model(spark, before, SF_MEDIUM)
    scored = quality.score(before, model).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scored if r.score >= 0.7}
    kept = {r.doc_id for r in after.collect()}
    labels = queries.table(spark, SF_MEDIUM, "labels").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    assert sum(good) > 0.98 * len(good)


def test_exact_stage(steps):
    before, after = steps["exact dedup"]
    best = {}
    for r in before.collect():
        best[lowered(r.text)] = max(best.get(lowered(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(best.values())


def test_near_stage(steps):
    before, after = steps["SimHash near-dedup"]
    rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
    expected = components_by_hand(rows, simhash.NARROW)
    assert {r.doc_id for r in after.collect()} == {c for _, c in expected.values()}


def test_near_stage_drops_rows_not_ids(spark):
    text = " ".join(f"w{i}" for i in range(300))
    near = text.replace("w299", "W299")
    rows = [(1, text), (2, near), (2, "something else altogether"), (None, text), (None, "nobody else has this")]
    docs = spark.createDataFrame([(i, t, "es", "s", 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = {(r.doc_id, r.text) for r in pipeline.near_stage(spark, docs, "").collect()}
    assert left == {(1, text), (2, "something else altogether"), (None, "nobody else has this")}


def test_mix_stage(steps):
    before, after = steps["mixing sources to target weights"]
    rates = {r.source: r.rate for r in mixing.source_rates(before).collect()}
    counts = {r.source: r["count"] for r in after.groupBy("source").count().collect()}
    for r in before.groupBy("source").count().collect():
        mean = rates[r.source] * r["count"]
        assert abs(counts.get(r.source, 0) - mean) < 6 * mean ** 0.5


def test_encode_stage(steps):
    before, after = steps["BPE encoding and decoding"]
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    expected = sorted((r[0], r[1]) for r in before.select("doc_id", digest).collect())
    assert sorted((r.doc_id, r.decoded_sha256) for r in after.collect()) == expected


def test_stages_take_awkward_rows(spark, awkward, tmp_path):
    docs = awkward.select(*pipeline.COLUMNS, "gid", "keep_id")
    spark.createDataFrame([(3, 1, 0), (4, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() >= 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_run_is_registered(spark, steps):
    found = pipeline.run(spark, SF_MEDIUM)
    last = steps["BPE encoding and decoding"][1]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, last.collect()))
