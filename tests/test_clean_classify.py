import random
import re

from pyspark.sql import functions as F

from gaceta.operators import classify, clean
from gaceta.params import GAZETTEER, RegionParams


def articles(spark, rows):
    return spark.createDataFrame(rows, "article_id string, publish_date string, body string, _seq long")


ROWS = [
    ("a", "2023-02-30", "bad date first", 1),
    ("a", "2023-02-01", "good date second", 2),
    ("b", "2023-01-05", "kept", 3),
    ("b", "2023-01-06", "dropped", 4),
    (None, "2023-01-01", "no id", 5),
    ("c", None, "no date", 6),
    ("c", "2023-03-01", "kept too", 7),
]


def test_rejection_order(spark):
    raw = articles(spark, ROWS)
    kept = clean.clean_articles(raw).orderBy("_seq").collect()
    assert [(r["article_id"], r["body"], r["year"], r["month"]) for r in kept] == [
        ("b", "kept", 2023, 1), ("c", "kept too", 2023, 3)]


def test_rejection_counts_add_up(spark):
    raw = articles(spark, ROWS + [("d", "2023-01-01", "too many fields", 8)])
    raw = raw.withColumn("_over_long", F.coalesce(F.col("article_id") == "d", F.lit(False)))
    got = clean.rejection_counts(raw, "_over_long").first().asDict()
    assert got == {
        "raw_rows": 8, "malformed": 1, "skipped_null": 2, "skipped_dup": 2,
        "bad_date": 1, "written": 2, "padded": 0,
    }
    assert got["raw_rows"] == sum(v for k, v in got.items() if k not in ("raw_rows", "padded"))


def test_every_way_to_keep_the_first_agrees(spark):
    rng = random.Random(5)
    # A third of the rows share one id.
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(150)}", "2023-01-01", f"b{i}", i)
            for i in range(600)]
    rng.shuffle(rows)
    df = articles(spark, rows).repartition(5)
    first = {}
    for key, _, body, seq in rows:
        if key not in first or seq < first[key][0]:
            first[key] = (seq, body)
    for limit in (1 << 20, 600, 0):
        kept = clean.keep_first(df, limit=limit)
        got = {r["article_id"]: (r["_seq"], r["body"]) for r in kept.collect()}
        assert kept.count() == len(first) and got == first


def test_keeping_the_first_with_missing_and_equal_positions(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", "c", "d", None, f"k{i}"]), "2023-01-01", f"b{i}",
             rng.choice([None, i, i // 2, 7])) for i in range(200)]
    df = articles(spark, rows).repartition(3)
    first = {}
    for key, _, _, seq in rows:
        if key is not None and seq is not None:
            first[key] = min(seq, first.get(key, seq))
    expected = sorted(b for k, _, b, seq in rows if k is None or seq is None or seq == first[k])
    for limit in (1 << 20, 400, 0):
        assert sorted(r["body"] for r in clean.keep_first(df, limit=limit).collect()) == expected


def test_later_copies_are_the_build_side(spark):
    df = articles(spark, [("a", "2023-01-01", "x", 1), ("a", "2023-01-01", "y", 2)])
    plan = lambda limit: clean.keep_first(df, limit=limit)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(1 << 20) and "BuildRight" in plan(1 << 20)
    assert "ShuffledHashJoin" in plan(0) and "BuildRight" in plan(0)


def test_na_tokens(spark):
    df = spark.createDataFrame([(x,) for x in ("NA", "null", "None", "n/a", "", "nada", None)], "v string")
    got = [r["v"] for r in clean.null_na_tokens(df, ["v"]).collect()]
    assert got == [None] * 5 + ["nada", None]


def regions(spark, pairs, params=RegionParams()):
    df = spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(pairs)], "i int, title string, body string")
    placed = classify.assign_region(df, params=params).orderBy("i").collect()
    return [r["region_name"] for r in placed]


def test_regions(spark):
    cases = [
        (("xiv region de los rios", None), "Los Rios"),
        (("", "nada que ver"), "Desconocida"),
        (("Valparaíso y Temuco", ""), "Desconocida"),
        (("", "x" * 800 + " santiago"), "Desconocida"),
        (("", "x" * 785 + " santiago"), "Metropolitana"),
        (("Temuco", "santiago santiago santiago"), "Desconocida"),
        (("Temuco", "santiago maipú"), "La Araucania"),
        (("O'Higgins", None), "OHiggins"),
        (("o’higgins", None), "OHiggins"),
        (("santiaguino", "lotas"), "Desconocida"),
        (("Ñuñoa", ""), "Metropolitana"),
        (("la  serena", ""), "Desconocida"),
    ]
    assert regions(spark, [c for c, _ in cases]) == [name for _, name in cases]


def test_hits_count_overlaps_once(spark):
    def hits(line):
        df = spark.createDataFrame([(line,)], "t string")
        return df.select(F.regexp_count("t", F.lit(classify.alias_pattern(GAZETTEER["Los Rios"])))).first()[0]

    assert hits("xiv region de los rios") == 2
    assert hits("region de los rios") == 1


def brute_force(title, body):
    """Per-region search of the whole folded text, without the word-run shortcut."""
    scores = {}
    for name, aliases in GAZETTEER.items():
        pattern = "|".join(rf"\b{re.escape(a)}\b" for a in aliases)
        scores[name] = 3 * len(re.findall(pattern, title)) + len(re.findall(pattern, body[:800]))
    best = max(scores.values())
    winners = [n for n, s in scores.items() if s == best]
    return winners[0] if best and len(winners) == 1 else "Desconocida"


def test_regions_match_brute_force(spark):
    rng = random.Random(11)
    words = sorted({w for v in GAZETTEER.values() for a in v for w in a.split()}) + ["y", "o", "gran"]
    aliases = [a for v in GAZETTEER.values() for a in v]
    gaps = [" ", " ", " ", "  ", ", ", "'", "\n", "-"]

    def line(n):
        return "".join(
            (rng.choice(aliases) if rng.random() < 0.3 else rng.choice(words)) + rng.choice(gaps)
            for _ in range(n))

    pairs = [(line(rng.randrange(6)), line(rng.randrange(120))) for _ in range(1500)]
    assert regions(spark, pairs) == [brute_force(*p) for p in pairs]


def test_own_gazetteer(spark):
    params = RegionParams(gazetteer={"Norte": ("c++ norte",), "Sur": ("sur",)}, default_label="?",
                          title_weight=2, body_prefix=10)
    assert params.ids == {"Norte": 1, "Sur": 2, "?": 3}
    assert regions(spark, [("c++ norte", "sur"), ("", "sur"), ("", "0123456789 sur")], params) == [
        "Norte", "Sur", "?"]
    # An alias that does not start with a word is searched in the whole text.
    params = RegionParams(gazetteer={"Norte": ("@norte",), "Sur": ("sur",)})
    assert classify.mention_pattern(params) is None
    assert regions(spark, [("x@norte", ""), ("", "al sur"), ("@norte", "")], params) == [
        "Norte", "Sur", "Desconocida"]
