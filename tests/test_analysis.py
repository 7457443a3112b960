import datetime as dt
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from gaceta import session
from gaceta.operators import analysis, counts
from gaceta.params import QueryParams, TokenParams

# Articles per day around the known peaks of a news collection, and those peaks.
DAYS = {
    "2023-09-13": [1354, 1111, 175, 720, 657, 683, 627, 1365, 1419, 1388],
    "2024-09-17": [1667, 1058, 888, 859, 718, 796, 1421, 1904, 1695],
    "2024-12-31": [1226, 599, 1333, 1365, 696, 627, 1365, 1548],
    "2025-03-26": [1449, 1453, 1345, 717, 673, 1412, 167, 1864, 1756],
    "2025-09-16": [1698, 1572, 890, 815, 715, 699, 1701, 1906, 1923, 1882],
}
PEAKS = [
    ("2023-09-20", 1365, "761.0", "1.79x"), ("2023-09-21", 1419, "762.6", "1.86x"),
    ("2023-09-22", 1388, "806.6", "1.72x"), ("2024-09-24", 1904, "1058.1", "1.80x"),
    ("2024-09-25", 1695, "1092.0", "1.55x"), ("2025-01-07", 1548, "1030.1", "1.50x"),
    ("2025-04-02", 1864, "1030.9", "1.81x"), ("2025-04-03", 1756, "1090.1", "1.61x"),
    ("2025-09-23", 1906, "1155.7", "1.65x"), ("2025-09-24", 1923, "1185.4", "1.62x"),
    ("2025-09-25", 1882, "1235.6", "1.52x"),
]


def daily(spark, start, values):
    first = dt.date.fromisoformat(start)
    rows = [((first + dt.timedelta(i)).isoformat(), n) for i, n in enumerate(values)]
    return spark.createDataFrame(rows, "fecha string, n long")


def test_known_peaks(spark):
    from gaceta.sources import reports

    found = [
        tuple(r) for start, values in DAYS.items()
        for r in reports.peaks_table(analysis.volume_peaks(daily(spark, start, values))).collect()
    ]
    assert found == PEAKS


def test_peak_is_inclusive_and_needs_a_full_window(spark):
    flags = lambda values: [
        r["es_peak"] for r in analysis.daily_series(daily(spark, "2023-01-01", values)).orderBy("fecha").collect()]
    assert flags([10] * 7 + [15]) == [0] * 7 + [1]
    assert flags([10] * 7 + [14]) == [0] * 8
    assert flags([10] * 6 + [90]) == [0] * 7


def test_window_counts_rows_not_days(spark):
    df = daily(spark, "2023-01-01", [10] * 9).where("fecha <> '2023-01-03'")
    rows = analysis.daily_series(df).orderBy("fecha").collect()
    assert [r["moving_avg"] for r in rows] == [None] * 7 + [10.0]


def test_title_and_body_do_not_join(spark):
    df = spark.createDataFrame([("sol", "ana", 1), (None, "luz", 1), ("", None, 2)], "title string, body string, k int")
    got = sorted((r["k"], r["word"], r["n"]) for r in counts.count_terms(df, ["k"]).collect())
    assert got == [(1, "ana", 1), (1, "luz", 1), (1, "sol", 1)]


def test_texts_are_cut_once_and_then_dealt_out(spark):
    _, df = corpus(spark, n=20)
    query = counts.count_terms(df, ["month"], TokenParams(stop_words=()))._jdf.queryExecution()
    plan = query.optimizedPlan().toString()
    assert "Generate explode(_words" in plan
    assert plan.count("regexp_extract_all(lower(body") == plan.count("regexp_extract_all(lower(title") == 1
    # Nulls, texts without a word and articles without a text give no row.
    odd = spark.createDataFrame([(None, None, 1), ("", "..", 1), ("12", "sol", 2)], "title string, body string, k int")
    assert [tuple(r) for r in counts.count_terms(odd, ["k"], TokenParams(stop_words=())).collect()] == [(2, "sol", 1)]


def corpus(spark, n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = ["chile", "país", "gobierno", "mar", "sur", "norte", "luz", *[f"raro{c}" for c in "abcdefgh"]]
    weights = [40, 20, 10, 9, 8, 7, 6, *[0.4] * 8]
    rows = []
    for i in range(n):
        source = -1 if i % 50 == 0 else 1 if i % 3 == 0 else i % 9
        words = rng.choices(vocabulary, weights, k=rng.randrange(12))
        rows.append((2023 + i % 2, i % 5 + 1, i % 4 + 1, source, " ".join(words[:3]), ", ".join(words[3:])))
    return rows, spark.createDataFrame(
        rows, "year int, month int, region_id int, source_id int, title string, body string")


def tally(rows, key):
    got = {}
    for row in rows:
        for w in (row[4] + " " + row[5].replace(",", " ")).split():
            got.setdefault(key(row), Counter())[w] += 1
    return got


def test_one_pass_counts_equal_separate_counts(spark):
    rows, df = corpus(spark)
    grouped = counts.grouped_counts(df)
    for level, keys in counts.LEVELS.items():
        one = sorted(tuple(r) for r in counts.level_counts(grouped, level).collect())
        two = sorted(tuple(r) for r in counts.count_terms(df, keys).collect())
        assert one == two and one
    world = counts.level_counts(grouped, "global")
    for level in ("month", "region", "source"):
        summed = counts.resum(counts.level_counts(grouped, level), [])
        assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, world.collect()))


def test_levels_are_summed_after_one_shuffle(spark, monkeypatch):
    _, df = corpus(spark)
    finest = counts.grouped_counts(df, levels=counts.MONTH_LEVELS)
    assert set(finest.columns) >= {*counts.MONTH, *counts.REGION, *counts.SOURCE, "word", "n"}
    kept = session.materialize(finest.drop("level"))
    monkeypatch.setattr(counts, "TASK_SUMS", 100)
    summed = counts.months_summed(kept)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(word" in plan
    for level, keys in counts.LEVELS.items():
        one = sorted(map(tuple, counts.level_counts(summed, level).collect()))
        assert one == sorted(map(tuple, counts.count_terms(df, keys).collect())) and one


def test_top_terms_break_ties_by_word(spark):
    df = spark.createDataFrame(
        [(2023, 1, w, n) for w, n in (("b", 5), ("a", 5), ("c", 9), ("d", 1))],
        "year int, month int, word string, n long")
    got = analysis.top_terms_by_month(df, QueryParams(top_k=3)).orderBy("rank").collect()
    assert [(r["rank"], r["term"], r["n"]) for r in got] == [(1, "c", 9), (2, "a", 5), (3, "b", 5)]


def test_kl_matches_its_definition(spark):
    rows, df = corpus(spark)
    world, by_source = tally(rows, lambda r: 0)[0], tally(rows, lambda r: r[3])
    total = sum(world.values())
    expected = {}
    for source, words in by_source.items():
        n_source = sum(words.values())
        expected[source] = sum(
            n / n_source * math.log((n / n_source) / (world[w] / total))
            for w, n in words.items() if world[w] >= 10)
    assert min(world.values()) < 10 <= max(world.values())
    dim = spark.createDataFrame([(1, "uno.cl")], "source_id int, source string")
    c = counts.grouped_counts(df)
    kl = analysis.kl_by_source(counts.level_counts(c, "source"), counts.level_counts(c, "global"), dim)
    got = {r["source_id"]: r for r in kl.collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[s]["kl"], v, rel_tol=1e-9, abs_tol=1e-12) for s, v in expected.items())
    assert got[1]["source"] == "uno.cl" and got[-1]["source"] == "id=-1"


def test_kl_of_the_whole_corpus_is_zero(spark):
    df = spark.createDataFrame([(7, "sol", 30), (7, "mar", 20)], "source_id int, word string, n long")
    dim = spark.createDataFrame([], "source_id int, source string")
    row = analysis.kl_by_source(df, counts.resum(df, []), dim).first()
    assert abs(row["kl"]) < 1e-12 and row["source"] == "id=7"


def test_region_words(spark):
    rows, df = corpus(spark)
    world, by_region = tally(rows, lambda r: 0)[0], tally(rows, lambda r: r[2])
    dim = spark.createDataFrame([(1, "Uno"), (2, "Dos")], "region_id int, region_name string")
    c = counts.grouped_counts(df)
    got = analysis.words_by_region(
        counts.level_counts(c, "region"), counts.level_counts(c, "global"), dim,
        QueryParams(region_top=4)).orderBy("region_id", "rank").collect()
    for region, words in by_region.items():
        frequent = [(w, n) for w, n in words.items() if world[w] >= 10]
        top = sorted(frequent, key=lambda x: (-x[1], x[0]))[:4]
        mine = [r for r in got if r["region_id"] == region]
        assert [(r["word"], r["regional_n"], r["global_n"]) for r in mine] == [(w, n, world[w]) for w, n in top]
        assert all(math.isclose(r["ratio"], r["regional_n"] / r["global_n"]) for r in mine)
    assert {r["region_id"]: r["region_name"] for r in got} == {1: "Uno", 2: "Dos", 3: "id=3", 4: "id=4"}


def test_row_order_changes_nothing(spark):
    rows, df = corpus(spark)
    top = lambda d: sorted(map(tuple, analysis.top_terms_by_month(counts.count_terms(d, counts.MONTH)).collect()))
    assert top(df) == top(df.orderBy(F.rand(1)).repartition(7))
