"""Several runs into one warehouse: publication, repeated articles, merging, regions, counts, checks."""

import random
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gaceta import session
from gaceta.operators import analysis, checks, keys, membership
from gaceta.params import Params, RegionParams
from gaceta.plans import analytics, etl
from gaceta.sources import warehouse
from gaceta.sources.article_index import ArticleIndex
from gaceta.sources.warehouse import FACT, Run, StaleState, Warehouse
from tests.test_jobs import HEADER, star, write

SMALL = Params(index=membership.IndexParams(buckets=4, words=64))


def load(spark, folder, house, lines, params=SMALL, **options):
    path = write(folder / f"{random.random()}.csv", "\n".join([HEADER, *lines]) + "\n")
    return etl.run_etl(spark, path, house, params, **options)


def facts(spark, house, *columns):
    return sorted(map(tuple, Warehouse(house).fact(spark).select(*columns).collect()))


FIRST = ["1,2023-01-01,A,Arica,sol,", "2,2023-01-02,B,Iquique,mar,", "3,2023-02-01,A,t,sol,"]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("first")
    load(spark, folder, str(folder / "wh"), FIRST)
    return folder / "wh"


@pytest.fixture
def house(loaded, tmp_path):
    """A warehouse after its first run; nothing in it depends on where it lies."""
    shutil.copytree(loaded, tmp_path / "wh")
    return str(tmp_path / "wh")


# --- publication ---

@pytest.mark.parametrize("broken", ["fact", "checks", "pointer"])
def test_a_broken_run_changes_nothing(spark, tmp_path, house, monkeypatch, broken):
    before = facts(spark, house, "article_id", "body"), star(Warehouse(house), spark)
    tables = {t: Warehouse(house).read(spark, t).count() for t in ("dim_date", "dim_source", "checks")}

    def fail(*_, **__):
        raise RuntimeError("lost")

    if broken == "fact":  # one of two months is written
        whole = warehouse.write_fact
        monkeypatch.setattr(warehouse, "write_fact", lambda fact, path: (whole(fact.where("month = 1"), path), fail()))
    elif broken == "checks":
        monkeypatch.setattr(etl, "folded_checks", fail)
    else:
        monkeypatch.setattr(session, "create_file", fail)
    lines = ["8,2023-01-09,Nuevo,t,otro,", "9,2023-02-09,Nuevo,t,otro,"]
    with pytest.raises(RuntimeError, match="lost"):
        load(spark, tmp_path, house, lines)
    assert (facts(spark, house, "article_id", "body"), star(Warehouse(house), spark)) == before
    assert {t: Warehouse(house).read(spark, t).count() for t in tables} == tables
    monkeypatch.undo()
    load(spark, tmp_path, house, lines)
    assert facts(spark, house, "article_id", "body") == [("8", "otro"), ("9", "otro")]
    gone = Warehouse(house).vacuum(spark, keep=1)
    assert any(g.startswith(FACT) for g in gone)
    assert facts(spark, house, "article_id") == [("8",), ("9",)]


def test_failed_checks_are_not_published(spark, tmp_path, house):
    with pytest.raises(etl.CheckFailure):
        load(spark, tmp_path, house, ["7,2023-01-05,,t,b,"], raise_on_failure=True)
    assert facts(spark, house, "article_id") == [("1",), ("2",), ("3",)]


def test_a_reader_keeps_its_state(spark, tmp_path, house):
    reader = Warehouse(house).pinned(spark)
    load(spark, tmp_path, house, ["9,2023-01-09,C,t,b,"])
    assert sorted(r[0] for r in reader.fact(spark).select("article_id").collect()) == ["1", "2", "3"]
    assert reader.read(spark, "dim_source").count() == 2
    assert facts(spark, house, "article_id") == [("3",), ("9",)]


def test_the_slower_of_two_runs_fails(spark, house):
    one, two = Run(spark, house), Run(spark, house)
    one.replace("note", spark.range(1))
    two.replace("note", spark.range(2))
    one.publish()
    with pytest.raises(StaleState):
        two.publish()
    assert Warehouse(house).read(spark, "note").count() == 1


def test_many_small_parts_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "MAX_PARTS", 3)
    root = str(tmp_path / "wh")
    for i in range(warehouse.MAX_PARTS + 1):
        run = Run(spark, root)
        run.append("dim_source", spark.createDataFrame([(i, f"s{i}")], "source_id int, source string").coalesce(1), "source_id")
        run.publish()
    assert len(Warehouse(root).parts_of(spark, "dim_source")) == 1
    assert Warehouse(root).read(spark, "dim_source").count() == warehouse.MAX_PARTS + 1


# --- repeated articles ---

def test_an_article_is_loaded_under_one_month(spark, tmp_path, house):
    result = load(spark, tmp_path, house, [
        "1,2023-03-01,A,t,later,", "4,2023-03-02,A,t,new,", "4,2023-03-03,A,t,copy,", "3,2023-02-01,A,t,again,"])
    assert facts(spark, house, "article_id", "month", "body") == [
        ("1", 1, "sol"), ("2", 1, "mar"), ("3", 2, "again"), ("4", 3, "new")]
    metrics = result.metrics.first().asDict()
    assert (metrics["raw_rows"], metrics["written"], metrics["skipped_known"], metrics["skipped_dup"]) == (4, 2, 1, 1)
    assert "5-unique-articles" not in {r["check"] for r in result.checks.where("not passed").collect()}


def test_an_article_may_move_when_its_month_is_replaced(spark, tmp_path, house):
    load(spark, tmp_path, house, ["1,2023-03-01,A,t,moved,", "5,2023-01-03,A,t,new,"])
    assert facts(spark, house, "article_id", "month") == [("1", 3), ("3", 2), ("5", 1)]
    load(spark, tmp_path, house, ["3,2023-05-01,A,t,x,"], overwrite="static")
    assert facts(spark, house, "article_id", "month") == [("3", 5)]


def test_a_month_whose_rows_are_all_known_elsewhere_is_empty(spark, tmp_path, house):
    load(spark, tmp_path, house, ["3,2023-01-07,A,t,b,"])
    assert facts(spark, house, "article_id", "month") == [("3", 2)]
    load(spark, tmp_path, house, ["1,2023-06-07,A,t,b,"])
    assert facts(spark, house, "article_id", "month") == [("1", 6), ("3", 2)]


def test_filter_lets_all_members_pass_and_few_others(spark):
    params = membership.IndexParams(buckets=4, words=64, probes=4)
    values = spark.range(1000).select(F.concat(F.lit("a"), "id").alias("v"))
    one, two = values.where("hash(v) % 2 = 0"), values.where("hash(v) % 2 <> 0")
    filters = session.materialize(membership.merge_filters(
        membership.make_filter(one, "v", params).unionByName(membership.make_filter(two, "v", params))))
    others = spark.range(20_000).select(F.concat(F.lit("b"), "id").alias("v"))
    both = values.unionByName(others).unionByName(values).union(spark.createDataFrame([(None,)], "v string"))
    passed = [r["v"] for r in membership.maybe_members(both, "v", filters, params).collect()]
    assert len(passed) == len(set(passed)) and {f"a{i}" for i in range(1000)} <= set(passed)
    assert len(passed) < 1000 + 0.02 * 20_000
    none = session.materialize(filters.limit(0))
    assert membership.maybe_members(both, "v", none, params).count() == 0


def test_a_large_filter_is_neither_copied_nor_broadcast(spark, monkeypatch):
    params = membership.IndexParams(buckets=4, words=64)
    values = spark.range(300).select(F.concat(F.lit("a"), "id").alias("v"))
    filters = session.materialize(membership.make_filter(values, "v", params))
    asked = values.unionByName(spark.range(300).select(F.concat(F.lit("b"), "id").alias("v")))
    broadcast = sorted(map(tuple, membership.maybe_members(asked, "v", filters, params).collect()))
    monkeypatch.setattr(session, "fits_broadcast", lambda df, limit=0: False)
    dealt = membership.maybe_members(asked, "v", filters, params)
    plan = dealt._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "_salt" not in plan
    assert sorted(map(tuple, dealt.collect())) == broadcast


def test_lookup_reads_ids_of_few_buckets_only(spark, tmp_path, house):
    state = Warehouse(house).pinned(spark)
    index = ArticleIndex(spark, state.root, SMALL.index)
    parts = state.parts_of(spark, FACT)
    found = index.find(spark.createDataFrame([("2",), ("99",), (None,)], "article_id string"), parts)
    assert [(r["article_id"], r["year"], r["month"]) for r in found.collect()] == [("2", 2023, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "body" not in plan and "fact_news" not in plan and "PartitionFilters: [isnotnull(bucket" in plan
    assert index.store.missing(parts) == []
    assert index.find(spark.createDataFrame([], "article_id string"), parts).count() == 0


# --- merging ---

def test_merge_adds_to_a_month_and_replaces_by_id(spark, tmp_path, house):
    load(spark, tmp_path, house, ["2,2023-01-05,C,t,corrected,", "6,2023-01-06,A,t,late,", "3,2023-01-07,A,t,known,"],
         overwrite="merge")
    assert facts(spark, house, "article_id", "month", "body") == [
        ("1", 1, "sol"), ("2", 1, "corrected"), ("3", 2, "sol"), ("6", 1, "late")]
    state = Warehouse(house).pinned(spark)
    runs = {(p.month): p.run for p in state.parts_of(spark, FACT)}
    assert runs[1] != runs[2]  # February is as the first run wrote it
    assert checks.all_passed(state.read(spark, "checks"))
    with pytest.raises(ValueError, match="overwrite"):
        load(spark, tmp_path, house, [], overwrite="append")


# --- regions ---

def gazetteer(*names):
    return RegionParams(gazetteer={n: (n.lower(),) for n in names})


def test_region_ids_are_never_given_twice():
    first = keys.region_ids(gazetteer("Arica", "Iquique"))
    assert first == {"Arica": 1, "Iquique": 2, "Desconocida": 3}
    second = keys.region_ids(gazetteer("Iquique", "Talca"), first)
    assert second == {"Iquique": 2, "Talca": 4, "Desconocida": 3}
    assert keys.region_ids(gazetteer("Arica", "Talca"), first | second)["Arica"] == 1


def test_regions_keep_their_names_over_gazetteers(spark, tmp_path):
    house = str(tmp_path / "wh")
    named = lambda: sorted(map(tuple, Warehouse(house).fact(spark).join(
        Warehouse(house).read(spark, "dim_region"), "region_id").select(
        "article_id", "region_name", "region_version").collect()))
    with_regions = lambda *names: replace(SMALL, regions=gazetteer(*names))
    load(spark, tmp_path, house, ["1,2023-01-01,A,Arica,b,", "2,2023-01-01,A,Iquique,b,"], with_regions("Arica", "Iquique"))
    load(spark, tmp_path, house, ["3,2023-02-01,A,Arica,b,", "4,2023-02-01,A,Iquique,b,"], with_regions("Iquique", "Talca"))
    load(spark, tmp_path, house, ["5,2023-03-01,A,Arica,b,", "6,2023-03-01,A,Talca,b,"], with_regions("Arica", "Iquique"))
    expected = [("1", "Arica", 1), ("2", "Iquique", 1), ("3", "Desconocida", 2), ("4", "Iquique", 2),
                ("5", "Arica", 1), ("6", "Desconocida", 1)]
    assert named() == expected
    assert etl.rescore_regions(spark, house, with_regions("Arica", "Iquique"), years=(2022, 2022)) == []
    assert etl.rescore_regions(spark, house, with_regions("Arica", "Iquique")) == [(2023, 2)]
    assert named() == [*expected[:2], ("3", "Arica", 1), ("4", "Iquique", 1), *expected[4:]]
    assert facts(spark, house, "article_id", "title")[2] == ("3", "Arica")
    assert etl.rescore_regions(spark, house, with_regions("Arica", "Iquique")) == []


# --- counts and checks of changed months only ---

def test_only_changed_months_are_counted(spark, tmp_path, house, monkeypatch):
    analytics.run_queries(spark, house, params=SMALL)
    load(spark, tmp_path, house, ["7,2023-02-05,C,t,viento sol,", "8,2023-03-05,C,t,viento,"])
    read = []
    whole = Warehouse.fact

    def spied(self, session, years=None, parts=None):
        found = whole(self, session, years, parts)
        read.extend(found.inputFiles())
        return found

    monkeypatch.setattr(Warehouse, "fact", spied)
    words = analytics.run_queries(spark, house, params=SMALL).global_words
    assert read and all("month=02" in f or "month=03" in f for f in read)
    kept = analytics.warehouse_counts(spark, Warehouse(house), SMALL)
    again = analytics.warehouse_counts(spark, Warehouse(house), SMALL, refresh=True)
    for name, table in vars(kept).items():
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, getattr(again, name).collect()))
    assert sorted(map(tuple, words.collect())) == [
        ("arica", 1), ("iquique", 1), ("mar", 1), ("sol", 2), ("viento", 2)]
    assert analytics.count_months(spark, Warehouse(house), SMALL) == []


def test_kept_rows_are_picked_only_where_others_lie_beside(spark, tmp_path, house):
    analytics.run_queries(spark, house, params=SMALL)

    def kept():
        at = Warehouse(house).pinned(spark)
        return analytics.month_counts(spark, at, SMALL).read("terms", analytics.TERMS, at.parts_of(spark, FACT))

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    before = kept()
    assert "Join" not in plan(before) and before.count() > 2
    # February is replaced: the rows of the first update's February are still there, and not read.
    load(spark, tmp_path, house, ["7,2023-02-05,C,t,viento sol,"])
    analytics.run_queries(spark, house, params=SMALL)
    after = kept()
    assert "Join" in plan(after) and after.columns == before.columns
    assert sorted(r["word"] for r in after.where("month = 2").collect()) == ["sol", "viento"]
    assert sorted(map(tuple, after.where("month = 1").collect())) == sorted(map(tuple, before.where("month = 1").collect()))


def test_folded_report_is_that_of_all_facts(spark, tmp_path, house):
    """Also of facts that break the rules, which only a run without the usual steps writes."""
    run = Run(spark, house)
    old = run.before.fact(spark)
    bad = old.where("article_id in ('1', '3')").withColumns({
        "month": F.lit(4), "region_id": F.lit(99), "date_id": F.when(F.col("article_id") == "1", 77).otherwise(1)})
    more = bad.unionByName(bad.where("article_id = '1'")).unionByName(bad.withColumn("month", F.lit(5)))
    run.write_fact(more, set())
    run.publish()
    state = Warehouse(house).pinned(spark)
    index = ArticleIndex(spark, state.root, SMALL.index)
    raw = spark.createDataFrame([(3,)], "raw_rows long")
    months = spark.createDataFrame([(2023, 4), (2023, 5)], "year int, month int")
    dims = [state.read(spark, f"dim_{d}") for d in ("date", "source", "region")]
    folded = sorted(map(tuple, etl.folded_checks(spark, state, index, raw, months).collect()))
    full = checks.check_warehouse(state.fact(spark), *dims, raw, state.fact_partitions(spark), months)
    assert folded == sorted(map(tuple, full.collect()))
    assert {r[0]: r[2] for r in folded} == {
        "1-referential": 8, "2-row-count": 2, "3-primary-key/dim_date": 0, "3-primary-key/dim_source": 0,
        "3-primary-key/dim_region": 0, "4-partitions": 0, "5-unique-articles": 5}


# --- top k ---

@pytest.mark.parametrize("groups", [["g"], []])
def test_wide_top_is_ranked_in_pieces(spark, monkeypatch, groups):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), f"w{i}", rng.randrange(30)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, word string, n long")
    expected = sorted(map(tuple, analysis.top_per_group(df, groups, 50).collect()))
    monkeypatch.setattr(analysis, "TASK_RANKS", 10)
    wide = analysis.top_per_group(df, groups, 50, salts=7)
    assert sorted(map(tuple, wide.collect())) == expected
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") >= 2 and "_salt" in plan
