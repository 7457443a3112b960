import csv
import glob
import os
import warnings

import pytest
from pyspark.sql import functions as F

from gaceta import session
from gaceta.contract.articles import article_view
from gaceta.operators import checks
from gaceta.params import Params, QueryParams, TokenParams
from gaceta.plans import analytics, etl
from gaceta.schema import FACT_SCHEMA
from gaceta.sources import articles
from gaceta.sources.articles import scan_articles
from gaceta.sources.warehouse import CountStore, Warehouse, write_fact
from tests.conftest import SF

HEADER = "article_id,publish_date,source,title,body,extra"


def write(path, text, bom=False):
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


@pytest.mark.parametrize("bom", [False, True])
@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_edges(spark, tmp_path, bom, multi_line):
    lines = [
        HEADER,
        '1,2023-01-01,A,"t ""x"" y","one, two",',
        "2,2023-01-02,B,t2,b2,x,TOO MANY",
        "3,2023-01-03",
        "4,2023-01-04,NA,null,None,n/a",
        '5,2023-01-05,B,"a,b","c ""q, "" d",e,f',
        "6,2023-01-06,B,t,b,,",
        '7,2023-01-07,"",  pad  ,ñandú,z',
    ]
    path = write(tmp_path / "one file.csv", "\n".join(lines) + "\n", bom)
    rows = scan_articles(spark, path, multi_line=multi_line).orderBy("_seq").collect()
    assert [r["article_id"] for r in rows] == list("1234567")
    assert [r["article_id"] for r in rows if r["_over_long"]] == ["2", "5", "6"]
    assert [r["article_id"] for r in rows if r["_padded"]] == ["3"]
    assert tuple(rows[0])[:5] == ("1", "2023-01-01", "A", 't "x" y', "one, two")
    assert tuple(rows[2])[:5] == ("3", "2023-01-03", None, None, None)
    assert tuple(rows[3])[:5] == ("4", "2023-01-04", None, None, None)
    assert tuple(rows[6])[:5] == ("7", "2023-01-07", None, "  pad  ", "ñandú")


def test_csv_line_breaks_and_file_order(spark, tmp_path):
    # The second file is larger, so Spark schedules it first; the name decides all the same.
    write(tmp_path / "a b.csv", HEADER + '\n1,2023-01-01,A,t,"first\nline",\n')
    body = "".join(f"{i},2023-01-02,A,t,later {i},\n" for i in range(1, 400))
    write(tmp_path / "b c.csv", HEADER + "\n" + body)
    rows = scan_articles(spark, str(tmp_path)).orderBy("_seq").collect()
    assert [r["body"] for r in rows] == ["first\nline", *[f"later {i}" for i in range(1, 400)]]
    assert len({r["_seq"] for r in rows}) == 400


def test_positions_stay_unique_when_files_split(spark, tmp_path):
    for name in ("x.csv", "y.csv"):
        body = "".join(f"{name}{i},2023-01-02,A,title,text {i},\n" for i in range(5000))
        write(tmp_path / name, HEADER + "\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scanned = scan_articles(spark, str(tmp_path), multi_line=False)
        rows = scanned.orderBy("_seq").select("article_id", "_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["article_id"] for r in rows] == [f"{n}{i}" for n in ("x.csv", "y.csv") for i in range(5000)]
    assert len({r["_seq"] for r in rows}) == 10_000


def test_missing_column_is_named(spark, tmp_path):
    with pytest.raises(ValueError, match="body"):
        scan_articles(spark, write(tmp_path / "x.csv", "article_id,publish_date,source,title\n"))


def view_csv(spark, path, parts=1):
    rows = article_view(spark, SF).orderBy("_seq").drop("_seq").collect()
    path.mkdir()
    size = -(-len(rows) // parts)
    for p in range(parts):
        with open(path / f"part{p}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(rows[0].asDict())
            out.writerows(rows[p * size:(p + 1) * size])
    return str(path)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    articles = view_csv(spark, base / "csv")
    result, results = analytics.run_all(spark, articles, str(base / "wh"), str(base / "out"))
    return base, result, results


def test_etl_writes_the_star_schema(spark, built):
    base, result, _ = built
    fact = result.warehouse.fact(spark)
    assert fact.columns == [f.name for f in FACT_SCHEMA.fields] + ["year", "month"]
    assert glob.glob(f"{base}/wh/fact_news/run=*/year=2023/month=01/*.parquet")
    metrics = result.metrics.first().asDict()
    assert metrics["raw_rows"] == 200 and metrics["written"] == fact.count()
    assert metrics["raw_rows"] == sum(v for k, v in metrics.items() if k not in ("raw_rows", "padded"))
    report = {r["check"]: r for r in result.checks.collect()}
    assert len(report) == 7
    # Articles without a source are orphans of dim_source, and only they fail.
    failed = [c for c, r in report.items() if not r["passed"]]
    assert failed == ["1-referential"]
    missing = fact.where("source_id = -1").count()
    detail = report["1-referential"]["detail"]
    assert detail == f"facts without a dimension row: date=0, source={missing}, region=0"
    assert not checks.all_passed(result.checks)


def test_etl_can_raise(spark, built, tmp_path):
    base, _, _ = built
    with pytest.raises(etl.CheckFailure, match="1-referential"):
        etl.run_etl(spark, str(base / "csv"), str(tmp_path / "wh"), raise_on_failure=True)


def test_split_input_gives_the_same_fact(spark, built, tmp_path):
    _, result, _ = built
    two = etl.run_etl(spark, view_csv(spark, tmp_path / "csv", parts=3), str(tmp_path / "wh"))
    rows = lambda w: sorted(map(tuple, w.fact(spark).collect()))
    assert rows(two.warehouse) == rows(result.warehouse)


def test_untouched_months_stay(spark, built, tmp_path):
    lines = [HEADER, "1,2023-01-01,A,t,b,", "2,2023-02-01,A,t,b,"]
    one = write(tmp_path / "one.csv", "\n".join(lines) + "\n")
    two = write(tmp_path / "two.csv", HEADER + "\n9,2023-02-05,A,t,b,\n")
    house = str(tmp_path / "wh")
    etl.run_etl(spark, one, house)
    etl.run_etl(spark, two, house)
    ids = lambda: sorted(r[0] for r in Warehouse(house).fact(spark).select("article_id").collect())
    assert ids() == ["1", "9"]
    etl.run_etl(spark, two, house, overwrite="static")
    assert ids() == ["9"]


def star(house, spark):
    """(article, fecha, source) as the ids of the warehouse give them."""
    fact = house.fact(spark).join(house.read(spark, "dim_date"), "date_id", "left") \
        .join(house.read(spark, "dim_source"), "source_id", "left")
    return sorted(map(tuple, fact.select("article_id", "fecha", "source").collect()))


def test_ids_keep_their_meaning_over_runs(spark, tmp_path):
    batches = [
        ["1,2023-01-03,Alfa,t,b,", "2,2023-01-01,Beta,t,b,", "3,no date,Beta,t,b,"],
        ["4,2023-02-03,Gamma,t,b,", "5,2023-02-01,Beta,t,b,", "6,2022-12-01,Delta,t,b,"],
        ["7,2023-03-01,ALFA,t,b,", "8,2023-02-03,Omega,t,b,"],
    ]
    expected = [
        ("1", "2023-01-03", "alfa"), ("2", "2023-01-01", "beta"), ("4", "2023-02-03", "gamma"),
        ("5", "2023-02-01", "beta"), ("6", "2022-12-01", "delta"), ("7", "2023-03-01", "alfa")]
    house = str(tmp_path / "wh")
    for n, lines in enumerate(batches):
        path = write(tmp_path / f"{n}.csv", "\n".join([HEADER, *lines]) + "\n")
        result = etl.run_etl(spark, path, house, raise_on_failure=True)
        if n == 1:
            assert star(result.warehouse, spark) == expected[:5]
    # The third run replaces February.
    assert star(result.warehouse, spark) == sorted(
        [e for e in expected if e[0] not in "45"] + [("8", "2023-02-03", "omega")])
    dates = {r["fecha"]: r["date_id"] for r in result.warehouse.read(spark, "dim_date_keys").collect()}
    assert dates["no date"] == 3 and sorted(dates.values()) == list(range(1, len(dates) + 1))
    sources = result.warehouse.read(spark, "dim_source")
    assert sources.count() == sources.select("source").distinct().count() == 5
    # Ids shifted by one would not pass.
    shifted = sources.withColumn("source_id", F.col("source_id") + 1)
    report = checks.check_referential(
        result.warehouse.fact(spark), result.warehouse.read(spark, "dim_date"), shifted,
        result.warehouse.read(spark, "dim_region"))
    assert not checks.all_passed(report)


def test_counts_follow_parameters_and_data(spark, tmp_path):
    one = write(tmp_path / "one.csv", HEADER + "\n1,2023-01-01,A,sol marea,sol,\n2,2024-01-01,A,lluvia,sol,\n")
    two = write(tmp_path / "two.csv", HEADER + "\n3,2023-01-01,A,viento,viento,\n")
    house = str(tmp_path / "wh")
    etl.run_etl(spark, one, house)
    words = lambda **p: sorted(map(tuple, analytics.run_queries(
        spark, house, params=Params(**p)).global_words.collect()))
    only_2023 = words(query=QueryParams(years=(2023, 2023)))
    assert only_2023 == [("marea", 1), ("sol", 2)]
    assert words() == [("lluvia", 1), ("marea", 1), ("sol", 3)]
    assert words(tokens=TokenParams(min_length=4)) == [("lluvia", 1), ("marea", 1)]
    assert words(query=QueryParams(years=(2023, 2023))) == only_2023
    etl.run_etl(spark, two, house)
    assert words() == [("lluvia", 1), ("sol", 1), ("viento", 2)]


@pytest.mark.parametrize("lines", [
    [], ["1,no date,A,t,b,", ",2023-01-01,A,t,b,"], ["1,2023-01-01,A,de,la,"]])
def test_nothing_left_over(spark, tmp_path, lines):
    """No rows, every row rejected, no terms: all tables are there, and queries answer."""
    path = write(tmp_path / "one.csv", "\n".join([HEADER, *lines]) + "\n")
    result, found = analytics.run_all(spark, path, str(tmp_path / "wh"), str(tmp_path / "out"))
    metrics = result.metrics.first().asDict()
    assert metrics["raw_rows"] == len(lines)
    assert result.checks.count() == 7 and checks.all_passed(result.checks)
    assert result.warehouse.fact(spark).count() == metrics["written"]
    assert found.top_terms.count() == found.region_words.count() == found.kl.count() == 0
    again = analytics.run_queries(spark, str(tmp_path / "wh"))
    assert again.global_words.count() == 0 and again.series.count() == metrics["written"]


def test_position_column(spark, tmp_path):
    lines = ["1,2023-01-02,B,t,b,20", "1,2023-01-03,C,t,b,10", "2,2023-01-01,A,t,b,30"]
    path = write(tmp_path / "one.csv", "\n".join([HEADER, *lines]) + "\n")
    result = etl.run_etl(spark, path, str(tmp_path / "wh"), order_column="extra")
    assert star(result.warehouse, spark) == [("1", "2023-01-03", "c"), ("2", "2023-01-01", "a")]
    for extra, message in (("", "1 rows without"), ("10", "1 repeat")):
        bad = write(tmp_path / f"bad{extra}.csv", "\n".join([HEADER, *lines, f"3,2023-01-01,A,t,b,{extra}"]) + "\n")
        with pytest.raises(ValueError, match=message):
            etl.run_etl(spark, bad, str(tmp_path / f"wh{extra}"), order_column="extra")


def test_rows_of_an_unlisted_file_fail_the_job(spark, tmp_path, monkeypatch):
    for name in ("a.csv", "b.csv"):
        write(tmp_path / name, HEADER + "\n1,2023-01-01,A,t,b,\n")
    listed = session.list_files
    monkeypatch.setattr(session, "list_files", lambda s, p: listed(s, p).where("file like '%a.csv'"))
    with pytest.raises(Exception, match="file not listed"):
        scan_articles(spark, str(tmp_path)).collect()


def test_large_files_read_in_one_task_are_told(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "one.csv", HEADER + "\n1,2023-01-01,A,t,b,\n")
    monkeypatch.setattr(articles, "LARGE_FILE_BYTES", 10)
    with pytest.warns(UserWarning, match="1 article files"):
        scan_articles(spark, path)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        scan_articles(spark, path, multi_line=False)


def test_jobs_leave_no_scratch(spark, tmp_path):
    path = write(tmp_path / "one.csv", HEADER + "\n1,2023-01-01,A,t,b,\n")
    folder = session.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    etl.run_etl(spark, path, str(tmp_path / "wh"))
    assert set(os.listdir(folder)) == before


def test_dates_by_day_or_as_written(spark, tmp_path):
    lines = [HEADER, "1,2023-01-05,A,sol,mar,", "2,2023-1-5,A,sol,mar,", "3, 2023-01-05,a,sol,mar,"]
    path = write(tmp_path / "one.csv", "\n".join(lines) + "\n")
    days = {}
    for canonical in (True, False):
        house = str(tmp_path / f"wh-{canonical}")
        params = Params(canonical_dates=canonical)
        _, results = analytics.run_all(spark, path, house, params=params)
        days[canonical] = sorted((r["fecha"], r["n"]) for r in results.series.collect())
        assert results.kl.first()["source"] == "a"
    assert days[True] == [("2023-01-05", 3)]
    assert days[False] == [(" 2023-01-05", 1), ("2023-01-05", 1), ("2023-1-5", 1)]


def test_malformed_and_padded_lines_are_counted(spark, tmp_path):
    lines = [HEADER, "1,2023-01-05,A,t,b,", "2,2023-01-05,A,t,b,,x", "3,2023-01-05", ",2023-01-05,A,t,b,"]
    path = write(tmp_path / "one.csv", "\n".join(lines) + "\n")
    metrics = etl.run_etl(spark, path, str(tmp_path / "wh")).metrics.first().asDict()
    assert metrics == {
        "raw_rows": 4, "malformed": 1, "skipped_null": 1, "skipped_dup": 0, "bad_date": 0,
        "written": 2, "padded": 1, "skipped_known": 0,
    }


def test_results_and_reports(spark, built):
    base, _, results = built
    text = lambda name: [
        line for f in sorted(glob.glob(f"{base}/out/{name}/part-*")) for line in open(f, encoding="utf-8").read().split("\n")]
    top = results.top_terms.orderBy("year", "month", "rank").collect()
    expected = [f"{r['year']}-{r['month']:02d}, {r['term']}, {r['n']}" for r in top]
    assert [line for line in text("top_terms_month") if line] == expected
    region = text("words_region")
    assert region[0].startswith("Región: ") and region[1].startswith("  ")
    assert sum(line.startswith("Región: ") for line in region) == results.region_words.select("region_id").distinct().count()
    assert text("kl_source")[0] == "fuente,kl_divergencia"
    assert text("daily_series")[0] == "fecha,articulos,promedio_movil_7d,es_peak"
    assert text("daily_series")[1].endswith(",,0")
    assert "palabra,f_g" in text("words_global")


def test_counts_are_reused_until_refreshed(spark, built):
    _, result, _ = built
    house = result.warehouse
    runs = lambda: session.list_names(spark, house.path("counts"))
    before = runs()
    analytics.run_queries(spark, house.root)
    assert runs() == before
    analytics.run_queries(spark, house.root, refresh=True)
    assert len(runs()) == len(before) + 1


def test_counts_as_json(spark, built, tmp_path):
    _, result, _ = built
    kept = analytics.warehouse_counts(spark, result.warehouse)
    analytics.write_counts_json(kept, str(tmp_path))
    back = analytics.read_counts_json(spark, str(tmp_path))
    for name, table in vars(kept).items():
        again = getattr(back, name)
        assert again.columns == table.columns
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, table.collect()))


def test_unfinished_counts_are_not_used(spark, tmp_path):
    store = CountStore(spark, str(tmp_path / "counts"))
    run = store.new_run()
    store.write(run, "terms", spark.range(3))
    assert store.current() is None
    store.publish(run)
    assert store.current() == run and store.read(run, "terms", "id long").count() == 3


def test_partitions_on_disk(spark, built):
    _, result, _ = built
    months = lambda df: sorted(map(tuple, df.select("year", "month").distinct().collect()))
    house = result.warehouse
    assert months(house.fact_partitions(spark)) == months(house.fact(spark))


def test_hot_month_is_cut_into_files(spark, tmp_path):
    fact = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("string").alias("article_id"), F.sha2(F.col("id").cast("string"), 512).alias("body"),
        F.lit(2024).alias("year"), F.when(F.col("id") % 50 == 0, 2).otherwise(1).alias("month"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "500k")
    try:
        write_fact(fact, str(tmp_path / "fact"))
    finally:
        spark.conf.set(name, before)
    files = lambda month: glob.glob(f"{tmp_path}/fact/year=2024/month={month}/*.parquet")
    assert len(files("01")) > 3 and len(files("02")) == 1
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 40_000


def test_years_prune_partitions(spark, built):
    _, result, _ = built
    scan = result.warehouse.fact(spark, (2023, 2023)).select("article_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<article_id:string>" in plan


def test_each_check_sees_its_fault(spark):
    fact = spark.createDataFrame(
        [("a", 1, 1, 1, 2023, 1), ("a", 2, 9, 1, 2023, 2), ("c", 1, -1, 40, 2023, 1)],
        "article_id string, date_id int, source_id int, region_id int, year int, month int")
    date = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2), (2, 2023, 2)], "date_id int, anio int, mes int")
    source = spark.createDataFrame([(1, "x")], "source_id int, source string")
    region = spark.createDataFrame([(1, "r")], "region_id int, region_name string")
    raw = spark.createDataFrame([(2,)], "raw_rows long")
    report = checks.check_warehouse(fact, date, source, region, raw, fact.where("month = 1"))
    got = {r["check"]: r["violations"] for r in report.collect()}
    assert got == {
        "1-referential": 3, "2-row-count": 1, "3-primary-key/dim_date": 1,
        "3-primary-key/dim_source": 0, "3-primary-key/dim_region": 0, "4-partitions": 1,
        "5-unique-articles": 1,
    }
    empty = checks.check_warehouse(fact.limit(0), date.limit(1), source, region, raw)
    assert checks.all_passed(empty)
