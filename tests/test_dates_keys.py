import datetime as dt

from pyspark.sql import functions as F

from gaceta import session
from gaceta.functions import dates
from gaceta.operators import keys


def test_parse_day(evaluate):
    cases = {
        "2023-1-5": dt.date(2023, 1, 5), " 2023-01-05 ": dt.date(2023, 1, 5),
        " 2023-01-05\t": dt.date(2023, 1, 5), "2023-02-30": None, "05/01/2023": None,
        "2023-01-05 10:00:00": None, "": None, None: None, "20230105": None, "0000-01-01": None,
        "2024-02-29": dt.date(2024, 2, 29), "12023-01-01": None,
    }
    assert evaluate(cases, lambda c: dates.parse_day(F.col(c))) == list(cases.values())


def test_dim_date(spark):
    raw = spark.createDataFrame(
        [("2023-01-01", 3), ("2024-12-30", 1), ("nonsense", 2), ("2023-1-1", 9), (None, 0)],
        "publish_date string, _seq long")
    got = [tuple(r) for r in keys.dim_date(keys.date_keys(raw)).orderBy("fecha").collect()]
    # The unreadable text keeps id 2; the two spellings of one day share id 3.
    assert got == [
        (3, "2023-01-01", 2023, 1, 1, "Domingo", 52),
        (1, "2024-12-30", 2024, 12, 30, "Lunes", 1),
    ]
    as_written = keys.dim_date(keys.date_keys(raw, canonical=False)).orderBy("date_id")
    assert [(r[0], r[1]) for r in as_written.collect()] == [
        (1, "2024-12-30"), (3, "2023-01-01"), (4, "2023-1-1")]


def test_dim_source_lowers_and_numbers_by_first_row(spark):
    raw = spark.createDataFrame(
        [("B.cl", 1), ("a.cl", 2), ("b.CL", 3), (None, 4), ("c.cl", 5)], "source string, _seq long")
    got = keys.dim_source(keys.source_keys(raw)).orderBy("source_id").collect()
    assert [tuple(r) for r in got] == [(1, "b.cl"), (2, "a.cl"), (3, "c.cl")]


def test_dense_ids_over_many_blocks(spark):
    step = 1 << (keys.BLOCK_BITS - 2)
    values = spark.range(1000).select(
        F.concat(F.lit("v"), F.col("id")).alias("v"), ((999 - F.col("id")) * step).alias("first_seq"))
    got = {r["v"]: r["k"] for r in keys.dense_ids(values, "k").collect()}
    assert got == {f"v{i}": 1000 - i for i in range(1000)}


def test_dim_region(spark):
    rows = keys.dim_region(spark).orderBy("region_id").collect()
    assert len(rows) == 17
    assert tuple(rows[0]) == (1, "Arica y Parinacota", "XV", "AR")
    assert tuple(rows[16]) == (17, "Desconocida", "—", "??")


def test_lookup_gives_default_and_both_joins_agree(spark):
    rows = spark.createDataFrame(
        [(i, None if i % 7 == 0 else "hot" if i % 3 else f"k{i}") for i in range(200)],
        "_seq long, k string")
    dim = spark.createDataFrame([("hot", 1), ("k3", 2), ("k9", 3)], "k string, k_id int")
    broadcast = keys.lookup_ids(rows, dim, "k", "k_id").orderBy("_seq").collect()
    salted_df = session.lookup_join(rows, dim, "k", spread="_seq", limit=0)
    salted = salted_df.withColumn("k_id", F.coalesce("k_id", F.lit(-1))).orderBy("_seq").collect()
    assert [r["k_id"] for r in broadcast] == [r["k_id"] for r in salted]
    expected = {"hot": 1, "k3": 2, "k9": 3}
    assert all(r["k_id"] == expected.get(r["k"], -1) for r in broadcast)


def test_salted_copies_are_not_broadcast(spark):
    rows = spark.range(100).selectExpr("id % 5 as k", "id as _seq")
    dim = session.materialize(spark.createDataFrame([(i, f"v{i}") for i in range(4)], "k long, v string"))
    joined = session.lookup_join(rows, dim, "k", spread="_seq", limit=0)
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert joined.where("v is null").count() == 20
