"""The warehouse on disk: tables made of parts, states that name the parts, and reusable counts.

A run writes its parts next to those of earlier runs, ``<table>/run=<id>/...``, and then a
state: the list of all parts that make up the tables from now on. A small file that is
written last makes that state the current one. Until then readers see the state before, whole;
a run that breaks off has changed nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaceta import session
from gaceta.functions.dates import two_digit_month
from gaceta.schema import FACT_SCHEMA, PARTITION_FIELDS, TABLE_SCHEMAS

FACT = "fact_news"
# A table of more parts than this is rewritten as one when rows are added.
MAX_PARTS = 32
_PART_SCHEMA = "table string, run string, year int, month int"


@dataclass(frozen=True)
class Part:
    """What one run wrote of a table; of the fact table, one month of it."""

    table: str
    run: str
    year: int | None = None
    month: int | None = None

    @property
    def folder(self) -> str:
        month = f"/year={self.year}/month={self.month:02d}" if self.year is not None else ""
        return f"{self.table}/run={self.run}{month}"


class StaleState(Exception):
    """Another run has published a state since this one began."""


@dataclass(frozen=True)
class Warehouse:
    """The tables under one root folder: those of the current state, or of given ``parts``.

    The number of parts is bounded by the calendar and ``MAX_PARTS``, so they are kept as a list.
    """

    root: str
    parts: tuple[Part, ...] | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def last_state(self, spark: SparkSession) -> int:
        """The number of the current state; 0 before the first."""
        return max((int(name) for name in session.list_names(spark, self.path("current"))), default=0)

    def state(self, spark: SparkSession, number: int) -> "Warehouse":
        """The warehouse as a state of this number has it."""
        if number == 0:
            return Warehouse(self.root, ())
        row = spark.read.text(self.path(f"current/{number:08d}")).first()
        rows = spark.read.schema(_PART_SCHEMA).parquet(self.path(f"states/{row['value']}")).collect()
        return Warehouse(self.root, tuple(Part(*r) for r in rows))

    def pinned(self, spark: SparkSession) -> "Warehouse":
        """The current state, which later runs do not change under a reader's hands."""
        return self if self.parts is not None else self.state(spark, self.last_state(spark))

    def parts_of(
        self, spark: SparkSession, table: str, years: tuple[int, int] | None = None,
    ) -> list[Part]:
        parts = [p for p in self.pinned(spark).parts if p.table == table]
        return [p for p in parts if years is None or years[0] <= p.year <= years[1]]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        found = self.known(spark, table)
        if found is None:
            raise ValueError(f"{self.root} has no table {table}")
        return found

    def known(self, spark: SparkSession, table: str) -> DataFrame | None:
        """A table if it has been written before."""
        folders = [self.path(p.folder) for p in self.parts_of(spark, table)]
        if not folders:
            return None
        reader = spark.read
        if table in TABLE_SCHEMAS:
            reader = reader.schema(TABLE_SCHEMAS[table])
        return reader.parquet(*folders)

    def fact(
        self, spark: SparkSession, years: tuple[int, int] | None = None,
        parts: list[Part] | None = None,
    ) -> DataFrame:
        """The fact table, or given parts of it; other months' files are not even listed.

        ``years`` (first, last) leaves out the months of other years.
        """
        parts = self.parts_of(spark, FACT, years) if parts is None else parts
        schema = T.StructType([*FACT_SCHEMA.fields, *PARTITION_FIELDS])
        if not parts:
            return spark.createDataFrame([], schema)
        fact = spark.read.schema(schema).option("basePath", self.path(FACT)).parquet(
            *[self.path(p.folder) for p in parts]).select(*schema.names)
        return fact.where(F.col("year").between(*years)) if years else fact

    def fact_partitions(self, spark: SparkSession) -> DataFrame:
        """(year, month) of the fact files on disk: one row per file, no file is opened."""
        folders = [self.path(p.folder) for p in self.parts_of(spark, FACT)]
        if not folders:
            return spark.createDataFrame([], T.StructType(PARTITION_FIELDS))
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
            "recursiveFileLookup", True).load(folders)
        level = lambda name: F.regexp_extract(
            F.col("_metadata.file_path"), f"/{name}=([0-9]+)/", 1).cast("int").alias(name)
        return files.select(level("year"), level("month"))

    def begin(self, spark: SparkSession) -> "Run":
        return Run(spark, self.root)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Delete the parts that none of the last ``keep`` states names; their folders.

        Not while a run or a reader of an older state is at work.
        """
        last = self.last_state(spark)
        states = [self.state(spark, n) for n in range(max(1, last - keep + 1), last + 1)]
        live = {p.folder for s in states for p in s.parts}
        runs = {"/".join(folder.split("/")[:2]) for folder in live}
        gone = []
        for table in {p.split("/")[0] for p in live}:
            for run in session.list_names(spark, self.path(table)):
                folder = f"{table}/{run}"
                if folder not in runs:
                    gone.append(folder)
                elif table == FACT:
                    months = [f"{folder}/{y}/{m}" for y in session.list_names(spark, self.path(folder))
                              if y.startswith("year=") for m in session.list_names(spark, self.path(f"{folder}/{y}"))]
                    gone += [m for m in months if m not in live]
        for folder in gone:
            session.delete(spark, self.path(folder))
        return sorted(gone)


class Run:
    """One load of a warehouse: parts are added to those of the state it began with.

    ``house`` reads the tables as they will be. Nothing of it shows elsewhere until
    ``publish``, which fails if another run has been faster.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.id, self.root, self._lock = spark, uuid.uuid4().hex, root, Lock()
        house = Warehouse(root)
        self.number = house.last_state(spark)
        self.before = house.state(spark, self.number)
        self.parts = list(self.before.parts)

    @property
    def house(self) -> Warehouse:
        return Warehouse(self.root, tuple(self.parts))

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}/run={self.id}"

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """The rows are the table from now on."""
        df.write.parquet(self.folder(table))
        self._put(table, lambda p: False)
        return self.house.read(self.spark, table)

    def append(self, table: str, rows: DataFrame, order: str) -> None:
        """Add rows, sorted by ``order``; rows that are there stay as they are."""
        old = [p for p in self.parts if p.table == table]
        full = len(old) >= MAX_PARTS
        if full:
            rows = self.house.read(self.spark, table).unionByName(rows)
        elif old and rows.isEmpty():
            return
        rows.orderBy(order).write.parquet(self.folder(table))
        self._put(table, lambda p: not full)

    def _put(self, table: str, stays, months: Sequence[tuple] = ((),)) -> None:
        with self._lock:  # tables may be written at the same time
            self.parts = [p for p in self.parts if p.table != table or stays(p)] + [
                Part(table, self.id, *month) for month in months]

    def write_fact(self, fact: DataFrame, replaced: set[tuple[int, int]] | None) -> None:
        """Write months of the fact table; ``replaced``: which ones go, None for all.

        A month that goes and gets no rows is empty afterwards.
        """
        write_fact(fact, self.folder(FACT))
        written = {
            (int(y.removeprefix("year=")), int(m.removeprefix("month=")))
            for y in session.list_names(self.spark, self.folder(FACT)) if y.startswith("year=")
            for m in session.list_names(self.spark, f"{self.folder(FACT)}/{y}")}
        stays = lambda p: replaced is not None and (p.year, p.month) not in replaced | written
        self._put(FACT, stays, sorted(written))

    def publish(self) -> Warehouse:
        """Make the parts the current state of the warehouse."""
        rows = [(p.table, p.run, p.year, p.month) for p in self.parts]
        self.spark.createDataFrame(rows, _PART_SCHEMA).coalesce(1).write.parquet(
            f"{self.root}/states/{self.id}")
        pointer = f"{self.root}/current/{self.number + 1:08d}"
        if not session.create_file(self.spark, pointer, self.id):
            raise StaleState(f"state {self.number + 1} of {self.root} has been published by another run")
        return self.house


def write_fact(fact: DataFrame, path: str) -> None:
    """Write fact rows by year and month.

    Rows are rebalanced by partition value first: adaptive execution cuts a month that is
    larger than the advisory partition size into several tasks and files, and joins small
    ones, so neither one hot month nor many tiny files arise.
    """
    (
        fact.hint("rebalance", "year", "month")
        .withColumn("month", two_digit_month(F.col("month")))
        .write.partitionBy("year", "month").parquet(path)
    )


class PartStore:
    """Tables derived from the fact, kept per part of it: made once, and valid while the part is.

    ``<root>/<table>/run=<id>`` holds what one update made of the parts that were new then;
    ``<root>/done/run=<id>`` names those parts and is written last, so an update that broke
    off counts for nothing. Rows have the columns year, month and fact_run of their part.
    """

    DONE = "year int, month int, fact_run string"
    _KEYS = ["year", "month", "fact_run"]

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _noted(self) -> list[Row]:
        """All parts that updates were made of, with the update; as many as parts there were."""
        if not session.list_names(self.spark, f"{self.root}/done"):
            return []
        return self.spark.read.schema(f"{self.DONE}, run string").parquet(f"{self.root}/done").collect()

    def _done(self, parts: list[Part], noted: list[Row] | None = None) -> dict[Part, str]:
        """The last update that each of the parts was done in."""
        asked = {(p.year, p.month, p.run): p for p in parts}
        found: dict[Part, str] = {}
        for r in sorted(self._noted() if noted is None else noted, key=lambda r: r["run"]):
            if part := asked.get((r["year"], r["month"], r["fact_run"])):
                found[part] = r["run"]
        return found

    def missing(self, parts: list[Part]) -> list[Part]:
        done = self._done(parts)
        return [p for p in parts if p not in done]

    def add(self, parts: list[Part], tables: dict[str, DataFrame], by: dict[str, str] | None = None) -> None:
        """Keep tables made of ``parts``. Rows with year and month get the part's name; others none.

        ``by`` names a column per table to partition the files by.
        """
        run = f"t{time.time_ns():020d}-{uuid.uuid4().hex}"
        named = self._frame([(p.year, p.month, p.run) for p in parts], self.DONE).coalesce(1)

        def write(name: str, df: DataFrame) -> None:
            if "year" in df.columns:
                df = df.join(F.broadcast(named), ["year", "month"])
            writer = df.write
            (writer.partitionBy(by[name]) if by and name in by else writer).parquet(f"{self.root}/{name}/run={run}")

        session.together(*[partial(write, *item) for item in tables.items()])
        named.write.parquet(f"{self.root}/done/run={run}")

    def _frame(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def read(self, name: str, schema: str, parts: list[Part]) -> DataFrame:
        """The rows of ``parts``; ``schema`` lists the columns beyond those of the part.

        Rows are picked by their part only where an update holds others as well.
        """
        noted = self._noted()
        done = self._done(parts, noted)
        full = f"{schema}, {self.DONE}"
        if not done:
            return self._frame([], full)
        picked = {(p.year, p.month, p.run, run) for p, run in done.items()}
        runs = set(done.values())
        rows = self._runs(name, full, runs)
        if any(tuple(r) not in picked for r in noted if r["run"] in runs):
            live = self._frame(sorted(picked), f"{self.DONE}, run string")
            rows = rows.join(F.broadcast(live), [*self._KEYS, "run"], "left_semi")
        rest = [c for c in rows.columns if c not in (*self._KEYS, "run")]
        return rows.select(*self._KEYS, *rest)

    def read_whole(self, name: str, schema: str, parts: list[Part]) -> DataFrame:
        """All rows of the updates that did any of ``parts``; for tables without their columns."""
        runs = set(self._done(parts).values())
        return self._runs(name, schema, runs).drop("run") if runs else self._frame([], schema)

    def _runs(self, name: str, schema: str, runs: set[str]) -> DataFrame:
        reader = self.spark.read.schema(f"{schema}, run string").option("basePath", f"{self.root}/{name}")
        return reader.parquet(*[f"{self.root}/{name}/run={r}" for r in sorted(runs)])


def _try_read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


class CountStore:
    """Materialised counts that later runs can reuse.

    Every run writes into a folder of its own. ``current/<what>`` names the last finished
    run for one set of parameters and one state of the warehouse, together its ``what``; it
    is written last, so a broken run is never taken for a result.
    """

    def __init__(self, spark: SparkSession, root: str, what: str = "all"):
        self.spark, self.root, self.what = spark, root, what

    def new_run(self) -> str:
        return f"run-{uuid.uuid4().hex}"

    def write(self, run: str, name: str, counts: DataFrame, by: str | None = None) -> DataFrame:
        writer = counts.write.mode("overwrite")
        path = f"{self.root}/{run}/{name}"
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.read(run, name, counts.schema)

    def publish(self, run: str) -> None:
        row = self.spark.createDataFrame([(run,)], "run string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/current/{self.what}")

    def current(self) -> str | None:
        table = _try_read(self.spark, f"{self.root}/current/{self.what}")
        row = table.first() if table is not None else None
        return row["run"] if row else None

    def read(self, run: str, name: str, schema: T.StructType | str) -> DataFrame:
        """With the schema given, counts of nothing can be read as well."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/{run}/{name}")
