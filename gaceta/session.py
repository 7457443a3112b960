"""Session helpers: the shared folder, and joins whose broadcast is size-checked."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A build side above this many bytes of row data is never broadcast.
BROADCAST_BYTES = 64 << 20
# Rough cost of a hashed row beyond its own strings.
_ROW_OVERHEAD = 48
# Pieces a hot key is spread over when the build side is too big to broadcast.
SALTS = 32
# Folder of the job that is running, if one is.
_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def local_session(cpus: int | str = "*", app: str = "gaceta", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by the cluster in spark.checkpoint.dir.

    Only a session whose executors are threads of this process may do without the setting;
    it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="gaceta-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_job_folder.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside go to a folder of their own, deleted at the end.

    For jobs that write their results elsewhere; nothing made inside may be read later.
    """
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _job_folder.set(folder)
    try:
        yield
    finally:
        _job_folder.reset(token)
        delete(spark, folder)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, without hidden ones; none if there is no such folder."""
    files, path = _file_system(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def create_file(spark: SparkSession, name: str, text: str) -> bool:
    """Write a small file that must not be there yet; False if it is.

    It is written under another name first, so nobody sees half of it.
    """
    files, path = _file_system(spark, name)
    draft = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(path) or not files.rename(draft, path):
        files.delete(draft, False)
        return False
    return True


def together(*calls: Callable[[], Any]) -> list:
    """Run calls that do not wait for one another, so that their small jobs share the cluster."""
    with ThreadPoolExecutor(len(calls)) as pool:
        running = [pool.submit(copy_context().run, call) for call in calls]
        return [r.result() for r in running]


def materialize(df: DataFrame) -> DataFrame:
    """Run ``df`` once, into a Parquet table in the shared folder, and read that back.

    Cuts the lineage, survives lost executors, and unlike checkpointed rows the table can
    be read by column and has a size the optimizer knows.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, bytes) of the files under ``path``, one row each; none is opened."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (materialise it first) and say whether it may be broadcast."""
    size = F.lit(_ROW_OVERHEAD)
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            # As text a value is hardly ever shorter than half its size in memory.
            size = size + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            size = size + F.lit(16)
    total = df.agg(F.sum(size.cast("long")).alias("bytes")).first()["bytes"]
    return (total or 0) <= limit


def lookup_join(
    rows: DataFrame, small: DataFrame, on: str | list[str], spread: str | Column, how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join wide rows to a materialised lookup table.

    Within the byte limit the lookup side is broadcast, so the rows stay where they are.
    Beyond it the join shuffles with each key split over SALTS pieces by ``spread`` (a
    value that differs from row to row), so a hot or null key does not land in one task.
    Spark takes the copies for as large as the table on disk, so the hint keeps it from
    sending all of them to the driver for a broadcast of its own.
    """
    if fits_broadcast(small, limit):
        return rows.join(F.broadcast(small), on, how)
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = small.withColumn("_salt", F.explode(salts))
    salt: Column = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    keys = [on] if isinstance(on, str) else on
    return rows.withColumn("_salt", salt).join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")
