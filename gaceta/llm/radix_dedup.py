"""Exact deduplication by MSD radix partitioning: texts split by successive bytes.

Texts are compared after lower-casing A-Z. A group of texts that agree so far is split by
its next bytes until it holds one text only or its texts have ended; no digest decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaceta import session
from gaceta.llm import columns


KEYS = ["gid", "len", "digit"]
OWN = ("keep_id", "group_size", "kept")


@dataclass(frozen=True)
class RadixParams:
    # Bytes of the first digit, and by how much each next one is longer.
    digit: int = 32
    growth: int = 8
    longest_digit: int = 1 << 16
    # A group this large is split across the cluster, not inside a task: bytes, or rows, or
    # fewer rows that are also at least 1/hot_groups of all rows in groups.
    hot_bytes: int = 64 << 20
    most_rows: int = 1 << 20
    hot_rows: int = 1000
    hot_groups: int = 2000
    broadcast_bytes: int = session.BROADCAST_BYTES


def split_groups(texts: list[bytes], digit: int, growth: int) -> list[list[int]]:
    """Indices of equal texts, group by group, by recursive splitting on successive bytes."""
    groups, open_groups = [], [(0, digit, range(len(texts)))]
    while open_groups:
        at, width, members = open_groups.pop()
        if len(members) == 1:
            groups.append(list(members))
            continue
        buckets = defaultdict(list)
        for i in members:
            buckets[texts[i][at:at + width]].append(i)
        for piece, bucket in buckets.items():
            if len(bucket) == 1 or len(piece) < width:
                groups.append(bucket)
            else:
                open_groups.append((at + width, min(width * growth, 1 << 16), bucket))
    return groups


def _finish_in_task(digit: int, growth: int):
    """Arrow batches sorted by group key -> the same rows with (keep_id, group_size, kept).

    Rows of a group arrive together, so only the last group of a batch waits for the next.
    """
    def judge(rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_pylist()
        texts = [t.lower() for t in rows.column("bytes").to_pylist()]
        keep, size, kept = [None] * len(ids), [1] * len(ids), [True] * len(ids)
        for group in split_groups(texts, digit, growth):
            best = max(group, key=lambda i: (ids[i] is not None, ids[i] or 0))
            for i in group:
                keep[i], size[i], kept[i] = ids[best], len(group), i == best
        own = [pa.array(keep, pa.int64()), pa.array(size, pa.int64()), pa.array(kept, pa.bool_())]
        inputs = [c for c in rows.column_names if c.startswith("in_")]
        return pa.table([*[rows.column(c) for c in inputs], *own], names=[*inputs, *OWN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        key_of = lambda b, i: (b.column("gid")[i].as_py(), b.column("len")[i].as_py(),
                               b.column("digit")[i].as_py())
        for batch in batches:
            if not batch.num_rows:
                continue
            last = key_of(batch, batch.num_rows - 1)
            low, high = 0, batch.num_rows - 1  # first row of the last group, by bisection
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if key_of(batch, middle) == last else (middle + 1, high)
            if low == 0 and (not waiting or key_of(waiting[-1], waiting[-1].num_rows - 1) == last):
                waiting.append(batch)
                continue
            done = [*waiting, batch.slice(0, low)]
            yield from judge(pa.Table.from_batches(done)).to_batches()
            waiting = [batch.slice(low)]
        if waiting:
            yield from judge(pa.Table.from_batches(waiting)).to_batches()

    return run


def _with_digit(rows: DataFrame, text: Column, at: int, width: int) -> DataFrame:
    """Adds ``width`` bytes from ``at`` on, lowered, each byte as the Latin-1 character it is."""
    piece = F.substring(F.coalesce(text, F.lit("")).cast("binary"), at + 1, width)
    return rows.withColumn("digit", columns.ascii_lower(F.decode(piece, "ISO-8859-1")))


def _groups(rows: DataFrame, *more: Column) -> DataFrame:
    """Size of every group of rows that agree in length, digit and all digits before."""
    counts = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("len").alias("bytes"), *more)
    return counts.withColumn("next_gid", F.monotonically_increasing_id())


def _hot(groups: DataFrame, params: RadixParams) -> Column:
    rows = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    return (F.col("bytes") >= params.hot_bytes) | (F.col("n") >= params.most_rows) | (
        (F.col("n") >= params.hot_rows) & (F.col("n") >= rows / params.hot_groups))


def _in_tasks(part: DataFrame, inputs: list[str], text: Column, params: RadixParams) -> DataFrame:
    """Every group whole in one task, where it is split to the end."""
    schema = T.StructType([
        *[T.StructField(c, part.schema[c].dataType) for c in inputs],
        T.StructField("keep_id", T.LongType()), T.StructField("group_size", T.LongType()),
        T.StructField("kept", T.BooleanType())])
    placed = part.select(*inputs, "id", *KEYS).repartition(*KEYS).sortWithinPartitions(*KEYS)
    bytes_ = F.coalesce(text, F.lit("")).cast("binary").alias("bytes")
    return placed.select("*", bytes_).mapInArrow(
        _finish_in_task(params.digit, params.growth), schema)


def exact_duplicates(docs: DataFrame, params: RadixParams = RadixParams()) -> DataFrame:
    """All rows of ``docs`` with ``keep_id``, ``group_size`` and ``kept``.

    Rows whose texts are equal after lower-casing A-Z form a group; null counts as empty.
    The row with the largest doc_id stays (of several with that id, one); null ids are the
    smallest. An empty table gives an empty result. Other columns come along, except ones
    with the names of the three new columns.

    Length and the first bytes split the rows first. Rows alone in their group are done.
    Small groups go to tasks, whole groups each, and are split on there. Groups too large
    for that (a third of all rows may be one text) are split across the cluster digit by
    digit: partial aggregation counts a digit, and only the counts of groups move.
    """
    names = [c for c in docs.columns if c not in OWN]
    # Inside, input columns go by number, so their names cannot clash with anything.
    inputs = [f"in_{i}" for i in range(len(names))]
    text = F.col(inputs[names.index("text")])
    rows = _with_digit(
        docs.select(*[F.col(c).alias(i) for c, i in zip(names, inputs)],
                    F.col("doc_id").cast("long").alias("id"), F.lit(0).cast("long").alias("gid"),
                    F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("len")),
        text, 0, params.digit)
    repeated = session.materialize(_groups(rows).where("n > 1"))
    hot = _hot(repeated, params)
    in_tasks = lambda part: _in_tasks(part, inputs, text, params)
    results = []
    if session.fits_broadcast(repeated, params.broadcast_bytes):
        # Few groups: rows alone in theirs are told on the spot and stay where they are.
        small = repeated.select(*KEYS, hot.alias("hot"), "next_gid")
        marked = rows.join(F.broadcast(small), KEYS, "left")
        results.append(marked.where("hot is null").select(
            *inputs, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept")))
        results.append(in_tasks(marked.where("not hot")))
    else:
        # Many groups: all rows but the hot ones move once.
        large = session.materialize(
            repeated.where(hot).select(*KEYS, F.lit(True).alias("hot"), "next_gid"))
        marked = session.lookup_join(rows, large, KEYS, F.col("id"), limit=params.broadcast_bytes)
        results.append(in_tasks(marked.where("hot is null")))
    live = marked.where("hot") if repeated.where(hot).head(1) else None

    at, width = params.digit, params.digit
    while live is not None:
        width = min(width * params.growth, params.longest_digit)
        # Written with row numbers, so that of rows with one id exactly one can be named.
        live = _with_digit(session.materialize(live.select(
            *inputs, "id", "len", F.col("next_gid").alias("gid"),
            F.monotonically_increasing_id().alias("uid"))), text, at, width)
        groups = session.materialize(_groups(live, F.max(F.struct("id", "uid")).alias("best")))
        large = session.materialize(groups.where(_hot(groups, params)).select(
            *KEYS, "n", F.col("best.id").alias("best_id"), F.col("best.uid").alias("best_uid"),
            "next_gid", (F.col("len") <= at + width).alias("ended")))
        marked = session.lookup_join(live, large, KEYS, "uid", limit=params.broadcast_bytes)
        results.append(marked.where("ended").select(
            *inputs, F.col("best_id").alias("keep_id"), F.col("n").alias("group_size"),
            (F.col("uid") == F.col("best_uid")).alias("kept")))
        results.append(in_tasks(marked.where("ended is null")))
        at += width
        live = marked.where("not ended") if large.where("not ended").head(1) else None

    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select(*[F.col(i).alias(c) for c, i in zip(names, inputs)], *OWN)
