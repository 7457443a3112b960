"""Vectors as one byte per part: codebooks by rounds of means, nearest entries by Orchard's search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaceta import session

# Components beyond this many units stand at it, so that all sums are exact in 64 bits.
LARGEST = 1 << 28


@dataclass(frozen=True)
class CodeParams:
    parts: int = 16
    # At most 64: a search marks the entries it has visited in one long.
    entries: int = 64
    rounds: int = 2
    # Units that one is divided into.
    units: int = 256
    # Vectors that are searched for at a time.
    block: int = 1 << 13


class Orchard:
    """Nearest entry of one codebook, for many queries at once.

    Every entry has a list of the others by distance. A search takes the list of the best entry so far
    in order; an entry that is nearer (or as near and of lower number) makes the search go on
    in its own list. Entries once visited are passed over. It ends where the list's distance
    from its owner exceeds twice the distance of the query: by the triangle inequality
    nothing beyond is as near. Distances are squared, so twice is four times.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.order = np.argsort(apart, axis=1, kind="stable")
        # A last place that ends every search.
        self.apart = np.concatenate([
            np.take_along_axis(apart, self.order, axis=1),
            np.full((len(entries), 1), np.iinfo(np.int64).max)], axis=1)
        self.order = np.concatenate([self.order, np.zeros((len(entries), 1), np.int64)], axis=1)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each query's nearest entry; the lowest of those tied."""
        best = np.zeros(len(queries), np.int64)
        near = ((queries - self.entries[0]) ** 2).sum(axis=1)
        one = np.uint64(1)
        # Of the searches that go on: query, owner of the list, place in it, distance, visited.
        todo, owner = np.arange(len(queries)), best.copy()
        place, dist = np.zeros(len(queries), np.int64), near.copy()
        visited = np.full(len(queries), one)
        while len(todo):
            live = self.apart[owner, place] <= 4 * dist
            if not live.all():
                ended = ~live
                best[todo[ended]], near[todo[ended]] = owner[ended], dist[ended]
                todo, owner, place, dist, visited = (x[live] for x in (todo, owner, place, dist, visited))
                if not len(todo):
                    break
            entry = self.order[owner, place]
            place += 1
            bit = one << entry.astype(np.uint64)
            fresh = np.flatnonzero(visited & bit == 0)
            if not len(fresh):
                continue
            visited |= bit
            entry = entry[fresh]
            found = ((queries[todo[fresh]] - self.entries[entry]) ** 2).sum(axis=1)
            better = (found < dist[fresh]) | ((found == dist[fresh]) & (entry < owner[fresh]))
            jump = fresh[better]
            owner[jump], dist[jump], place[jump] = entry[better], found[better], 0
        return best, near


def whole_vectors(embeddings: DataFrame, params: CodeParams, column: str = "embedding") -> DataFrame:
    """(row, v): the rows whose vector is whole, ``v`` its components in units, rounded down."""
    vector = F.col(f"`{column}`")
    number = lambda x: x.cast("double")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))
    unit = lambda x: F.greatest(F.least(F.floor(number(x) * params.units), F.lit(LARGEST)), F.lit(-LARGEST))
    inside = lambda x: F.greatest(F.least(number(x), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    return embeddings.where(vector.isNotNull() & sound).select(
        F.struct("*").alias("row"), F.transform(vector, lambda x: unit(inside(x))).alias("v"))


def _batch(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _assign(books: np.ndarray, vectors: np.ndarray, searches: list[Orchard], block: int):
    """(codes, distances), one row per vector and one column per part."""
    parts, _, width = books.shape
    codes = np.zeros((len(vectors), parts), np.int64)
    dist = np.zeros_like(codes)
    for i in range(0, len(vectors), block):
        for part, search in enumerate(searches):
            queries = np.ascontiguousarray(vectors[i:i + block, part * width:(part + 1) * width])
            codes[i:i + block, part], dist[i:i + block, part] = search.nearest(queries)
    return codes, dist


def _sums(books: np.ndarray, block: int):
    """Arrow batches of vectors -> (part, entry, n, total) over all batches of a task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in books]
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            vectors = _batch(batch.column("v"), parts * width)
            codes, _ = _assign(books, vectors, searches, block)
            for part in range(parts):
                n[part] += np.bincount(codes[:, part], minlength=entries)
                np.add.at(total[part], codes[:, part], vectors[:, part * width:(part + 1) * width])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            ["part", "entry", "n", "total"])

    return run


def fit_codebooks(vectors: DataFrame, params: CodeParams = CodeParams(), vec_id: str = "vec_id") -> np.ndarray | None:
    """Codebooks (part, entry, component) of ``whole_vectors``; None if there is nothing to fit.

    An entry starts as its part of one of the smallest ids' vectors, in order of the ids; an
    id that repeats gives its smallest vector. All vectors are assigned in every round, and
    only sums per part and entry come to the driver, as many as the codebooks have numbers.
    """
    usable = vectors.select(F.col("row").getField(vec_id).alias("id"), "v").where(
        F.col("id").isNotNull() & (F.size("v") > 0) & (F.size("v") % params.parts == 0))
    smallest = usable.select("id", F.size("v").alias("size")).orderBy("id", "size").first()
    if smallest is None:
        return None
    size = smallest["size"]
    usable = usable.where(F.size("v") == size)
    # Ids alone are made distinct; the vectors of the chosen ones are read back.
    chosen = usable.select("id").distinct().orderBy("id").limit(params.entries)
    first = usable.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("v").alias("v")).orderBy("id")
    start = np.array([r["v"] for r in first.collect()], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), params.parts, -1).transpose(1, 0, 2))
    fitting = vectors.where(F.size("v") == size).select("v")
    for _ in range(params.rounds):
        sums = fitting.mapInArrow(
            _sums(books, params.block), "part long, entry long, n long, total array<long>")
        each = sums.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
        summed = each.groupBy("part", "entry", "at").agg(
            F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
        new = books.copy()
        for r in summed.collect():
            new[r["part"], r["entry"], r["at"]] = int(r["x"]) // r["n"]
        books = new
    return books


def _codes(books: np.ndarray, block: int, names: list[str]):
    """Arrow batches (row, v) -> (row, code, error)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in books]
        for batch in batches:
            vectors = _batch(batch.column("v"), books.shape[0] * books.shape[2])
            codes, dist = _assign(books, vectors, searches, block)
            text = [c.tobytes().hex() for c in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(text, pa.string()), pa.array(dist.sum(axis=1))], names)

    return run


def compress(embeddings: DataFrame, params: CodeParams = CodeParams()) -> tuple[DataFrame, np.ndarray]:
    """Every row with a whole vector plus ``code`` and ``error``, and the codebooks.

    Rows whose vector is null or holds a null or non-finite component are left out. Every
    component becomes a whole number of units, rounded down, and at most 2^28 units either
    way. The vectors' length is that of the smallest id whose length the parts divide; rows
    of other lengths are left out. ``code`` has two hex digits per part: the number of the
    nearest entry, the lower of two as near. ``error`` is the sum of the squared distances.
    Fewer ids than entries give smaller codebooks. Rows without id are coded and start no
    entry; repeated rows are coded one by one. A table without whole vectors gives no rows.
    """
    vectors = whole_vectors(embeddings, params)
    books = fit_codebooks(vectors, params)
    fields = embeddings.select(F.struct("*").alias("row")).schema.add("code", "string").add("error", "long")
    if books is None:
        return embeddings.sparkSession.createDataFrame([], fields), np.zeros((params.parts, 0, 0), np.int64)
    sized = vectors.where(F.size("v") == books.shape[0] * books.shape[2])
    return sized.mapInArrow(_codes(books, params.block, fields.names), fields), books


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` (row, code, error) plus ``label_error``: the errors of the label's rows, summed.

    Rows without a label are one label. Labels are summed before they are joined back, and a
    label with most of the rows is split if the sums are too many to be broadcast.
    """
    coded = session.materialize(coded)
    value = F.col("row").getField(label).cast("string")
    keyed = coded.withColumn("key", F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), value)))
    sums = session.materialize(keyed.groupBy("key").agg(F.sum("error").alias("label_error")))
    return session.lookup_join(keyed, sums, "key", "code").drop("key")
