"""SimHash near-duplicates: fingerprints of shingles, tiles compared bit by bit in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaceta import session
from gaceta.llm import components

SEED = 42


@dataclass(frozen=True)
class SimHashParams:
    words: int = 5
    # 64-bit hashes per shingle, seeded 42, 43, ...
    lanes: int = 2
    # Fingerprints link at this many differing bits or fewer.
    radius: int = 25
    # Radii, none above ``radius``, by the number of shingles of the longer text, and for
    # longer texts than those; none: ``radius`` for all.
    radii: tuple[int, ...] = ()
    long_radius: int = 25
    # Texts link only if the shorter has at least this share of the longer's shingles; 0: any.
    min_size_ratio: float = 0.8
    # Count a repeated shingle once, in fingerprints and sizes.
    distinct: bool = False
    # Rows of a tile that one task holds while it reads the neighbouring tiles.
    tile_rows: int = 1 << 14


#: 64 bits over 3-word shingles, two bits apart at most, whatever the lengths.
NARROW = SimHashParams(words=3, lanes=1, radius=2, min_size_ratio=0.0)


def shingles(text: bytes, words: int) -> list[bytes]:
    """Every run of so many words, repeats included, A-Z lowered and joined by spaces.

    A text of fewer words is one shingle; no words make none.
    """
    parts = text.lower().split()  # for bytes: A-Z, and the six ASCII white-space bytes
    if len(parts) <= words:
        return [b" ".join(parts)] if parts else []
    line = b" ".join(parts)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(gaps[:len(parts) - words] + 1).tolist()]
    ends = [*gaps[words - 1:].tolist(), len(line)]
    return [line[i:j] for i, j in zip(starts, ends)]


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half the hashes; 0 for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        piece = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(piece, axis=1)
        whole = len(bits) // 255 * 255  # sums of 255 bits still fit a byte
        sums = np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8)
        counts += sums.sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """(doc_id, f0, f1, ..., size): one long per lane and the number of shingles.

    Null and empty texts have fingerprint zero and size 0. Every row is read whole and
    gives one row; other columns are not read.
    """
    lanes = [f"f{i}" for i in range(params.lanes)]
    digest = xxhash.xxh64_intdigest
    schema = f"doc_id long, {', '.join(f'{c} long' for c in lanes)}, size long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((params.lanes, batch.num_rows), np.uint64)
            size = np.zeros(batch.num_rows, np.int64)
            for row, text in enumerate(batch.column("text")):
                found = shingles(text.as_py() or b"", params.words)
                if params.distinct:
                    found = set(found)
                size[row] = len(found)
                for lane in range(params.lanes):
                    seed = SEED + lane
                    hashes = np.fromiter((digest(x, seed) for x in found), np.uint64, len(found))
                    out[lane, row] = majority_bits(hashes)
            columns = [pa.array(lane.view(np.int64)) for lane in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(size)], ["doc_id", *lanes, "size"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
    ).mapInArrow(run, schema)


class Tiling:
    """Which tile a fingerprint lies in, and which tiles can hold fingerprints within reach.

    A tile is a vector of small numbers: bands of population counts, and a band of sizes.
    Two fingerprints within the radius differ by no more than the radius in the sum of
    their blocks' population counts; tile pairs beyond that are never compared.
    """

    def __init__(self, params: SimHashParams):
        self.params = params
        # Narrow radii: exact population counts of the four quarters of each lane, summed
        # over lanes. Wide ones: the count of all bits in bands one wider than the radius.
        self.blocks = 4 if params.radius <= 3 else 1
        self.band = 1 if params.radius <= 3 else params.radius + 1
        reach = range(-params.radius, params.radius + 1) if self.band == 1 else (-1, 0, 1)
        bits = [v for v in product(*[reach] * self.blocks)
                if self.band > 1 or sum(map(abs, v)) <= params.radius]
        sizes = (-1, 0, 1) if params.min_size_ratio else (0,)
        # Half of the neighbours: of two tiles, one is the host and the other its guest.
        self.steps = np.array([(s, *v) for s in sizes for v in bits if (s, *v) > (0,) * (1 + len(v))]
                              or np.zeros((0, 1 + self.blocks)), np.int64)

    def tiles(self, lanes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tile vectors, one row each, of fingerprints (lanes x rows, uint64)."""
        if self.blocks == 1:
            counts = np.bitwise_count(lanes).sum(axis=0, dtype=np.int64)[:, None]
        else:
            shorts = np.ascontiguousarray(lanes.T).view(np.uint16)
            counts = np.bitwise_count(shorts).reshape(len(sizes), -1, 4).sum(axis=1, dtype=np.int64)
        ratio = self.params.min_size_ratio
        if ratio:
            band = np.floor(np.log(np.maximum(sizes, 1)) / -np.log(ratio))
        else:
            band = np.zeros(len(sizes))
        return np.column_stack([band.astype(np.int64), counts // self.band])

    @staticmethod
    def key(tiles: np.ndarray) -> np.ndarray:
        """One long per tile vector of up to five small numbers, some a little below zero."""
        key = np.zeros(len(tiles), np.int64)
        for column in tiles.T:
            key = key * 1024 + (column + 8)
        return key

    def linked(self, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray):
        """Index pairs of fingerprints of ``a`` and ``b`` (lanes x rows) that link."""
        apart = np.zeros((a.shape[1], b.shape[1]), np.uint8)
        for x, y in zip(a, b):
            apart += np.bitwise_count(x[:, None] ^ y[None, :])
        i, j = np.nonzero(apart <= self.params.radius)
        if self.params.radii:
            limits = np.array([*self.params.radii, self.params.long_radius])
            limit = limits[np.minimum(np.maximum(na[i], nb[j]), len(limits) - 1)]
            fits = apart[i, j] <= limit
            i, j = i[fits], j[fits]
        if self.params.min_size_ratio:
            small, large = np.minimum(na[i], nb[j]), np.maximum(na[i], nb[j])
            fits = small >= self.params.min_size_ratio * large
            i, j = i[fits], j[fits]
        return i, j


def _place(params: SimHashParams, chunks: dict[int, int]):
    """Every fingerprint to its own tile's cell, and as a guest to the tiles it may reach.

    A tile with many rows is cut into ``chunks``; its guests visit each of them.
    """
    tiling = Tiling(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lanes = _lanes(batch, params)
            sizes = batch.column("size").to_numpy()
            ids = batch.column("id").to_numpy()
            own = tiling.tiles(lanes, sizes)
            for step in (np.zeros(own.shape[1], np.int64), *tiling.steps):
                host = tiling.key(own + step)
                guest = bool(step.any())
                known = [chunks.get(k, 0) for k in host.tolist()]
                n = np.array(known, np.int64)
                if guest:
                    rows = np.repeat(np.arange(len(n)), n)
                    chunk = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
                    yield _cells(rows, host, chunk, ids, lanes, sizes, 2)
                    continue
                # At home: held by one chunk, a guest of the chunks after it.
                rows = np.arange(len(n))
                home = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
                        ).astype(np.int64) % np.maximum(n, 1)
                yield _cells(rows, host, home, ids, lanes, sizes, 0)
                later = np.maximum(n - 1 - home, 0)
                rows = np.repeat(rows, later)
                chunk = home[rows] + 1 + np.arange(len(rows)) - np.repeat(
                    np.cumsum(later) - later, later)
                yield _cells(rows, host, chunk, ids, lanes, sizes, 2)

    return run


def _cells(rows, host, chunk, ids, lanes, sizes, role) -> pa.RecordBatch:
    columns = [host[rows], chunk, np.full(len(rows), role, np.int32), ids[rows],
               *[lane[rows].view(np.int64) for lane in lanes], sizes[rows]]
    names = ["tile", "chunk", "role", "id", *[f"f{i}" for i in range(len(lanes))], "size"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _lanes(batch: pa.RecordBatch, params: SimHashParams) -> np.ndarray:
    return np.stack([batch.column(f"f{i}").to_numpy().view(np.uint64)
                     for i in range(params.lanes)])


def _compare(params: SimHashParams, block: int = 128):
    """Arrow batches sorted by (tile, chunk, role) -> links.

    The rows at home in a cell come first and are held; all others pass by in batches.
    What one batch links is passed on as a forest, so a crowd of like texts does not give
    all its pairs.
    """
    tiling = Tiling(params)

    def skipped(na, nb) -> bool:
        """Whether sizes (sorted) keep two blocks apart."""
        ratio = params.min_size_ratio
        return na[-1] < ratio * nb[0] or nb[-1] < ratio * na[0]

    def links(a, b):
        found_a, found_b = [], []
        (la, na, ia), (lb, nb, ib) = a, b
        for i in range(0, len(ia), block):
            for j in range(0, len(ib), 8 * block):
                x, y = slice(i, i + block), slice(j, j + 8 * block)
                if skipped(na[x], nb[y]):
                    continue
                p, q = tiling.linked(la[:, x], lb[:, y], na[x], nb[y])
                if len(p):
                    one, two = ia[x][p], ib[y][q]
                    apart = one != two
                    low, high = components.forest(one[apart], two[apart])
                    found_a.append(low)
                    found_b.append(high)
        if found_a:
            low, high = components.forest(np.concatenate(found_a), np.concatenate(found_b))
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            tile, chunk, role = (batch.column(c).to_numpy() for c in ("tile", "chunk", "role"))
            lanes, sizes = _lanes(batch, params), batch.column("size").to_numpy()
            ids = batch.column("id").to_numpy()
            turns = np.flatnonzero((np.diff(tile) != 0) | (np.diff(chunk) != 0) | (np.diff(role) != 0))
            edges = [0, *(turns + 1).tolist(), len(tile)]
            for i, j in zip(edges[:-1], edges[1:]):
                here, part = (tile[i], chunk[i]), (lanes[:, i:j], sizes[i:j], ids[i:j])
                if here != cell:
                    cell, held = here, None
                if held is not None:
                    yield from links(held, part)
                if role[i] == 0:
                    yield from links(part, part)
                    held = part if held is None else tuple(
                        np.concatenate([x, y], axis=-1) for x, y in zip(held, part))

    return run


def linked_groups(prints: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """(doc_id, f0.., size, component_id) of the rows of ``fingerprints`` that have an id.

    Equal fingerprints of equal size are compared once, under their smallest id; all
    others are compared exactly, wherever their tiles may reach each other.
    """
    lanes = [f"f{i}" for i in range(params.lanes)]
    keys = [*lanes, "size"] if params.min_size_ratio else lanes
    prints = prints.where("doc_id is not null")
    grouped = prints.groupBy(*keys).agg(F.min("doc_id").alias("id"), *(
        [] if "size" in keys else [F.min("size").alias("size")]))
    distinct = session.materialize(grouped.select("id", *lanes, "size"))
    tiling = Tiling(params)

    def count_tiles(batches):
        for batch in batches:
            key = tiling.key(tiling.tiles(_lanes(batch, params), batch.column("size").to_numpy()))
            tile, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tile), pa.array(n)], ["tile", "n"])

    # As many rows as there are tiles in use, at most 17 ** 4 or bands of size times bands
    # of counts: bounded whatever the input.
    per_tile = distinct.mapInArrow(count_tiles, "tile long, n long").groupBy("tile").agg(
        F.sum("n").alias("n"))
    chunks = {r["tile"]: -(-r["n"] // params.tile_rows) for r in per_tile.collect()}
    cell_schema = T.StructType([
        T.StructField("tile", T.LongType()), T.StructField("chunk", T.LongType()),
        T.StructField("role", T.IntegerType()), T.StructField("id", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in (*lanes, "size")]])
    cells = distinct.mapInArrow(_place(params, chunks), cell_schema)
    links = (
        cells.repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "role", "size")
        .mapInArrow(_compare(params), components.EDGES))
    joined = session.materialize(components.components(session.materialize(links)))
    named = session.materialize(distinct.join(
        joined.withColumnRenamed("component", "component_id"), "id", "left")
        .select(*keys, F.coalesce("component_id", "id").alias("component_id")))
    # A fingerprint may be that of many rows: the names are broadcast or each key is split.
    joined = session.lookup_join(prints, named, keys, spread="doc_id", how="inner")
    return joined.select("doc_id", *lanes, "size", "component_id")


def near_duplicates(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """(doc_id, f0.., component_id) of every row: the smallest id its text is linked to.

    Links are transitive. Null, empty and blank texts all have fingerprint zero and are
    linked like any other. Rows that repeat an id are one document of several texts. A row
    without id is its own component (null) and links nothing. Empty tables give an empty
    result.
    """
    prints = session.materialize(fingerprints(docs, params))
    lanes = [f"f{i}" for i in range(params.lanes)]
    nameless = prints.where("doc_id is null").select(
        "doc_id", *lanes, F.lit(None).cast("long").alias("component_id"))
    return linked_groups(prints, params).drop("size").unionByName(nameless)
