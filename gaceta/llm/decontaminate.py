"""Benchmark passages in documents: an FM-index per shard of documents, searched for all phrases."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaceta import session
from gaceta.llm import tokens
from gaceta.llm.fm_index import BREAK, FmIndex

TABLE = tokens.translate_table(digits=True)
SPANS = "array<struct<first:int,last:int,start:int,end:int>>"


@dataclass(frozen=True)
class LeakParams:
    # Words of a phrase; an item of fewer words is one phrase.
    words: int = 10
    # Symbols of one index.
    shard: int = 1 << 20
    # Occurrences that are located at a time.
    located: int = 1 << 18
    # Bytes of benchmark text that are searched for in one pass over the documents.
    block_bytes: int = 4 << 20


class Phrases:
    """The phrases of some benchmark items as numbers; ``items`` are (name, text as bytes)."""

    def __init__(self, items: list[tuple[str, bytes | None]], words: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            own = (text or b"").translate(TABLE).split()
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own]
            length = min(words, len(ids))
            for i in range(len(ids) - length + 1) if ids else ():
                found[length][tuple(ids[i:i + length])].add(name)
        # By length: one phrase per row, and the names of the items that hold it.
        self.by_length = [
            (length, np.array([*rows], np.int64), [sorted(names) for names in rows.values()])
            for length, rows in sorted(found.items())]
        self.shortest = min(found, default=0)
        self.longest = max(found, default=0)


def _symbols(flat: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The words of a text as phrase words, BREAK for all that no phrase holds."""
    lists = [np.fromiter(map(vocabulary.get, ws, repeat(BREAK)), np.int32, len(ws))
             for ws in tokens.word_lists(flat)]
    return np.concatenate([np.zeros(0, np.int32), *lists])


def _shards(symbols: np.ndarray, phrases: Phrases, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols of an index, the place each one comes from).

    Only stretches that can hold the shortest phrase are taken. One longer than an index is
    cut, and the pieces overlap by all but one word of the longest phrase.
    """
    breaks = np.flatnonzero(symbols == BREAK)
    length = np.diff(breaks) - 1
    chosen = length >= phrases.shortest
    start, length = breaks[:-1][chosen] + 1, length[chosen]
    step = max(size - phrases.longest + 1, 1)
    pieces = np.maximum(-(-(length - phrases.longest + 1) // step), 1)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    rest = np.repeat(length, pieces) - nth * step
    start = np.repeat(start, pieces) + nth * step
    length = np.minimum(rest, step + phrases.longest - 1)
    shard = np.cumsum(length + 1) // (size + 1)
    for i, j in zip(*_edges(shard)):
        # Each stretch with the place after it, and a break before them all.
        n = length[i:j] + 1
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        places = np.repeat(start[i:j], n) + inside
        taken = np.where(inside < np.repeat(n - 1, n), symbols[places], BREAK)
        yield np.concatenate([[BREAK], taken]), np.concatenate([[-1], places])


def _edges(keys: np.ndarray) -> tuple[list[int], list[int]]:
    """Begin and end of the runs of equal keys."""
    turns = (np.flatnonzero(np.diff(keys)) + 1).tolist()
    return ([0, *turns], [*turns, len(keys)]) if len(keys) else ([], [])


def _occurrences(symbols: np.ndarray, phrases: Phrases, params: LeakParams):
    """(place, length, number of the phrase among those of its length) of all occurrences."""
    for taken, places in _shards(symbols, phrases, params.shard):
        index = FmIndex(taken, len(phrases.vocabulary))
        for length, rows, _ in phrases.by_length:
            low, high = index.search(rows)
            hit = np.flatnonzero(high > low)
            n = high[hit] - low[hit]
            ends = np.cumsum(n)
            for at in range(0, int(n.sum()), params.located):
                nth = np.arange(at, min(at + params.located, int(ends[-1])))
                which = np.searchsorted(ends, nth, side="right")
                row = low[hit[which]] + nth - (ends - n)[which]
                yield places[index.locate(row)], length, hit[which]


def _char_spans(flat: bytes, raw: bytes, first: np.ndarray, last: np.ndarray):
    """Offsets in characters of runs of words, given as numbers of their words (last excluded)."""
    blank = np.frombuffer(flat, np.uint8) == tokens.BLANK
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return chars[begin[first]], chars[end[last - 1]]


def _search(shared, params: LeakParams, schema: T.StructType):
    """Arrow batches (text as bytes, row) -> (row, n_words, items, spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text")]
            parts = [_symbols(t.translate(TABLE), phrases.vocabulary) for t in texts]
            n_words = np.array([len(p) for p in parts], np.int64)
            # A break before, between and after the documents.
            gap = np.zeros(1, np.int32)
            symbols = np.concatenate([gap, *[x for p in parts for x in (p, gap)]])
            begin = 1 + np.cumsum(n_words + 1) - (n_words + 1)
            names, spans = _found(symbols, begin, phrases, params)
            rows = []
            for doc, text in enumerate(texts):
                first, last = spans.get(doc, (None, None))
                if first is None:
                    rows.append([])
                    continue
                start, end = _char_spans(text.translate(TABLE), text, first, last)
                rows.append([dict(zip(("first", "last", "start", "end"), map(int, x)))
                             for x in zip(first, last, start, end)])
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array(n_words),
                pa.array([sorted(names.get(d, ())) for d in range(len(texts))], pa.list_(pa.string())),
                pa.array(rows, pa.list_(pa.struct([(c, pa.int32()) for c in ("first", "last", "start", "end")]))),
            ], schema.names)

    return run


def _found(symbols: np.ndarray, begin: np.ndarray, phrases: Phrases, params: LeakParams):
    """By document: the names of items found, and (first, last) of the merged runs of words."""
    cover = np.zeros(len(symbols) + 1, np.int32)
    names: dict[int, set] = defaultdict(set)
    by_length = {length: items for length, _, items in phrases.by_length}
    for place, length, phrase in _occurrences(symbols, phrases, params):
        np.add.at(cover, place, 1)
        np.add.at(cover, place + length, -1)
        doc = np.searchsorted(begin, place, side="right") - 1
        for d, p in np.unique(np.column_stack([doc, phrase]), axis=0).tolist():
            names[d].update(by_length[length][p])
    edge = np.diff(np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(begin, first, side="right") - 1
    spans = {int(doc[i]): (first[i:j] - begin[doc[i]], last[i:j] - begin[doc[i]])
             for i, j in zip(*_edges(doc))}
    return names, spans


def _merged(groups: DataFrame) -> DataFrame:
    """(number, items, spans) of all blocks -> one row per number, its spans merged."""
    def merge(rows):
        spans = np.array([tuple(s) for found in rows["spans"] for s in found], np.int64)
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        reach = np.maximum.accumulate(spans[:, 1])
        fresh = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
        # Runs that touch are one run, as if all phrases had been searched for at once.
        ends = np.append(np.flatnonzero(fresh)[1:], len(spans)) - 1
        end_char = np.maximum.accumulate(spans[:, 3])
        merged = np.column_stack([spans[fresh, 0], reach[ends], spans[fresh, 2], end_char[ends]])
        items = sorted({x for found in rows["items"] for x in found})
        return rows.iloc[:1].assign(items=[items], spans=[[tuple(map(int, m)) for m in merged]])

    rows = groups.select("number", "items", F.transform("spans", lambda s: F.array(
        s["first"], s["last"], s["start"], s["end"])).alias("spans"))
    merged = rows.groupBy("number").applyInPandas(
        merge, "number long, items array<string>, spans array<array<int>>")
    named = F.transform("spans", lambda s: F.struct(*[
        F.get(s, i).alias(c) for i, c in enumerate(("first", "last", "start", "end"))]))
    return merged.select("number", "items", named.cast(SPANS).alias("spans"))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], params: LeakParams = LeakParams(),
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` and ``n_words``, ``n_hit``, ``items``, ``spans``.

    Words are runs of a-z (A-Z lowered), 0-9 and characters beyond ASCII, over whole texts. A
    phrase is any run of so many words of an item, or a shorter item whole. A word of a
    document is hit if an occurrence of a phrase covers it; ``spans`` are the merged runs of
    such words: word numbers (first, last excluded) and character offsets (start, end
    excluded). ``items`` are the ids, as sorted strings, of items with a phrase there.

    Each task turns its documents into indexes of bounded size and searches them for all
    phrases at once; nothing is shuffled. The alphabet of an index is the words of the
    phrases: all other words are breaks, and stretches between them that are too short for
    any phrase get no place. Benchmark text beyond ``block_bytes`` is cut into blocks of
    items, a pass over the documents for each, and what the passes find is merged.

    Null, empty and blank texts have no words and no hits; such items have no phrases. Rows
    that share an item id are one item; rows without one are the item ''. Repeated documents
    are searched one by one. Empty tables give no rows, or no hits. The kept columns may have
    any names but those four.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
        F.col("text").cast("binary").alias("text")).where("text is not null").distinct()
    items = session.materialize(items)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // params.block_bytes))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").cast("binary").alias("text"))

    def searched(table: DataFrame, block: int) -> DataFrame:
        own = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block)
        # A block is bounded: about ``block_bytes`` of text, whatever the benchmark.
        phrases = Phrases([(r["name"], bytes(r["text"])) for r in own.collect()], params.words)
        schema = T.StructType([
            table.schema["row"], T.StructField("n_words", T.LongType()),
            T.StructField("items", T.ArrayType(T.StringType())),
            T.StructField("spans", T._parse_datatype_string(SPANS))])
        return table.select("text", "row").mapInArrow(
            _search(spark.sparkContext.broadcast(phrases), params, schema), schema)

    if blocks == 1:
        found = searched(rows, 0).select("row", "n_words", "items", "spans")
    else:
        # The number of a row is written with it, so all passes agree on it.
        numbered = session.materialize(rows.select(
            F.struct(F.monotonically_increasing_id().alias("number"), "row").alias("row"), "text"))
        passes = [session.materialize(searched(numbered, b)) for b in range(blocks)]
        hits = [p.where(F.size("spans") > 0).select("row.number", "items", "spans") for p in passes]
        union = hits[0]
        for more in hits[1:]:
            union = union.union(more)
        every = passes[0].select("row.number", "row.row", "n_words")
        merged = session.materialize(_merged(union))
        none = F.array()
        found = session.lookup_join(every, merged, "number", "number").select(
            "row", "n_words", F.coalesce("items", none.cast("array<string>")).alias("items"),
            F.coalesce("spans", none.cast(SPANS)).alias("spans"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in keep], "n_words", hit.alias("n_hit"), "items", "spans")


def without_spans(text: Column, spans: Column) -> Column:
    """The text less its spans, each replaced by one space; null stays null."""
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(
        F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a)), " "))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """``docs`` with the benchmark passages cut out of ``text``; rows and columns stay."""
    packed = docs.select(F.struct("*").alias("row"), "text")
    found = find_leaks(packed, benchmark, ["row"], params)
    row = found["row"]
    text = without_spans(row.getField("text"), found["spans"])
    return found.select(*[(text if c == "text" else row.getField(c)).alias(c) for c in docs.columns])
