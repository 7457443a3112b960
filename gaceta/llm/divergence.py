"""How far the words of a language's sources are from one another, exactly in whole numbers."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaceta import session
from gaceta.llm import tokens

TABLE = tokens.translate_table(digits=False)
COUNTS = "lang string, source string, term string, n long, docs long"
PAIRS = "lang string, source string, item string, value long"


@dataclass(frozen=True)
class AuditParams:
    # A language keeps the terms of at least so many of its documents.
    min_docs: int = 3
    # A probability of 1 as a whole number.
    scale: int = 1_000_000_000
    # Terms listed per source.
    top: int = 200
    # (group, term) pairs a task holds before it passes them on.
    held: int = 1 << 18
    # Shares in one cell of the comparison of sources, about, and sources of a tile, at most about.
    cell_rows: int = 1 << 16
    tile: int = 256
    # Numbers in a dense block of such a cell.
    block: int = 1 << 20


def _count(held: int):
    """Arrow batches (lang, source, text as bytes) -> COUNTS, summed over ``held`` pairs.

    Every group that occurs gives a row with the empty term, which no text has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, Counter] = defaultdict(Counter)
        docs: dict[tuple, Counter] = defaultdict(Counter)

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in totals.items():
                terms[b""] = 0
                found = docs[lang, source]
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(lang, pa.string()), len(terms)),
                    pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                    pa.array(terms.keys(), pa.binary()).cast(pa.string()),
                    pa.array(terms.values(), pa.int64()),
                    pa.array([found[t] for t in terms], pa.int64()),
                ], ["lang", "source", "term", "n", "docs"])
            totals.clear()
            docs.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
                group = lang.as_py(), source.as_py()
                terms, before, own = totals[group], len(totals[group]), Counter()
                for words in tokens.word_lists((text.as_py() or b"").translate(TABLE)):
                    own.update(words)
                    terms.update(words)
                docs[group].update(own.keys())
                size += len(terms) - before
                if size >= held:
                    yield from passed_on()
                    size = 0
        yield from passed_on()

    return run


def count_terms(docs: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a source, and documents with it.

    Terms are runs of a-z (A-Z lowered) and characters beyond ASCII, over whole texts. Null
    text, lang and source are read as empty. Every (lang, source) that occurs has a row with
    the empty term and no occurrences, whatever its texts.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(named("lang"), named("source"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_count(params.held), COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column, scale: int) -> Column:
    """1 + floor(scale * (count + 1) / (total + terms)); decimals, since the product is large."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", (wide(count) + 1) * scale, wide(total) + wide(terms)) + 1


def _sums(params: AuditParams):
    """Rows of one cell (source, tile, term, p, terms) -> sums over pairs of its sources.

    A row without term says what share a source has of any term it lacks, and how many terms
    the language has. The cell of two tiles compares the sources of one with those of the
    other, that of one tile all among themselves. Each pair gets its distances over the
    cell's terms less what they would be if it lacked them, so terms that neither has need
    no row; the first bucket adds that amount for all terms.
    """
    distance = lambda p, q: (p - q) ** 2 // q

    def run(key, rows):
        lang, bucket, low, high = key
        plain = rows[rows["term"].isna()]
        shares = rows[rows["term"].notna()]
        row_of = {name: i for i, name in enumerate(plain["source"])}
        lacked = plain["p"].to_numpy(np.int64)
        tiles = plain["tile"].to_numpy()
        one, two = np.flatnonzero(tiles == low), np.flatnonzero(tiles == high)
        ways = [(one, two)] if low == high else [(one, two), (two, one)]
        none = [distance(lacked[a][:, None], lacked[b]) for a, b in ways]
        sums = [x * int(plain["terms"].iloc[0]) if bucket == 0 else np.zeros_like(x) for x in none]
        term = pd.factorize(shares["term"])[0]
        order = np.argsort(term, kind="stable")
        term = term[order]
        at = shares["source"].map(row_of).to_numpy(np.int64)[order]
        p = shares["p"].to_numpy(np.int64)[order]
        width = max(1, params.block // max(1, len(one) * len(two)))
        for first in range(0, int(term[-1]) + 1 if len(term) else 0, width):
            i, j = np.searchsorted(term, [first, first + width])
            block = int(term[j - 1]) - first + 1
            dense = np.repeat(lacked[:, None], block, axis=1)
            dense[at[i:j], term[i:j] - first] = p[i:j]
            for (a, b), total, base in zip(ways, sums, none):
                total += distance(dense[a][:, None, :], dense[b][None, :, :]).sum(axis=2) - block * base
        names = plain["source"].to_numpy(object)
        out = [pd.DataFrame({
            "lang": lang, "source": np.repeat(names[a], len(b)), "item": np.tile(names[b], len(a)),
            "value": total.ravel()}) for (a, b), total in zip(ways, sums)]
        out = pd.concat(out)
        return out[out["source"] != out["item"]]

    return run


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value",
        F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets the sources of a language apart.

    A language keeps the terms that at least ``min_docs`` of its documents have. A source's
    share p of a kept term is 1 + floor(scale * (count + 1) / (N + V)), N being its
    occurrences of the V kept terms; the language's share q is made the same way. The
    distance is floor((p - q)^2 / q). Part ``pair``: for every source, each other source of
    its language as item, and the distances from the other's shares summed over all kept
    terms. Part ``term``: the ``top`` terms that a source has and holds a larger share of
    than its language, by distance. Ranks go by value, largest first, then by item.

    Null lang, source and text are read as empty, and the empty names are names like any
    other. Sources without terms are compared as well; a language that keeps no term has
    distances 0 and no terms listed. Repeated documents count one by one. An empty table
    gives no rows; other columns are not read. Values must fit a long.

    Counts leave the tasks summed. The comparison of sources is cut by language, by buckets
    of terms and by tiles of sources, so neither a large language nor many sources make a
    large group.
    """
    counts = session.materialize(count_terms(docs, params))
    by_term = W.partitionBy("lang", "term")
    kept = session.materialize(
        counts.where("term <> ''").select(
            "lang", "source", "term", "n",
            F.sum("n").over(by_term).alias("lang_n"), F.sum("docs").over(by_term).alias("lang_docs"),
            # One row of each term tells it from the others.
            (F.row_number().over(by_term.orderBy("source")) == 1).alias("first"))
        .where(F.col("lang_docs") >= params.min_docs).drop("lang_docs"))
    totals = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    groups = session.materialize(
        counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left")
        .na.fill(0, ["total", "firsts"]))
    langs = session.materialize(groups.groupBy("lang").agg(
        F.sum("firsts").alias("terms"), F.sum("total").alias("lang_total"),
        F.count(F.lit(1)).alias("sources")))
    groups = session.materialize(
        session.lookup_join(groups.drop("firsts"), langs, "lang", "source", "inner"))
    sized = groups.select("lang", "source", "total", "terms", "lang_total")
    shares = session.lookup_join(kept, sized, ["lang", "source"], "term", "inner").select(
        "lang", "source", "term", "n", "terms",
        _share(F.col("n"), F.col("total"), F.col("terms"), params.scale).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), params.scale).alias("q"))

    apart = F.col("p") - F.col("q")
    listed = shares.where("n > 0 and p > q").select(
        "lang", "source", F.col("term").alias("item"),
        F.call_function("div", apart * apart, F.col("q")).alias("value"))
    listed = _ranked(listed, "term").where(F.col("rank") <= params.top)

    most = groups.agg(F.max("sources")).first()[0] or 0
    tiles = max(1, -(-most // params.tile))
    buckets = max(1, -(-kept.count() // params.cell_rows))
    tile = F.pmod(F.xxhash64("source"), F.lit(tiles)).alias("tile")
    # Without terms all distances are 0, whatever the shares.
    share = _share(F.lit(0), F.col("total"), F.greatest("terms", F.lit(1)), params.scale)
    lacking = groups.select(
        "lang", "source", tile, F.lit(None).cast("string").alias("term"), share.alias("p"), "terms",
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    rows = shares.select(
        "lang", "source", tile, "term", "p", "terms",
        F.pmod(F.xxhash64("term", F.lit(1)), F.lit(buckets)).cast("int").alias("bucket")).unionByName(lacking)
    # A source meets its own tile and, from either side, each other one.
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("other")
    cells = rows.select("*", other).select(
        "lang", "bucket", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        "source", "tile", "term", "p", "terms")
    summed = cells.groupBy("lang", "bucket", "low", "high").applyInPandas(_sums(params), PAIRS)
    pairs = summed.groupBy("lang", "source", "item").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    return listed.unionByName(_ranked(pairs, "pair"))
