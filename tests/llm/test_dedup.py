"""Exact and near duplicates against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gaceta.llm import components, queries, radix_dedup, simhash
from gaceta.llm.radix_dedup import RadixParams
from tests.conftest import SF


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    largest = lambda ids: max((i for i in ids if i is not None), default=None)
    return groups, [(i, t, largest(groups[lowered(t)]), len(groups[lowered(t)])) for i, t in rows]


# Every route: few groups, many groups, hot groups of either kind.
ROUTES = [RadixParams(), RadixParams(hot_rows=10, digit=4, growth=3),
          RadixParams(hot_rows=10, digit=4, broadcast_bytes=0),
          RadixParams(hot_bytes=1, digit=2, growth=2, broadcast_bytes=0, longest_digit=500)]


@pytest.mark.parametrize("params", ROUTES)
def test_exact_groups(spark, params):
    rng = random.Random(3)
    base = ["x" * n for n in (0, 1, 31, 32, 33, 256, 300, 3000)]
    base += ["y" * 299 + "z", "Ab" * 40, "aB" * 40, None, "ÄB", "äB", "Äb"]
    rows = [(i if rng.random() > 0.02 else None, rng.choice(base)) for i in range(1500)] + [(7, "dup")] * 3
    groups, expected = exact_by_hand(rows)
    found = radix_dedup.exact_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5), params).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(expected, key=repr)
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


@pytest.mark.parametrize("params", ROUTES[::3])
def test_exact_awkward(awkward, params):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    groups, expected = exact_by_hand(rows)
    found = radix_dedup.exact_duplicates(awkward, params)
    assert found.columns == [c for c in awkward.columns if c not in radix_dedup.OWN] + list(radix_dedup.OWN)
    got = [(r.doc_id, r.text, r.keep_id, r.group_size) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert radix_dedup.exact_duplicates(awkward.limit(0), params).collect() == []


def test_split_groups_needs_no_digest():
    texts = [b"", b"a", b"ab", b"ab", b"abc" * 100, b"abc" * 100, b"abc" * 99 + b"abd"]
    groups = radix_dedup.split_groups(texts, 2, 2)
    assert sorted(map(sorted, groups)) == [[0], [1], [2, 3], [4, 5], [6]]


def fingerprint_by_hand(text, words, seed):
    parts = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered(text)).split(" ") if w]
    grams = [" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)), len(grams)


def components_by_hand(rows, params):
    """rows: (doc_id, text); every pair compared."""
    prints = [(i, [fingerprint_by_hand(t, params.words, 42 + k) for k in range(params.lanes)])
              for i, t in rows if i is not None]
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in range(len(prints)):
        for y in range(x):
            (i, p), (j, q) = prints[x], prints[y]
            apart = sum((a[0] ^ b[0]).bit_count() for a, b in zip(p, q))
            small, large = sorted((p[0][1], q[0][1]))
            if apart <= params.radius and small >= params.min_size_ratio * large:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (p[0][0], find(i)) for i, p in prints}


@pytest.mark.parametrize("tile_rows", [1 << 14, 3])
@pytest.mark.parametrize("base", [simhash.NARROW, simhash.SimHashParams(),
                                  simhash.SimHashParams(radius=6, lanes=1, min_size_ratio=0.5)])
def test_near_against_all_pairs(spark, base, tile_rows):
    rng = random.Random(8)
    vocabulary = ["uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve", "diez"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 6, 40, 120]))) for _ in range(60)]
    rows = []
    for i in range(240):
        words = rng.choice(texts).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "Uno DOS"), (1004, "uno\tdos")]
    rng.shuffle(rows)
    params = simhash.SimHashParams(**{**base.__dict__, "tile_rows": tile_rows})
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.f0 % 2**64, r.component_id) for r in simhash.near_duplicates(docs, params).collect()}
    assert found == components_by_hand(rows, params)


def test_near_awkward(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    expected = components_by_hand(rows, simhash.NARROW)
    found = simhash.near_duplicates(awkward, simhash.NARROW).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.component_id == (expected[r.doc_id][1] if r.doc_id is not None else None)
    assert simhash.near_duplicates(awkward.limit(0), simhash.NARROW).collect() == []


def test_near_query_on_the_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = queries.op5_simhash(spark, SF).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == components_by_hand(
        rows, simhash.NARROW)
    assert all(len(r.fingerprint) == 16 for r in found)


def test_xxhash_is_sparks(spark):
    text = "ñandú corre lejos"
    mine = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first().h
    assert mine % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    pairs = {"chain": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(300)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(180)], "none": []}[shape]
    rng.shuffle(pairs)
    root = {i: i for p in pairs for i in p if p[0] != p[1]}
    for _ in range(len(pairs)):
        changed = False
        for a, b in pairs:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
        if not changed:
            break
    links = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    found = components.components(links).collect()
    assert len(found) == len(root)
    assert {r.id: r.component for r in found} == root


def test_forest_connects_the_same():
    a, b = np.array([5, 1, 9, 9]), np.array([1, 3, 8, 9])
    low, high = components.forest(a, b)
    assert sorted(zip(low.tolist(), high.tolist())) == [(1, 3), (1, 5), (8, 9)]
