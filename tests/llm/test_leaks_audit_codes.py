"""Decontamination, divergence audit and vector codes against brute force, and their edge rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaceta.llm import decontaminate, divergence, queries, tokens, vector_codes
from gaceta.llm.fm_index import FmIndex, suffix_order
from tests.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_by_hand(text, pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


# --- tokens and index ---

@pytest.mark.parametrize("text", ["", " ", "Uno-DOS 3º", "ÁÉ\x00x\x7fy", "palabra " * 50, "z" * 300, "a b\x85c"])
def test_words(text):
    flat = text.encode().translate(tokens.translate_table(digits=True))
    for piece in (1, 7, 1 << 20):
        found = [w.decode() for ws in tokens.word_lists(flat, piece) for w in ws]
        assert found == words_by_hand(text)


def test_suffix_order():
    rng = np.random.default_rng(3)
    for largest in (1, 2, 5, 5000):
        s = np.append(rng.integers(0, largest + 1, 300), 0)
        s[100:200] = s[:100]

        def key(i):
            return [*s[i:i + int(np.argmin(s[i:] != 0))].tolist()], i
        assert suffix_order(s.astype(np.int32), largest).tolist() == sorted(range(len(s)), key=key)


def test_search_and_locate():
    rng = np.random.default_rng(0)
    for trial in range(60):
        largest = int(rng.integers(1, 6))
        s = np.tile(rng.integers(0, largest + 1, 7), 20) if trial % 3 == 0 else rng.integers(0, largest + 1, 150)
        s = np.concatenate([[0], s, [0]]).astype(np.int32)
        index = FmIndex(s, largest, rate=int(rng.integers(1, 9)))
        for n in (1, 2, 5, 12):
            there = [s[i:i + n] for i in range(len(s) - n) if (s[i:i + n] > 0).all()][:20]
            phrases = np.array([*rng.integers(1, largest + 1, (10, n)), *there], np.int64)
            for phrase, low, high in zip(phrases, *index.search(phrases)):
                want = [i for i in range(len(s) - n + 1) if (s[i:i + n] == phrase).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == want


# --- decontamination ---

def leaks_by_hand(text, items, n=10):
    words, hit, found = words_by_hand(text), set(), set()
    for name, item in items:
        own = words_by_hand(item)
        size = min(n, len(own))
        for i in range(len(own) - size + 1) if own else ():
            for j in range(len(words) - size + 1):
                if words[j:j + size] == own[i:i + size]:
                    hit.update(range(j, j + size))
                    found.add(name)
    return len(words), len(hit), sorted(found)


ITEMS = [("1", "uno dos TRES cuatro"), ("2", "El ñandú corre. " * 5), ("2", "xyz"), ("3", None), ("4", ""),
         ("5", "¡!"), (None, "emoji"), ("6", "el ñandú corre el ñandú corre el ñandú corre el"), ("1", "uno dos TRES cuatro")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


@pytest.mark.parametrize("params", [
    decontaminate.LeakParams(), decontaminate.LeakParams(shard=40, located=7),
    decontaminate.LeakParams(block_bytes=60), decontaminate.LeakParams(words=3, shard=50)])
def test_leaks_against_brute_force(spark, awkward, items, params):
    docs = awkward.unionByName(awkward.where("doc_id = 6").withColumn("text", F.lit(
        "x el ñandú corre el ñandú CORRE el ñandú corre el ñandú y uno dos tres cuatro cinco")))
    short = docs.withColumn("text", F.substring("text", 1, 600))
    named = [(n or "", t) for n, t in ITEMS]
    found = decontaminate.find_leaks(short, items, ["doc_id", "text"], params).collect()
    assert len(found) == short.count()
    for r in found:
        n_words, n_hit, names = leaks_by_hand(r["text"], named, params.words)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n_words, n_hit, names)
        assert sum(s["last"] - s["first"] for s in r["spans"]) == n_hit
        for s in r["spans"]:
            assert words_by_hand(r["text"])[s["first"]:s["last"]] == words_by_hand(r["text"][s["start"]:s["end"]])


def test_long_text_is_searched_whole(spark, items):
    text = "El ñandú CORRE. " * 60_000 + "z " * 500 + "uno dos tres cuatro"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = decontaminate.find_leaks(docs, items, ["doc_id"], decontaminate.LeakParams(shard=1 << 14)).first()
    assert (r["n_words"], r["n_hit"]) == (180_504, 180_004)
    assert [(s["first"], s["last"]) for s in r["spans"]] == [(0, 180_000), (180_500, 180_504)]


def test_leaks_of_nothing(spark, awkward, items):
    empty = items.limit(0)
    found = decontaminate.find_leaks(awkward, empty, ["doc_id"]).collect()
    assert len(found) == awkward.count() and not any(r["n_hit"] or r["items"] for r in found)
    assert decontaminate.find_leaks(awkward.limit(0), items, ["doc_id"]).count() == 0


def test_removal(spark, items):
    docs = spark.createDataFrame(
        [(1, "Antes: uno, dos tres CUATRO y emoji. Fin"), (2, None), (3, "nada"), (4, "emoji")],
        "`a.b` long, text string").withColumn("row", F.lit(0)).withColumn("spans", F.lit("s"))
    gone = decontaminate.remove_leaks(docs, items)
    assert gone.columns == docs.columns
    assert [r["text"] for r in gone.orderBy("`a.b`").collect()] == ["Antes:   y  . Fin", None, "nada", " "]


# --- divergence ---

def audit_by_hand(rows, min_docs=3, top=200, scale=10 ** 9):
    counts, docs, out = {}, {}, set()
    for lang, source, text in rows:
        own = Counter(words_by_hand(text, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"))
        counts.setdefault((lang or "", source or ""), Counter()).update(own)
        docs.setdefault(lang or "", Counter()).update(own.keys())
    for lang, found in docs.items():
        kept = [t for t, n in found.items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        share = lambda c: {t: 1 + scale * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}
        p = {s: share(c) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()))
        far = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pair = [(-sum(far(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            term = [(-far(p[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pair), 1)}
            out |= {(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(term)[:top], 1)}
    return out


@pytest.mark.parametrize("params", [
    divergence.AuditParams(top=3), divergence.AuditParams(held=5, cell_rows=10, tile=2, block=16, top=5, min_docs=2)])
def test_audit_against_brute_force(spark, awkward, params):
    rows = [(r["lang"], r["source"], r["text"]) for r in awkward.collect()]
    rng = np.random.default_rng(5)
    for i in range(120):
        text = " ".join(rng.choice(["uno", "Dos", "tres", "ñu", "x1y", "cinco"], int(rng.integers(0, 9))))
        rows.append((("es", "en", None)[i % 3], f"s{i % 7}", text))
    rows += [("fr", "solo", "uno uno"), ("de", "a", "nada"), ("de", "b", None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("term", F.lit(1))
    found = divergence.audit(docs, params)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == audit_by_hand(rows, params.min_docs, params.top)


def test_audit_of_nothing(spark, awkward):
    assert divergence.audit(awkward.limit(0)).count() == 0


# --- vector codes ---

def codes_by_hand(rows, parts=16, entries=64, rounds=2):
    """rows: (id, whole vector) -> codes, errors, codebooks."""
    vectors = [[int(np.floor(256 * float(x))) for x in v] for _, v in rows]
    width = len(vectors[0]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    start = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], vectors[i]))
    firsts = {}
    for i in start:
        if rows[i][0] is not None:
            firsts.setdefault(rows[i][0], vectors[i])
    books = [[cut(v, p) for v in [*firsts.values()][:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((dist(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = {}
            for v in vectors:
                members.setdefault(near(v, p)[1], []).append(cut(v, p))
            new.append([[sum(c) // len(c) for c in zip(*members[k])] if k in members else e
                        for k, e in enumerate(books[p])])
        books = new
    found = [[near(v, p) for p in range(parts)] for v in vectors]
    return [("".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)) for f in found], books


def test_codes_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [rng.normal(0, 0.2, 32).round(2).tolist() for _ in range(150)]
    rows = [(int(i), v, int(i) % 3 if i % 5 else None) for i, v in zip(rng.permutation(150), vectors)]
    rows += [rows[3], rows[3], (rows[7][0], vectors[9], 1), (None, vectors[11], None), (999, [-1e-3] * 32, 7)]
    odd = [(500, None, 1), (501, [None] * 32, 1), (502, [float("nan")] + [0.0] * 31, 1), (-5, [], 1),
           (503, [float("inf")] * 32, 1), (504, [0.5] * 48, 1), (505, [0.5] * 31, 1)]
    table = spark.createDataFrame(
        [(*r, "c", 3) for r in rows + odd], "vec_id long, embedding array<float>, label int, code string, v int")
    f32 = [(i, np.array(v, np.float32)) for i, v, _ in rows]
    want, books = codes_by_hand(f32)
    coded, found_books = vector_codes.compress(table.repartition(5))
    assert found_books.tolist() == books
    got = vector_codes.label_errors(coded).collect()
    per_label = Counter()
    for (_, _, label), (_, error) in zip(rows, want):
        per_label[label] += error
    assert sorted((r["row"]["vec_id"] is None, r["row"]["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) \
        == sorted((i is None, i, c, e, per_label[label]) for (i, _, label), (c, e) in zip(rows, want))


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label string"
    table = spark.createDataFrame([(2, [0.5] * 16, "a"), (1, [0.25] * 16, None), (3, None, "a")], schema)
    coded, books = vector_codes.compress(table)
    assert books.shape == (16, 2, 1)
    assert {(r["row"]["vec_id"], r["code"], r["error"]) for r in coded.collect()} == {(1, "00" * 16, 0), (2, "01" * 16, 0)}
    none, books = vector_codes.compress(table.where("embedding is null"))
    assert none.count() == 0 and books.size == 0 and vector_codes.label_errors(none).count() == 0


def test_orchard_ties_and_equal_entries():
    rng = np.random.default_rng(1)
    for _ in range(100):
        k, width, span = rng.integers(1, 65), rng.integers(1, 6), rng.integers(2, 30)
        entries, asked = rng.integers(-span, span, (k, width)), rng.integers(-2 * span, 2 * span, (40, width))
        code, near = vector_codes.Orchard(entries).nearest(asked)
        all_far = ((asked[:, None] - entries) ** 2).sum(axis=2)
        assert (code == all_far.argmin(axis=1)).all() and (near == all_far.min(axis=1)).all()


def test_huge_components_stand_at_the_bound(spark):
    table = spark.createDataFrame([(1, [1e30] * 16, 1), (2, [-1e30] * 16, 1)], "vec_id long, embedding array<float>, label int")
    _, books = vector_codes.compress(table)
    assert set(books.ravel().tolist()) == {1 << 28, -(1 << 28)}
