"""Tokens, pseudonyms, rules, urls and mixing: brute force, round trips, edge rows."""

import hashlib
import math
import random
import re
from collections import Counter
from datetime import date, timedelta

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaceta.llm import bpe, host_rules, mixing, pseudonyms, queries, url_reputation
from tests.conftest import SF

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def tools():
    vocabulary = bpe.Vocabulary(open(FILE, encoding="utf-8").read())
    return bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)


def test_bpe_matches_the_library(tools, reference):
    encoder, decoder = tools
    rng = random.Random(1)
    letters = "ab cdeéèñ \n\t'sst<|endoftext|>123!!!..## aaaa   日本 🙂"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 3000, " " * 2000, "ab" * 2000, "\n" * 900 + "x", "<|endoftext|>" * 3, "x<|endoftext|> y"]
    texts += [f"a{chr(c)}{chr(c)} 1{chr(c)}b" for c in range(0, 0x3100) if not 0xD800 <= c < 0xE000]
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), "<u4")
        expected = reference.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, repr(text)
        assert decoder.decode(ids) == reference.decode(expected, skip_special_tokens=False)


def test_bpe_every_token_encodes_to_itself(tools):
    encoder, _ = tools
    for token, i in encoder.vocabulary.mergeable.items():
        assert encoder.encode_piece(token) == [i]


def test_bpe_forgets_pieces_safely(tools, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder, _ = tools
    text = " ".join(f"palabra{i % 9}" for i in range(60))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference.encode(text).ids


def test_bpe_query(spark, documents, reference):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    rows = queries.op3_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode(texts[r.doc_id], add_special_tokens=False).ids
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = reference.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_bpe_tables_and_edges(awkward):
    ids = bpe.encode_texts(awkward, FILE)
    back = sorted(((r.doc_id, r.text) for r in bpe.decode_ids(ids, FILE).collect()), key=repr)
    assert back == sorted(((r.doc_id, r.text or "") for r in awkward.collect()), key=repr)
    assert bpe.digests(awkward, FILE).count() == awkward.count()
    assert bpe.digests(awkward.limit(0), FILE).collect() == []


# Pseudonyms by hand: the same network in Python.
def keyed(key, tweak, i, half):
    return int(hashlib.sha256(f"{key}|{tweak}|{i}|{half}".encode()).hexdigest()[:15], 16)


def feistel(key, tweak, x, y, a, b):
    for i in range(1, pseudonyms.ROUNDS + 1):
        x, y, a, b = y, (x + keyed(key, tweak, i, y)) % a, b, a
    return x, y


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def permuted(key, kind, text):
    out = ""
    for at in range(0, max(1, len(text)), pseudonyms.BLOCK):
        block = text[at:at + pseudonyms.BLOCK]
        kinds = [("0", 10) if c.isdigit() else ("a", 26) if c.islower() else ("A", 26) if c.isupper() else (c, 1)
                 for c in block]
        half = math.ceil(len(block) / 2)
        number = lambda part, ks: sum(
            (ord(c) - ord(z)) * math.prod(r for _, r in ks[i + 1:]) for i, (c, (z, r)) in enumerate(zip(part, ks)))
        sizes = [math.prod(r for _, r in ks) for ks in (kinds[:half], kinds[half:])]
        values = feistel(key, f"{kind}|{len(block)}", number(block[:half], kinds[:half]),
                         number(block[half:], kinds[half:]), *sizes)
        for n, ks in zip(values, (kinds[:half], kinds[half:])):
            written = ""
            for z, r in reversed(ks):
                written = (z if r == 1 else chr(ord(z) + n % r)) + written
                n //= r
            out += written
    return out


def dressed(digits, shape):
    digits = iter(digits)
    return "".join(next(digits) if c.isdigit() else c for c in shape)


# Country codes of one and two digits; all others have three.
CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
         "81 82 84 86 90 91 92 93 94 95 98".split()}


def pseudonym_by_hand(match, key):
    if "@" in match:
        name, _, domain = match.partition("@")
        return f"{permuted(key, 'email', name)}@{domain}"
    if re.fullmatch(r"(\d{1,3}\.){3}\d{1,3}", match):
        o = [int(x) for x in match.split(".")]
        if max(o) > 255:
            return match
        x, y = feistel(key, "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return f"{x >> 8}.{x % 256}.{y >> 8}.{y % 256}"
    fields = re.split(r"[-/.]", match)
    if len(fields) == 3 and re.fullmatch(r"[\d./-]+", match):
        order = (0, 1, 2) if len(fields[0]) == 4 else (2, 1, 0) if "." in match else (2, 0, 1)
        try:
            day = date(*[int(fields[i]) for i in order])
        except ValueError:
            return match
        ordinal = (day - date(1600, 1, 1)).days
        within = ordinal % 146097
        x, y = feistel(key, "date", within // 773, within % 773, 189, 773)
        new = date(1600, 1, 1) + timedelta(ordinal - within + x * 773 + y)
        values = dict(zip(order, (f"{new.year:04d}", *[
            f"{v:02d}" if len(match) == 10 else str(v) for v in (new.month, new.day)])))
        return re.search(r"[-/.]", match)[0].join(values[i] for i in range(3))
    digits = re.sub(r"\D", "", match)
    if match[0] in "+(":
        plus = digits if match[0] == "+" else ""
        code = next((plus[:n] for n in (1, 2) if plus[:n] in CODES), plus[:3])
        return dressed(code + permuted(key, "phone", digits[len(code):]), match)
    if luhn(digits):
        return match
    body = permuted(key, "card", digits[:-1])
    return dressed(body + str(-luhn(body + "0") % 10), match)


VALUES = ["4417744280351547", "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "+1 (017) 555-7713",
          "+49 301 234567", "(212) 555-0123", "97.51.17.173", "255.255.255.255", "0.0.0.0", "2024-02-29", "2023/1/5",
          "31.12.1999", "1.5.2020", "12/31/2021", "2399-12-31", "1600-01-01", "jo.81@mail7.example.com",
          "Ana_Maria.de-la-Cruz.1987+noticias@correo.ejemplo.cl", "x@y.zz"]
INVALID = ["4417744280351548", "300.1.1.1", "2023-02-30", "31/12/2021", "1599-12-31", "123456789012",
           "9233a8ecf7c5b09fe5949719b6b82bc439e9329b", "version 1.2.3", "99.99.2020"]


def replaced(spark, texts, **params):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pseudonyms.pseudonymise(docs, pseudonyms.PseudonymParams(**{"key": "gaceta-pseudonyms"} | params)).orderBy("doc_id").collect()
    return [(r.text, r.n_replaced) for r in rows]


def test_pseudonyms_by_hand(spark):
    texts = [f"Antes {v}, después." for v in VALUES]
    expected = [(f"Antes {pseudonym_by_hand(v, 'k')}, después.", 1) for v in VALUES]
    assert replaced(spark, texts, key="k") == expected
    assert all(e[0] != t for e, t in zip(expected, texts))
    assert replaced(spark, [f"a {v} b" for v in INVALID], key="k") == [(f"a {v} b", 0) for v in INVALID]


def test_cards_next_to_short_numbers(spark):
    card, other = "4111 1111 1111 1111", "378282246310005"
    new, new_other = (pseudonym_by_hand(c, "k") for c in (card, other))
    around = ["{} 12/26", "{} 123", "7 {}", "{} 12ab", "1234 5678 {} 123", "{}-7", "{} 2024-13-45"]
    assert replaced(spark, [a.format(card) for a in around], key="k") == [(a.format(new), 1) for a in around]
    assert replaced(spark, [f"{card} {other} 55"], key="k") == [(f"{new} {new_other} 55", 2)]
    for value in ("2024-02-29", "12/31/2021", "10.0.0.1", "99@x.com"):
        assert replaced(spark, [f"{card} {value}"], key="k") == [(f"{new} {pseudonym_by_hand(value, 'k')}", 2)]
    long = "12345 " * 3000
    assert len(replaced(spark, [long])[0][0]) == len(long)


def test_timestamps_and_international_phones(spark):
    day = pseudonym_by_hand("2024-05-06", "k")
    phones = ["+33 1 23 45 67 89", "+1.555.555.1234", "+4420 7946 0958", "+442079460958", "+1 555-12.34"]
    texts = ["2024-05-06T10:00:00Z", "2024-05-06Tuesday", "+1 2", *phones, f"{phones[0]} 2024-05-06T10"]
    expected = [(f"{day}T10:00:00Z", 1), ("2024-05-06Tuesday", 0), ("+1 2", 0),
                *[(pseudonym_by_hand(p, "k"), 1) for p in phones],
                (f"{pseudonym_by_hand(phones[0], 'k')} {day}T10", 2)]
    assert replaced(spark, texts, key="k") == expected


def test_pseudonyms_keep_format_and_links(spark):
    found = [t for t, _ in replaced(spark, VALUES)]
    for old, new in zip(VALUES, found):
        assert len(new) == len(old) or old[0].isdigit()  # addresses and short dates may vary
        assert luhn(re.sub(r"\D", "", new)) == 0 if old in VALUES[:4] else True
    assert found[1].replace(" ", "") == found[2].replace("-", "")
    assert replaced(spark, VALUES, key="otra") != replaced(spark, VALUES)
    (twice, n), = replaced(spark, ["4417744280351547 x 4417744280351547 2024-02-29 31.02.2024"])
    assert n == 3 and twice.split(" ")[0] == twice.split(" ")[2] and twice.endswith("31.02.2024")


def test_pseudonyms_are_a_permutation(spark):
    days = [str(date(2000, 1, 1) + timedelta(i)) for i in range(0, 146097, 61)]
    new = [t for t, n in replaced(spark, days)]
    assert len(set(new)) == len(days) and set(new) != set(days)
    ips = [f"10.0.{i // 256}.{i % 256}" for i in range(2000)]
    assert len({t for t, _ in replaced(spark, ips)}) == len(ips)
    assert [pseudonym_by_hand(d, "gaceta-pseudonyms") for d in days[:50]] == new[:50]


def test_pseudonyms_query_and_edges(spark, documents, awkward):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    rows = queries.op4_pseudonyms(spark, SF).collect()
    assert len(rows) == len(texts)
    candidate = re.compile(pseudonyms.CANDIDATE)
    for r in rows:
        key = "gaceta-pseudonyms"
        assert r.text == candidate.sub(lambda m: pseudonym_by_hand(m[0], key), texts[r.doc_id])
    assert sum(r.n_replaced for r in rows) > 0
    out = pseudonyms.pseudonymise(awkward, pseudonyms.PseudonymParams("k"))
    assert out.columns == [*awkward.columns, "n_replaced"] and out.count() == awkward.count()
    assert sorted(out.drop("n_replaced").collect(), key=repr) == sorted(awkward.collect(), key=repr)
    assert pseudonyms.pseudonymise(awkward.limit(0), pseudonyms.PseudonymParams("k")).collect() == []


def repeats_by_hand(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    return len({i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)})


def test_host_rules_by_hand(spark, awkward):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abc", k=n)) for n in [*range(0, 40), 200, 900]] + [
        "a b c d e " * 3, "uno dos tres cuatro cinco seis uno dos tres cuatro cinco", "\n\n \n x \nx\n x "]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in [*host_rules.document_rules(docs).collect(), *host_rules.document_rules(awkward).collect()]:
        if r.host != "s":
            continue
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(lines) - len(set(lines)), repeats_by_hand(words)), text
    judged = host_rules.host_quality(awkward)
    assert judged.count() == awkward.count()
    assert all(r.base_failed and not r.kept for r in judged.collect() if r.n_words == 0)
    assert host_rules.host_quality(awkward.limit(0)).collect() == []


def test_bad_hosts_take_their_documents_along(spark):
    long = " ".join(f"palabra{i}" for i in range(30))
    rows = [(i, "corto" if i % 10 else long, "malo") for i in range(200)]
    rows += [(1000 + i, long, "bueno") for i in range(200)] + [(5000, long, "nuevo"), (5001, "corto", "nuevo2")]
    kept = {r.doc_id: r.kept for r in host_rules.host_quality(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(kept[i] for i in range(200))
    assert all(kept[1000 + i] for i in range(200)) and kept[5000]


URLS = {
    "http://A.Example.ORG/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
    "https://example.org/en/1x?q#f": ("example.org", "/en/1x", "example.org/en/1", "block"),
    "https://badexample.org/es/1": ("badexample.org", "/es/1", "org/", "allow"),
    "https://x.com/fr/": ("x.com", "/fr/", "com/fr/", "allow"),
    "ftp://x.com/de/#a": ("x.com", "/de/", "com/de/", "block"),
    "http://host?x=/es/": ("host", "", None, None), "http://org": ("org", "", None, None),
    "sin esquema": ("", "", None, None), None: ("", "", None, None),
    "a://b://c/d": ("b:", "//c/d", None, None), "http://Ñandú.CL:80/x\ny": ("Ñandú.cl:80", "/x\ny", None, None),
}


def test_urls(spark, no_labels):
    pages = spark.createDataFrame(
        [(i, u, "k") for i, u in enumerate(URLS)] + [(None, "http://z.org/", "k"), (0, next(iter(URLS)), "k")],
        "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, True), (1, False), (None, True), (2, None)], "page_id long, bad boolean")
    rows = url_reputation.judge_urls(pages, labels).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        if r.page_id is not None:
            host, path, rule, verdict = list(URLS.values())[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == verdict or verdict is None
    assert url_reputation.judge_urls(pages.limit(0), labels).collect() == []
    assert url_reputation.judge_urls(pages, labels.limit(0)).count() == len(rows)


def test_reputation_shrinks(spark):
    rows, labels, n = [], [], 0
    for host, good, bad in (
            ("bad.spam.net", 5, 95), ("new.spam.net", 0, 0), ("fine.net", 950, 50), ("good.net", 900, 90),
            ("one.other.net", 0, 1)):
        for k in range(max(1, good + bad)):
            rows.append((n, f"http://{host}/{k}"))
            if good + bad:
                labels.append((n, k < bad))
            n += 1
    found = {r.host: r for r in url_reputation.judge_urls(
        spark.createDataFrame(rows, "page_id long, url string"),
        spark.createDataFrame(labels, "page_id long, bad boolean")).collect()}
    assert found["bad.spam.net"].verdict == "block" and found["fine.net"].verdict == "allow"
    # One bad page is too little; a new host stands as its domain does.
    assert found["one.other.net"].verdict == "allow"
    assert found["new.spam.net"].bad_bound > found["one.other.net"].bad_bound


def test_poisson_table(spark):
    rates = spark.createDataFrame([("a", 0.2), ("b", 5.0), ("c", 31.9), ("d", 100.0)], "source string, rate double")
    for r in mixing.poisson_table(rates).collect():
        mean = r.rate / r.parts
        assert mean <= mixing.PART_MEAN
        expected = np.cumsum([math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(len(r.cdf))])
        assert np.allclose(r.cdf, expected, atol=1e-12) and r.cdf[-1] > 1 - 1e-12


def test_mix_reaches_its_targets(spark):
    rows = [(i, "t", "es", s, 1) for i, s in enumerate(["big"] * 6000 + ["small"] * 300 + [None] * 700 + ["out"] * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    params = mixing.MixParams(weights={"big": 1.0, "small": 2.0, "": 1.0}, epochs=2.0)
    mixed = mixing.mix_sources(docs, params)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    total = 2 * len(rows)
    for source, share in (("big", 0.25), ("small", 0.5), (None, 0.25)):
        assert abs(counts[source] - share * total) < 6 * math.sqrt(share * total)
    assert "out" not in counts
    again = mixing.mix_sources(docs.repartition(3), params)
    assert sorted(mixed.collect(), key=repr) == sorted(again.collect(), key=repr)
    order = [r.doc_id for r in mixed.collect()]
    assert order != sorted(order)


def test_mix_edges(awkward):
    mixed = mixing.mix_sources(awkward, mixing.MixParams(epochs=40.0))
    assert mixed.columns == [*awkward.columns, "copy"]
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in awkward.collect()}
    assert mixing.mix_sources(awkward.limit(0)).collect() == []
    assert mixing.mix_sources(awkward, mixing.MixParams(weights={})).collect() == []
