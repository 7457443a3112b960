"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

The vocabulary file is a parameter; it is read on the driver and goes to the tasks as it is
(its size does not depend on the data). The automaton is built once per Python worker.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# The public pattern that cuts texts into pieces before byte-level merging: contractions,
# letters, digits, other signs, each with one leading space, and runs of white space.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Pieces a worker remembers before it starts over; twice as many token pairs.
REMEMBERED = 1 << 17


def byte_alphabet() -> dict[str, int]:
    """The printable character that vocabulary files write for each byte.

    Bytes that print as themselves in Latin-1 stand for themselves; the others take the
    code points from 256 up, in order.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes, merges and special tokens of a byte-level BPE file in JSON form."""

    def __init__(self, text: str):
        spec = json.loads(text)
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, bytes] = {i: as_bytes(t) for t, i in ids.items()}
        self.tokens |= {i: content.encode() for content, i in self.special.items()}
        # Merge number -> the pair; a pair is named by ids.
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.rank[a, b] = rank
            self.halves.setdefault(whole, (rank, a, b))
        self.mergeable = {as_bytes(t): i for t, i in ids.items()}
        if any(bytes([b]) not in self.mergeable for b in range(256)):
            raise ValueError("not a byte-level vocabulary: some bytes have no token")

    def offsets(self) -> tuple[np.ndarray, np.ndarray]:
        """All token bytes end to end, and where each id's begin; one more entry ends them."""
        size = max(self.tokens) + 1
        pieces = [self.tokens.get(i, b"") for i in range(size)]
        starts = np.zeros(size + 1, np.int64)
        np.cumsum([len(p) for p in pieces], out=starts[1:])
        return np.frombuffer(b"".join(pieces), np.uint8), starts


class Encoder:
    """Exact merges of a piece of text in time linear in its length.

    A sequence of tokens is what merging gives exactly if every pair of neighbours is
    compatible, that is, if merging the bytes of the two gives these two. So the encoder
    takes the longest token at each place, goes to the next shorter one if it is not
    compatible with the token before, and steps back if there is none. Places from which
    it had to step back are not entered again.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.compatible: dict[tuple[int, int], bool] = {}
        # Latin-1 text stands for bytes, one character each.
        self.automaton = ahocorasick.Automaton()
        made = self._mergeable_tokens()
        for token, i in vocabulary.mergeable.items():
            if i in made:
                self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.pieces = regex.compile(PIECES)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        # Pieces of late, and those before them: pieces in use outlive a change of caches.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _mergeable_tokens(self) -> set[int]:
        """Tokens that merging their own bytes ends in; others never come out."""
        vocabulary, made = self.vocabulary, set()
        for i in vocabulary.mergeable.values():
            if i not in vocabulary.halves:
                made.add(i)
        for i, (_, a, b) in sorted(vocabulary.halves.items(), key=lambda x: x[1]):
            if a in made and b in made and self._check_pair(a, b, own=i):
                made.add(i)
        return made

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens together gives back just these two."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= 2 * REMEMBERED:
                self.compatible.clear()
            known = self.compatible[left, right] = self._check_pair(left, right)
        return known

    def _check_pair(self, a: int, b: int, own: int | None = None) -> bool:
        """Undo the merges next to the seam, latest first, and look for one across it.

        At any moment the seam lies between the last part of the left token and the first
        part of the right one. A merge of these two would have come first if its rank is
        below that of the merge that takes one of them away; of equal ranks, the one
        further left comes first. ``own`` is a token whose own merge does not count.
        """
        halves, rank = self.vocabulary.halves, self.vocabulary.rank
        # (rank, side) of the merges that use up the current parts; side 0 is left of the
        # seam, 1 across it, 2 right of it. Whole tokens are used up by none.
        gone = (1 << 60, 0)
        whole = (a, b) if own is not None else None
        while True:
            across = rank.get((a, b))
            if across is not None and (a, b) != whole and (across, 1) < gone:
                return False
            made_a = halves.get(a, (-1,))[0]
            made_b = halves.get(b, (-1,))[0]
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                gone, a = min(gone, (made_a, 0)), halves[a][2]
            else:
                gone, b = min(gone, (made_b, 2)), halves[b][1]

    def encode_piece(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        # Often the longest token at each place, one after the other, is right as it is.
        out, before, known = [], None, self.compatible.get
        for _, (_, token) in self.automaton.iter_long(text):
            if before is not None and not (
                    known((before, token)) or self.pair_fits(before, token)):
                return self._with_steps_back(text)
            out.append(token)
            before = token
        return out

    def _with_steps_back(self, text: str) -> list[int]:
        # Ends and ids of the tokens that start at each place.
        size = len(text)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for end, (length, token) in self.automaton.iter(text):
            starts[end - length + 1].append((end + 1, token))  # the longest comes last
        out: list[int] = []
        path: list[tuple[int, list]] = []  # for each token: where it starts, what is left there
        known, fits = self.compatible.get, self.pair_fits
        dead = bytearray(size + 1)
        at, untried, before = 0, starts[0], None
        while at < size:
            while untried:
                end, token = untried.pop()
                if not dead[end] and (
                        before is None or known((before, token)) or fits(before, token)):
                    out.append(token)
                    path.append((at, untried))
                    at, untried, before = end, starts[end].copy(), token
                    break
            else:
                dead[at] = 1
                at, untried = path.pop()
                out.pop()
                before = out[-1] if out else None
        return out

    def _piece_ids(self, piece: str) -> bytes:
        ids = self.cache.get(piece) or self.older.get(piece)
        if ids is None:
            found = self.encode_piece(piece.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(self.cache) >= REMEMBERED:
            self.older, self.cache = self.cache, {}
        self.cache[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        get = self.cache.get
        at = 0
        for stop in ([*self.special.finditer(text)] if self.special else []):
            self._encode_plain(text[at:stop.start()], get, out)
            out.append(np.array([self.vocabulary.special[stop[0]]], "<u4").tobytes())
            at = stop.end()
        self._encode_plain(text[at:] if at else text, get, out)
        return b"".join(out)

    def _encode_plain(self, text: str, get, out: list[bytes]) -> None:
        make = self._piece_ids
        out.extend([get(p) or make(p) for p in self.pieces.findall(text)])


class Decoder:
    """Bytes of ids by one gather from the offset table."""

    def __init__(self, vocabulary: Vocabulary):
        self.blob, self.starts = vocabulary.offsets()

    def decode(self, ids: np.ndarray) -> str:
        first = self.starts[ids]
        lengths = self.starts[ids + 1] - first
        ends = np.cumsum(lengths)
        shift = np.repeat(first - (ends - lengths), lengths)
        shift += np.arange(len(shift))
        return self.blob[shift].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _tools(spec: str) -> tuple[Encoder, Decoder]:
    vocabulary = Vocabulary(spec)
    return Encoder(vocabulary), Decoder(vocabulary)


def encode_texts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids binary) of every row: token ids as little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the path of a byte-level BPE file. Special tokens written in a text
    become their ids; none is added. Null and empty texts have no ids. Texts are read
    whole; rows stay in their tasks; other columns are not read.
    """
    spec = open(tokenizer, encoding="utf-8").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _tools(spec)
        for batch in batches:
            ids = [encoder.encode(t) if t else b"" for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, _schema(docs, "ids binary"))


def decode_ids(ids: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids) as ``encode_texts`` gives them.

    Special tokens are written out; bytes that are no UTF-8 become U+FFFD; null ids give a
    null text.
    """
    spec = open(tokenizer, encoding="utf-8").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(spec)
        for batch in batches:
            texts = [None if x is None else decoder.decode(np.frombuffer(x, "<u4"))
                     for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, _schema(ids, "text string"))


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass.

    The ids and the decoded text are hashed where they are made and not kept.
    """
    spec = open(tokenizer, encoding="utf-8").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(spec)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for text in _texts(batch):
                ids = encoder.encode(text) if text else b""
                n.append(len(ids) // 4)
                of_ids.append(sha(ids))
                of_text.append(sha(decoder.decode(np.frombuffer(ids, "<u4")).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, _schema(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string"))


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column("text"))


def _schema(docs: DataFrame, rest: str) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {rest}"
