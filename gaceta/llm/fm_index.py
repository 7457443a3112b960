"""An FM-index over a sequence of small numbers: backward search and location, in numpy.

All methods work on arrays of queries at once.
"""

from __future__ import annotations

import numpy as np

# Symbol that ends a stretch; nothing that is searched for holds it.
BREAK = 0


def suffix_order(symbols: np.ndarray, largest: int) -> np.ndarray:
    """Suffixes in the order of their symbols up to the next break, ties by position.

    The sequence ends with a break. As many symbols as fit a long are sorted at once; after
    that the compared length doubles, and only suffixes that still tie are sorted again.
    """
    n = len(symbols)
    bits = max(1, int(largest).bit_length())
    compared = max(1, 62 // bits)
    padded = np.concatenate([symbols, np.zeros(compared, symbols.dtype)]).astype(np.int64)
    key, open_end = padded[:n].copy(), padded[:n] != BREAK
    for i in range(1, compared):
        following = np.where(open_end, padded[i:i + n], BREAK)
        key = key << bits | following
        open_end = following != BREAK
    order = np.argsort(key, kind="stable")
    key, open_end = key[order], open_end[order]
    places = np.arange(n)
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    # A suffix whose break was reached has its place; others share that of their first.
    rank = np.empty(n, np.int64)
    rank[order] = np.where(open_end, np.maximum.accumulate(np.where(fresh, places, 0)), places)
    tied = order[open_end & ~(fresh & np.concatenate([fresh[1:], [True]]))]
    while len(tied):
        first, second = rank[tied], rank[tied + compared]
        both = first * n + second
        turn = np.argsort(both, kind="stable")
        tied, first, both = tied[turn], first[turn], both[turn]
        steps = np.arange(len(tied))
        group = np.concatenate([[True], first[1:] != first[:-1]])
        place = first + steps - np.maximum.accumulate(np.where(group, steps, 0))
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        order[place] = tied
        rank[tied] = np.maximum.accumulate(np.where(fresh, place, 0))
        tied = tied[~(fresh & np.concatenate([fresh[1:], [True]]))]
        compared *= 2
    return order


class Bits:
    """A row of bits that answers how many are set before a place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """How often a symbol occurs before a place: one row of bits per bit of a symbol.

    On every level the symbols with a set bit come after those without, in unchanged order.
    """

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels, self.n = [], len(symbols)
        for shift in reversed(range(max(1, int(largest).bit_length()))):
            bits = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), len(symbols) - int(bits.sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        every = np.arange(largest + 1)
        # Where each symbol's stretch begins on the last level.
        self.start = self._down(every, np.zeros(largest + 1, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbols >> shift & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbols[i]`` before place ``at[i]``."""
        return self._down(symbols, at) - self.start[symbols]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its occurrences before that place."""
        symbols = np.zeros(len(at), np.int64)
        for _, bits, zeros in self.levels:
            bit, ones = bits.get(at), bits.rank(at)
            at = np.where(bit, zeros + ones, at - ones)
            symbols = symbols << 1 | bit
        return symbols, at - self.start[symbols]


class FmIndex:
    """``symbols``: 1 to ``largest`` in stretches, with a break before, between and after them."""

    def __init__(self, symbols: np.ndarray, largest: int, rate: int = 8):
        order = suffix_order(symbols, largest)
        self.tree = WaveletTree(symbols[order - 1], largest)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))])
        # Positions are kept for every rate-th place of a stretch, its first included: the
        # way back from any place meets one before it meets a break.
        places = np.arange(len(symbols))
        begin = np.maximum.accumulate(np.where(symbols == BREAK, places + 1, 0))
        sampled = ((places - begin) % rate == 0) & (symbols != BREAK)
        self.sampled, self.samples = Bits(sampled[order]), order[sampled[order]]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) of the suffixes that begin with each phrase; one phrase per row."""
        last = phrases[:, -1]
        low, high = self.smaller[last], self.smaller[last + 1]
        live = np.flatnonzero(low < high)
        for i in reversed(range(phrases.shape[1] - 1)):
            symbol = phrases[live, i]
            ends = self.tree.rank(np.tile(symbol, 2), np.concatenate([low[live], high[live]]))
            below = self.smaller[symbol]
            low[live], high[live] = below + ends[:len(live)], below + ends[len(live):]
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in ``symbols`` of the suffixes at these places of the order."""
        position = np.empty(len(rows), np.int64)
        todo, back = np.arange(len(rows)), 0
        while len(todo):
            known = self.sampled.get(rows)
            position[todo[known]] = self.samples[self.sampled.rank(rows[known])] + back
            todo, rows = todo[~known], rows[~known]
            symbol, before = self.tree.read(rows)
            rows, back = self.smaller[symbol] + before, back + 1
        return position
