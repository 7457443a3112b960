"""Words of a UTF-8 text by one table: letters lowered, separators blanked, then split."""

from __future__ import annotations

from collections.abc import Iterator

BLANK = 0x20
# Words of a text are listed for about so many bytes at a time.
PIECE_BYTES = 1 << 20
_DIGITS, _LETTERS = range(0x30, 0x3A), range(0x61, 0x7B)


def translate_table(digits: bool) -> bytes:
    """A-Z to a-z; a-z, bytes beyond ASCII and, if wanted, 0-9 stay; all others become blanks."""
    kept = {*_LETTERS, *range(0x80, 0x100), *(_DIGITS if digits else ())}
    lowered = [b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)]
    return bytes(b if b in kept else BLANK for b in lowered)


def word_lists(flat: bytes, piece: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a translated text in order; a long text is cut at blanks."""
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + piece) if at + piece < len(flat) else -1
        end = len(flat) if end < 0 else end
        yield (flat[at:end] if at or end < len(flat) else flat).split()
        at = end
