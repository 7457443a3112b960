"""Text expressions: accent folding, tokens, word counts, encoding repair.

All of them are built-in expressions, so the rows never leave the JVM.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaceta.params import TokenParams


@cache
def _fold_map() -> tuple[str, str]:
    """Every BMP character whose canonical decomposition holds one ASCII character."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        ascii_part = [c for c in unicodedata.normalize("NFD", chr(code)) if c < "\x80"]
        if len(ascii_part) == 1:
            source.append(chr(code))
            target.append(ascii_part[0])
    return "".join(source), "".join(target)


def fold(text: Column) -> Column:
    """Lower-case, take accents off, drop what is still not ASCII."""
    source, target = _fold_map()
    lowered = F.lower(F.coalesce(text, F.lit("")))
    plain = F.regexp_replace(F.translate(lowered, source, target), r"[^\x00-\x7F]+", "")
    # translate() looks up every character by itself, which ASCII texts can do without.
    return F.when(lowered.rlike(r"[^\x00-\x7F]"), plain).otherwise(lowered)


def token_pattern(params: TokenParams) -> str:
    # (?iu): (?i) alone does not pair accented capitals with their small letters.
    return rf"(?iu)[{params.alphabet}]{{{params.min_length},}}"


# The one character whose lower-case form is a letter plus a mark that is no letter.
_DOTTED_CAPITAL_I = "\u0130"


def words(text: Column, params: TokenParams) -> Column:
    """Array of the letter runs of a text, lower-cased; empty for null.

    Runs are defined on the text as written. Lowering the whole text first gives the same
    runs and saves a call per word, except where a dotted capital I occurs.
    """
    pattern, whole = F.lit(token_pattern(params)), F.lit(0)
    found = F.when(
        text.contains(_DOTTED_CAPITAL_I),
        F.transform(F.regexp_extract_all(text, pattern, whole), F.lower),
    ).otherwise(F.regexp_extract_all(F.lower(text), pattern, whole))
    return F.coalesce(found, F.array().cast("array<string>"))


def tokens(text: Column, params: TokenParams = TokenParams()) -> Column:
    """Array of the terms of one text: its words without stop words."""
    found = words(text, params)
    if not params.stop_words:
        return found
    return F.filter(found, lambda w: ~w.isin(*params.stop_words))


def word_count(text: Column) -> Column:
    """Number of runs between Unicode white space; 0 for null or empty text."""
    # Java's \s in (?U) mode leaves out the four separators 0x1C-0x1F.
    runs = F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f]+"))
    return F.coalesce(runs, F.lit(0)).cast("int")


# --- Fixed values: which texts are repaired, and vowels seen as Chinese characters. ---
REPAIR_SIGNS = "ÃÂ豩贸贡赤资"
VOWEL_STAND_INS = "豩贸贡赤资谷"
VOWELS = "áóéíúü"
# --- End of fixed values. ---

# Windows-1252 shows bytes 0x80-0x9F as these characters (five have none).
_CP1252_BYTES = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_CP1252_CHARS = "".join(bytes([b]).decode("cp1252") for b in _CP1252_BYTES)
_C1_CHARS = "".join(chr(b) for b in _CP1252_BYTES)

_LEADS = "ÂÃÄÅÆËâ"
_NO_CHAR = "".join(rf"\x{b:02X}" for b in range(0x80, 0xA0) if b not in _CP1252_BYTES)
_TRAIL = rf"[\x80-\xBF{_CP1252_CHARS}]"
# UTF-8 bytes read one by one: U+00A0-U+017F, general punctuation, euro, trade mark, and
# what Windows-1252 itself adds, since a second misreading turns its characters into pairs.
_MISREAD = (
    rf"Â[\xA0-\xBF{_NO_CHAR}]|[ÃÄÅ]{_TRAIL}|Æ[\x92’]|Ë[\x86\x9C†œ]"
    rf"|â[\x80€]{_TRAIL}|â[\x82‚]¬|â[\x84„]¢"
)
# One misread character, or a stretch free of lead bytes, or a lead byte on its own.
# No repeated group, so long texts do not deepen the matcher's stack.
_SEGMENTS = rf"{_MISREAD}|[^{_LEADS}]+|[{_LEADS}]"


def _decode_misread(text: Column) -> Column:
    def fix(piece: Column) -> Column:
        latin1 = F.encode(F.translate(piece, _CP1252_CHARS, _C1_CHARS), "ISO-8859-1")
        misread = (F.length(piece) > 1) & F.substring(piece, 1, 1).isin(*_LEADS)
        return F.when(misread, F.decode(latin1, "UTF-8")).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(_SEGMENTS), F.lit(0))
    return F.array_join(F.transform(pieces, fix), "")


# The class in front lets the search pass over other characters quickly.
_SOME_MISREAD = rf"(?=[{_LEADS}])(?:{_MISREAD})"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``; the array of one element keeps ``value`` from being evaluated per use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _decoded(text: Column) -> Column:
    """Misread characters decoded; a text that shows none is not taken apart."""
    return F.when(text.rlike(_SOME_MISREAD), _decode_misread(text)).otherwise(text)


# --- Fixed values: what is tidied in a text under repair. ---
SINGLE_QUOTES = "ʼ‘’‚‛"
DOUBLE_QUOTES = "“”„‟"
LINE_ENDS = (0x0D, 0x85, 0x2028, 0x2029)
FULL_WIDTH = range(0xFF01, 0xFF5F)  # of the characters 0xFEE0 before them
WIDE_SPACE = 0x3000
CONTROLS = (*range(0x00, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F,
            *range(0x206A, 0x2070), 0xFEFF, *range(0xFFF9, 0xFFFD))
# --- End of fixed values. ---


@cache
def _tidy_map() -> tuple[str, str]:
    """Straight quotes, plain line ends, full-width forms to ASCII, controls dropped."""
    pairs = {c: "'" for c in SINGLE_QUOTES} | {c: '"' for c in DOUBLE_QUOTES}
    pairs |= {chr(c): "\n" for c in LINE_ENDS}
    pairs |= {chr(c): chr(c - 0xFEE0) for c in FULL_WIDTH} | {chr(WIDE_SPACE): " "}
    # translate() drops source characters that have no partner.
    return "".join(pairs) + "".join(map(chr, CONTROLS)), "".join(pairs.values())


def _tidy(text: Column) -> Column:
    return F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), *_tidy_map())


def _with_vowels(text: Column) -> Column:
    found = reduce(or_, [text.contains(c) for c in VOWEL_STAND_INS])
    return F.when(found, F.translate(text, VOWEL_STAND_INS, VOWELS)).otherwise(text)


def _shows(text: Column, signs: str) -> Column:
    """Whether a text has one of the characters.

    Byte searches cost about half of one regular expression, and a text without the first
    byte that several characters share is searched once for all of them.
    """
    by_lead: dict[bytes, list[str]] = {}
    for sign in signs:
        by_lead.setdefault(sign.encode()[:1], []).append(sign)
    met = lambda lead: F.contains(text.cast("binary"), F.lit(lead))
    return reduce(or_, [
        met(lead) & reduce(or_, [text.contains(c) for c in found]) for lead, found in by_lead.items()])


def repair(text: Column) -> Column:
    """Undo UTF-8 read as Latin-1 or Windows-1252 (also twice over); null becomes "".

    Only texts that show a tell-tale character take the costly branch.
    """
    text = F.coalesce(text, F.lit(""))
    repaired = _let(_let(_let(_decoded(text), _decoded), _tidy), _with_vowels)
    return (
        F.when(_shows(text, REPAIR_SIGNS), repaired)
        .when(_shows(text, VOWEL_STAND_INS[-1]), F.translate(text, VOWEL_STAND_INS, VOWELS))
        .otherwise(text)
    )
