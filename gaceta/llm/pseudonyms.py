"""Format-preserving pseudonyms: a keyed Feistel network permutes each value within its format.

Cards (Luhn), phone numbers, IPv4 addresses, calendar dates and the names in e-mail
addresses. Equal values get equal pseudonyms in every document, and different values of a
format different ones; without the key nothing leads back. Built-in expressions only.

Left out: national phone numbers but (ddd) ddd-dddd, those with 00 or slashes, parentheses
elsewhere than after the country code; dates without separators or with names of months,
two-digit years, and times of day; IPv6; cards with other separators than one space or dash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta.llm.columns import let

ROUNDS = 10
# Days of the 400-year cycle of the calendar: 189 * 773.
CYCLE, CYCLE_LEFT, CYCLE_RIGHT = 146097, 189, 773
FIRST_DAY, FIRST_YEAR = "1600-01-01", 1600
# --- Fixed values: country codes of telephone numbers, of one, two, or else three digits. ---
COUNTRY_CODE = (r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})")
# --- End of fixed values. ---
# Symbols of a text that are permuted together; each half is a number below 26 ** 12.
BLOCK = 24

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IPV4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
_BORDER = r"(?![0-9A-Za-z]|\.[0-9])"
# The T of a timestamp may follow a date.
_DATE_BORDER = r"(?!(?!T[0-9])[0-9A-Za-z]|\.[0-9])"
_DATES = (r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|"
          r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}")
# Numbers of 13 digits and more in all, one space or dash apart, that may hold cards; up to
# a date or an address. Possessive, so long runs need no stack.
_OTHER = f"[ -](?:(?:{_DATES}){_DATE_BORDER}|[A-Za-z0-9._%+-]{{1,64}}+@)"
# Country code and groups in the usual lengths; or 8 to 15 digits in any groups; or (ddd) ddd-dddd.
PHONE = (r"\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}" f"{_BORDER}|"
         f"\\+[0-9](?:(?!{_OTHER})[ .-]?[0-9]){{7,14}}|"
         r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}")
CARD = (f"(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++{_BORDER}"
        f"(?:(?!{_OTHER})[ -][0-9]++{_BORDER})*+")
CANDIDATE = (f"{EMAIL}|(?<![0-9A-Za-z.])(?:(?:{_DATES}){_DATE_BORDER}|"
             f"(?:{IPV4}|{PHONE}){_BORDER}|{CARD})")


@dataclass(frozen=True)
class PseudonymParams:
    # The secret: whoever has it can undo the pseudonyms, whoever has not cannot.
    key: str


def _round(key: str, tweak: Column, i: Column, half: Column) -> Column:
    """A keyed pseudo-random number below 2 ** 60."""
    message = F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(message, 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, tweak: Column, left: Column, right: Column, a: Column, b: Column) -> Column:
    """(left, right), a number below ``a`` and one below ``b``, permuted among such pairs.

    Every round adds to one half a keyed function of the other and swaps them, so each
    round, and the whole, can be undone: it is a permutation for any ``a`` and ``b``.
    """
    start = F.struct(left.cast("long").alias("x"), right.cast("long").alias("y"),
                     a.cast("long").alias("p"), b.cast("long").alias("q"))

    def step(s: Column, i: Column) -> Column:
        x = F.pmod(s.getField("x") + _round(key, tweak, i, s.getField("y")), s.getField("p"))
        return F.struct(s.getField("y").alias("x"), x.alias("y"),
                        s.getField("q").alias("p"), s.getField("p").alias("q"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _characters(text: Column) -> Column:
    return F.transform(
        F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text)))
        .otherwise(F.array().cast("array<int>")),
        lambda i: F.substring(text, i, F.lit(1)))


def _radix(c: Column) -> Column:
    return (F.when(c.between("0", "9"), 10).when(c.between("a", "z"), 26)
            .when(c.between("A", "Z"), 26).otherwise(1).cast("long"))


def _base(c: Column) -> Column:
    """Code point of the symbol zero of the kind of ``c``; of ``c`` itself if it is fixed."""
    return (F.when(c.between("0", "9"), ord("0")).when(c.between("a", "z"), ord("a"))
            .when(c.between("A", "Z"), ord("A")).otherwise(F.ascii(c)))


def _number(chars: Column) -> Column:
    return F.aggregate(chars, F.lit(0).cast("long"), lambda n, c: n * _radix(c) + F.ascii(c) - _base(c))


def _size(chars: Column) -> Column:
    return F.aggregate(chars, F.lit(1).cast("long"), lambda n, c: n * _radix(c))


def _written(number: Column, chars: Column) -> Column:
    """A number in the symbols of the kinds that ``chars`` shows."""
    start = F.struct(number.alias("n"), F.lit("").alias("out"))

    def step(s: Column, c: Column) -> Column:
        n = s.getField("n")
        symbol = F.when(_radix(c) == 1, c).otherwise(F.chr(_base(c) + n % _radix(c)))
        return F.struct(F.call_function("div", n, _radix(c)).alias("n"),
                        F.concat(symbol, s.getField("out")).alias("out"))

    return F.aggregate(F.reverse(chars), start, step, lambda s: s.getField("out"))


def permute_symbols(key: str, kind: str, text: Column) -> Column:
    """ASCII letters and digits of ``text`` permuted among texts of the same shape."""
    def block(chars: Column) -> Column:
        half = F.ceil(F.size(chars) / 2).cast("int")
        halves = F.struct(
            F.slice(chars, F.lit(1), half).alias("l"),
            F.slice(chars, half + 1, F.size(chars) - half).alias("r"))

        def both(h: Column) -> Column:
            l, r = h.getField("l"), h.getField("r")
            tweak = F.concat(F.lit(f"{kind}|"), F.size(chars).cast("string"))
            moved = feistel(key, tweak, _number(l), _number(r), _size(l), _size(r))
            return let(moved, lambda m: F.concat(
                _written(m.getField("x"), l), _written(m.getField("y"), r)))

        return let(halves, both)

    def blocks(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(chars), F.lit(1)), F.lit(BLOCK))
        return F.array_join(F.transform(starts, lambda i: block(F.slice(chars, i, BLOCK))), "")

    return let(_characters(text), blocks)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _dressed(digits: Column, shape: Column) -> Column:
    """``digits`` in the places where ``shape`` has digits."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(s: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        k = s.getField("k")
        return F.struct(
            F.concat(s.getField("out"), F.when(digit, F.substring(digits, k, F.lit(1))).otherwise(c))
            .alias("out"), F.when(digit, k + 1).otherwise(k).alias("k"))

    return F.aggregate(_characters(shape), start, step, lambda s: s.getField("out"))


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; ``doubled`` is 0 if the last digit is doubled, 1 if the one before is."""
    at = lambda i: F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == doubled, F.when(at(i) > 4, 2 * at(i) - 9).otherwise(2 * at(i))
                             ).otherwise(at(i))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0),
                       lambda total, i: total + value(i))


def _cards(key: str, match: Column) -> Column:
    """(new, n): a run of numbers with its cards renewed, and how many; null and 0 if none.

    Cards are 13 to 19 digits of whole numbers of the run that pass Luhn. Where such
    overlap, the longest is taken, of equal ones the first.
    """
    def renewed(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)
        return let(permute_symbols(key, "card", body), lambda new: F.concat(
            new, ((10 - luhn_sum(new, 0) % 10) % 10).cast("string")))

    def whole(numbers: Column) -> Column:
        joined = lambda i, n: F.array_join(F.slice(numbers, i, n), "")
        last = F.size(numbers)
        one = lambda i, j: F.struct(
            F.length(joined(i, j - i + 1)).alias("length"), i.alias("i"), j.alias("j"))
        cards = F.flatten(F.transform(F.sequence(F.lit(1), last), lambda i: F.filter(
            F.transform(F.sequence(i, F.least(i + 18, last)), lambda j: one(i, j)),
            lambda c: c.getField("length").between(13, 19) & let(
                joined(c.getField("i"), c.getField("j") - c.getField("i") + 1),
                lambda d: luhn_sum(d, 1) % 10 == 0))))
        ranked = F.array_sort(F.transform(cards, lambda c: F.struct(
            (-c.getField("length")).alias("rank"), c.getField("i").alias("i"), c.getField("j").alias("j"))))
        taken = F.aggregate(
            ranked, F.array().cast("array<struct<i:int,j:int>>"),
            lambda found, c: F.when(
                F.exists(found, lambda x: (x.getField("i") <= c.getField("j"))
                         & (c.getField("i") <= x.getField("j"))), found)
            .otherwise(F.array_append(found, F.struct(c.getField("i").alias("i"), c.getField("j").alias("j")))))

        def rebuilt(found: Column) -> Column:
            start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
            step = lambda s, c: F.struct(
                (c.getField("j") + 1).alias("at"), F.concat(
                    s.getField("out"), joined(s.getField("at"), c.getField("i") - s.getField("at")),
                    renewed(joined(c.getField("i"), c.getField("j") - c.getField("i") + 1))).alias("out"))
            digits = F.aggregate(F.array_sort(found), start, step, lambda s: F.concat(
                s.getField("out"), joined(s.getField("at"), last - s.getField("at") + 1)))
            return F.struct(F.when(F.size(found) > 0, _dressed(digits, match)).alias("new"),
                            F.size(found).alias("n"))

        return let(taken, rebuilt)

    return let(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0)), whole)


def _phone(key: str, match: Column) -> Column:
    """The country code after a plus sign stays, however the number is cut into groups."""
    code = F.when(match.startswith("+"), F.regexp_extract(
        _digits(match), COUNTRY_CODE, 0)).otherwise("")

    def renewed(c: Column) -> Column:
        rest = F.substring(_digits(match), F.length(c) + 1, F.length(match))
        return _dressed(F.concat(c, permute_symbols(key, "phone", rest)), match)

    return let(code, renewed)


def _ipv4(key: str, match: Column) -> Column:
    def renewed(octets: Column) -> Column:
        pair = lambda i: F.get(octets, F.lit(i)) * 256 + F.get(octets, F.lit(i + 1))
        whole = F.lit(65536)
        moved = feistel(key, F.lit("ipv4"), pair(0), pair(2), whole, whole)
        text = lambda n: F.concat_ws(".", F.shiftright(n, 8).cast("string"), (n % 256).cast("string"))
        return F.when(F.array_max(octets) < 256, let(moved, lambda m: F.concat_ws(
            ".", text(m.getField("x")), text(m.getField("y")))))

    return let(F.transform(F.split(match, r"\."), lambda o: o.cast("int")), renewed)


def _moved_day(key: str, day: Column) -> Column:
    """Another day of the same 400-year cycle."""
    first = F.lit(FIRST_DAY).cast("date")
    ordinal = F.datediff(day, first)
    within = F.pmod(ordinal, F.lit(CYCLE))
    moved = feistel(
        key, F.lit("date"), F.floor(within / CYCLE_RIGHT), within % CYCLE_RIGHT,
        F.lit(CYCLE_LEFT), F.lit(CYCLE_RIGHT))
    return let(moved, lambda m: F.date_add(
        first, (ordinal - within + m.getField("x") * CYCLE_RIGHT + m.getField("y")).cast("int")))


def _date(key: str, match: Column) -> Column:
    """Year first, or day.month.year, or month/day/year; as many digits as before if padded."""
    out = F.lit(None).cast("string")
    for pattern, mark, fields in (
        (r"^[0-9]{4}-", "-", "ymd"), (r"^[0-9]{4}/", "/", "ymd"),
        (r"^[0-9]{1,2}\.", ".", "dmy"), (r"^[0-9]{1,2}/", "/", "mdy"),
    ):
        part = lambda f: F.lpad(
            F.get(F.split(match, "[-/.]"), F.lit(fields.index(f))), 4 if f == "y" else 2, "0")
        style = lambda names: mark.join(names[f] for f in fields)
        padded = style({"y": "yyyy", "m": "MM", "d": "dd"})
        short = style({"y": "yyyy", "m": "M", "d": "d"})
        day = F.try_to_date(F.concat_ws("-", part("y"), part("m"), part("d")), "yyyy-MM-dd")
        written = lambda d: F.when(
            F.length(match) == 10, F.date_format(d, padded)).otherwise(F.date_format(d, short))
        made = let(day, lambda d: F.when(
            F.year(d) >= FIRST_YEAR, let(_moved_day(key, d), written)))
        out = F.when(match.rlike(pattern), made).otherwise(out)
    return out


def _email(key: str, match: Column) -> Column:
    name = F.substring_index(match, "@", 1)
    return F.concat(permute_symbols(key, "email", name), F.lit("@"), F.substring_index(match, "@", -1))


def pseudonym(key: str, match: Column) -> Column:
    """(new, n): a candidate with its values replaced, and how many; null and 0 if none is valid."""
    is_date = match.rlike(f"^(?:{_DATES})$")
    is_phone = match.startswith("+") | match.startswith("(")
    single = (
        F.when(F.contains(match, F.lit("@")), _email(key, match))
        .when(is_date, _date(key, match))
        .when(match.rlike(f"^{IPV4}$"), _ipv4(key, match))
        .otherwise(_phone(key, match)))
    is_run = ~(F.contains(match, F.lit("@")) | is_date | is_phone) & match.rlike("^[0-9 -]+$")
    return F.when(is_run, _cards(key, match)).otherwise(let(single, lambda new: F.struct(
        new.alias("new"), F.when(new.isNotNull(), 1).otherwise(0).alias("n"))))


def pseudonymise(docs: DataFrame, params: PseudonymParams) -> DataFrame:
    """All rows of ``docs`` with valid values in ``text`` replaced, and ``n_replaced``.

    A number that fails its check (Luhn, octets up to 255, the calendar, years from 1600)
    stays as it is. Null texts stay null and have none. Texts are read whole; rows do not
    move; other columns come along, an input column named n_replaced excepted. Empty texts
    stay empty, repeated rows get the same pseudonyms, an empty table stays one.
    """
    text, key = F.col("text"), params.key
    hits = F.regexp_extract_all(text, F.lit(f"({CANDIDATE})"), F.lit(0))
    pairs = F.transform(hits, lambda m: let(pseudonym(key, m), lambda p: F.struct(
        m.alias("old"), p.getField("new").alias("new"), p.getField("n").alias("n"))))

    def rebuilt(found: Column) -> Column:
        new = F.transform(found, lambda p: F.coalesce(p.getField("new"), p.getField("old")))
        return F.struct(
            F.array_join(F.zip_with(F.split(text, CANDIDATE, -1), new, lambda gap, value: F.concat(
                gap, F.coalesce(value, F.lit("")))), "").alias("text"),
            F.aggregate(found, F.lit(0).cast("long"), lambda n, p: n + p.getField("n")).alias("n"))

    none = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    result = let(pairs, lambda found: F.when(F.size(found) > 0, rebuilt(found)).otherwise(none))
    names = [c for c in docs.columns if c != "n_replaced"]
    inputs = [f"in_{i}" for i in range(len(names))]
    made = docs.select(*[F.col(c).alias(i) for c, i in zip(names, inputs)], result.alias("made"))
    return made.select(
        *[(F.col("made.text") if c == "text" else F.col(i)).alias(c) for c, i in zip(names, inputs)],
        F.coalesce("made.n", F.lit(0)).alias("n_replaced"))
