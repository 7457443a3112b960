"""Date expressions: strict parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaceta.params import WEEKDAYS

# Characters Python's strip() takes off.
_SPACE = "".join(
    chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def parse_day(text: Column) -> Column:
    """``yyyy-M-d`` with white space around it to a date; anything else to null."""
    bare = F.btrim(text, F.lit(_SPACE))
    day = F.try_to_date(bare, "yyyy-M-d")
    return F.when(bare.rlike(r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"), day)


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def date_key(text: Column, canonical: bool = True) -> Column:
    """The value a date is known by: its ISO form, or the text where it is no date."""
    return F.coalesce(iso_day(parse_day(text)), text) if canonical else text


def weekday_name(day: Column) -> Column:
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return F.element_at(names, F.weekday(day) + 1)


def two_digit_month(month: Column) -> Column:
    return F.lpad(month.cast("string"), 2, "0")
