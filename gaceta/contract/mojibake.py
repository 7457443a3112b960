"""Texts spoiled on purpose, the same way in Spark and SQL, to test the repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks first: spoiled letters may hold them.
SPOILED = "¡¿áéíóúüñàèêçäößÁÉÍÓÚÜÑÀÈÊÇÄÖ"


# What is tidied besides in a text that needs repair, and how it ends up.
UNTIDY = "‘a’ “b”\r\nc\u2028d\x85e ＡＢ１！\u3000f\x01g\x0bh\x7fi\ufeffj"
TIDY = "'a' \"b\"\nc\nd\ne AB1! fghij"


def misread(text: str) -> str:
    """UTF-8 bytes shown one by one, in Windows-1252 where it has a character."""
    return "".join(
        bytes([b]).decode("cp1252", "ignore") or chr(b) for b in text.encode("utf-8"))


PAIRS = [(c, misread(c)) for c in SPOILED]
DOUBLE = [(c, misread(misread(c))) for c in SPOILED]
REPAIRS = [(misread(chr(c)), chr(c)) for c in [*range(0xA0, 0x180), 0x81, 0x8D, 0x8F, 0x90, 0x9D]]


def spoil(text: Column, doc: Column) -> Column:
    """Every third document is spoiled twice over, every third not at all."""
    once = twice = text
    for good, bad in PAIRS:
        once = F.replace(once, F.lit(good), F.lit(bad))
    for good, bad in DOUBLE:
        twice = F.replace(twice, F.lit(good), F.lit(bad))
    return F.when(doc % 3 == 0, twice).when(doc % 3 == 1, once).otherwise(text)


def _replace_sql(text: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        text = f"replace({text}, '{old}', '{new}')"
    return text


def spoiled_sql() -> str:
    return (f"case doc_id % 3 when 0 then {_replace_sql('text', DOUBLE)} "
            f"when 1 then {_replace_sql('text', PAIRS)} else text end")


def repaired_sql(column: str) -> str:
    """Two rounds of plain replacements, for the letters ``spoil`` uses."""
    used = [p for p in REPAIRS if p[1] in SPOILED + "ÃÂ" or ord(p[1]) < 0xC0]
    punctuation = [(misread(c), c) for c in bytes(range(0x80, 0xA0)).decode("cp1252", "ignore")]
    once = _replace_sql(column, used + punctuation)
    return _replace_sql(once, used)
