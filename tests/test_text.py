import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaceta.functions import text
from gaceta.params import STOP_WORDS, TokenParams


def fold_in_python(s):
    plain = unicodedata.normalize("NFD", s.lower())
    return plain.encode("ascii", "ignore").decode()


def tokens_in_python(s):
    found = re.findall("[a-záéíóúüñ]{3,}", s, re.IGNORECASE)
    return [w for w in (f.lower() for f in found) if w not in STOP_WORDS]


def test_fold(evaluate):
    cases = {
        "Región de Los Ríos y o’higgins": "region de los rios y ohiggins",
        "ÑUBLE Ünï": "nuble uni",
        "": "",
        None: "",
    }
    assert evaluate(cases, lambda c: text.fold(F.col(c))) == list(cases.values())


def test_fold_agrees_on_every_basic_character(evaluate):
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    lines = ["x".join(chars[i:i + 64]) for i in range(0, len(chars), 64)]
    got = evaluate(lines, lambda c: text.fold(F.col(c)))
    # Unicode tables differ in age between the two runtimes: compare what each calls lower.
    different = [
        (a, b) for a, b in zip(map(fold_in_python, lines), got) if a != b
    ]
    assert different == []


def test_word_count(evaluate):
    cases = {
        "": 0, "  x  ": 1, "uno dos　tres\x1ccuatro\x85cinco": 5, None: 0,
        "a\tb\nc": 3, " ": 0,
    }
    assert evaluate(cases, lambda c: text.word_count(F.col(c))) == list(cases.values())


def test_ascii_texts_are_folded_without_a_lookup_per_character(spark):
    df = spark.createDataFrame([("El niño",), ("ASCII text",), (None,)], "x string")
    folded = df.select(text.fold(F.col("x")).alias("y"))
    assert [r["y"] for r in folded.collect()] == ["el nino", "ascii text", ""]
    assert "CASE WHEN RLIKE" in folded._jdf.queryExecution().optimizedPlan().toString()


def test_characters_are_searched_only_where_their_first_byte_is(evaluate):
    cases = {"豩": "á", "資 x": "資 x", "a谷b豩": "aübá", "è谷": "èü", "é Â¿": "é ¿", "ÃÂ": "ÃÂ", "plain": "plain"}
    assert evaluate(cases, lambda c: text.repair(F.col(c))) == list(cases.values())
    assert evaluate(["豩 è", "èé", "資"], lambda c: text._shows(F.col(c), text.REPAIR_SIGNS)) == [True, False, False]
    assert evaluate(["x"], lambda c: text._shows(F.col(c), text.REPAIR_SIGNS))[0] is False


def test_tokens(evaluate):
    cases = {
        "ÁRBOL Ñuñoa niño": ["árbol", "ñuñoa", "niño"],
        "snake_case word1two año2023mes": ["snake", "case", "word", "two", "mes"],
        "ÀÇÈß": [],
        "al de yo": [],
        "": [],
        None: [],
        "İstanbul İstanbul": ["i̇stanbul", "stanbul"],
        "Kelvin maſa": ["kelvin", "maſa"],
    }
    assert evaluate(cases, lambda c: text.tokens(F.col(c))) == list(cases.values())


def test_tokens_with_own_parameters(evaluate):
    params = TokenParams(alphabet="a-z", min_length=2, stop_words=())
    assert evaluate(["al Año de"], lambda c: text.tokens(F.col(c), params)) == [["al", "de"]]


def test_repair(evaluate):
    cases = {
        "RegiÃ³n": "Región",
        "niÃƒÂ±o": "niño",
        "Â¿QuÃ©?": "¿Qué?",
        "art贸culo": "artóculo",
        "谷": "ü",
        "SÃO PAULO": "SÃO PAULO",
        "plain text": "plain text",
        "Ã\x81rbol y Ã“scar": "Árbol y Óscar",
        "diÃ³ 5â‚¬ â€“ bien": "dió 5€ – bien",
        "diÃ³ â€œcitaâ€\x9d": 'dió "cita"',
        "“cita”": "“cita”",
        "": "",
        None: "",
    }
    assert evaluate(cases, lambda c: text.repair(F.col(c))) == list(cases.values())


def test_texts_under_repair_are_tidied(evaluate):
    cases = {
        "Ã±‘’‚‛ʼ": "ñ" + "'" * 5, "Ã±“”„‟": "ñ" + '"' * 4,
        "Ã±\r\n\r\x85\u2028\u2029\n": "ñ" + "\n" * 6,
        "Ã±！～Ａｚ０\u3000": "ñ!~Az0 ", "Ã±\x00\x08\x0b\x0e\x1f\x7f\ufeff\u206a\ufff9x": "ñx",
        "Ã±\t\x0c": "ñ\t\x0c", "‘sin daño’\r\n": "‘sin daño’\r\n",
    }
    assert evaluate(cases, lambda c: text.repair(F.col(c))) == list(cases.values())


def test_repair_of_a_long_text(evaluate):
    good = "El niño comió ñandú en Ñuble. " * 20_000
    bad = good.encode().decode("cp1252", "replace").replace("�", "\x91")
    assert evaluate([bad, good], lambda c: F.md5(text.repair(F.col(c)))) == evaluate(
        [good, good], lambda c: F.md5(c))


alphabet = st.characters(min_codepoint=1, max_codepoint=0x24F)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet, max_size=40), min_size=40, max_size=60))
def test_text_functions_agree_with_python(evaluate, lines):
    assert evaluate(lines, lambda c: text.tokens(F.col(c))) == [tokens_in_python(s) for s in lines]
    assert evaluate(lines, lambda c: text.word_count(F.col(c))) == [len(s.split()) for s in lines]
    assert evaluate(lines, lambda c: text.fold(F.col(c))) == [fold_in_python(s) for s in lines]
