import pytest

from gaceta.llm import queries
from tests.conftest import SF

SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return queries.table(spark, SF, "documents")


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, blank, long, repeated and tied rows; columns with operators' own names."""
    texts = [None, "", " \n\t", "palabra", "Uno dos TRES cuatro", "uno DOS tres cuatro",
             "El Ñandú corre. " * 4000, "x" * 20000, "ß  é", "a\nb\na\n\nb",
             "uno dos tres cuatro", "linea\x0bcon\x0cseparadores\r\nraros", "🙂 emoji", "!!! ??? 123"]
    rows = [(i, t, "es", "src0", len(t or ""), "k", 1, "g", True, 0.5, "h") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "uno dos tres cuatro", None, None, None, "k", 1, "g", True, 0.5, "h"),
             (None, None, None, None, None, "k", 1, "g", True, 0.5, "h")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, keep_id string,"
              " group_size int, gid string, kept boolean, score double, host string")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
