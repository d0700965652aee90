import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    def make(rows, extra=""):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    return make


#: NULLs in every column, empty and blank texts, a long text, repeated rows.
EDGE = [(1, "a b c d e f g", "s0"), (1, "a b c d e f g", "s0"), (2, None, None), (3, "", "s0"), (4, " \n\t ", "s1"), (None, "x y z", "s1"),
        (5, "Ünï cödé \U0001f600 text " * 3000, "s2"), (6, "A B C D E F G", "s0"), (None, None, None)]
