import pytest

SF = "/root/testdata/sf0.001"
#: Texts that every operator has to stand: null, empty, blank, one word, very long, repeated, non-ASCII.
ODD = [None, "", "   ", "one", "two words", "a b c", "É " * 30 + "ß😀 日本語", "w " * 5000, "x" * 20000, "\n\n\t\n", "same text here", "same text here",
       "▁ marker ▁", "line\r\nline\r\nline"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts (ids from 0), with extra columns whose names clash with the operators' own."""
    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "src", k, "mine", 1.5) for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tkey string, score double")

    return make
