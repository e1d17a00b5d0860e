import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, more: str = "", values: tuple = ()):
    """documents rows from (doc_id, text) or longer tuples; ``more`` adds columns."""
    full = []
    for r in rows:
        r = (*r, *(None,) * (4 - len(r)))
        full.append((r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1]), *values))
    return spark.createDataFrame(full, COLUMNS + more)


@pytest.fixture(scope="session")
def small_docs():
    return duckdb.sql(f"select doc_id, text, lang, source from '{SF_SMALL}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def edge_docs(small_docs):
    """Real rows with null, empty, very long, repeated and tied ones among them."""
    long = " ".join(t for _, t, _, _ in small_docs[:60])
    return [*small_docs, (1000, None, "en", None), (1001, "", "en", "s"), (1002, " \n\t ", None, "s"),
            (1003, long * 3, "en", "s"), (1004, "one two", "en", "s"), (1005, "one two", "en", "s"),
            (None, "a null id but a text", "en", "s"), small_docs[0], small_docs[0],
            (1006, "x" * 5000, "en", "s"), (1007, "ab " * 3000, "en", "s"), (1008, small_docs[3][1], "fr", None)]
