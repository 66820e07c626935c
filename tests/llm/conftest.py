import os

import pyarrow.parquet as pq
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs():
    """(doc_id, text) rows of the smallest test table."""
    t = pq.read_table(os.path.join(SMALL, "documents.parquet"), columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty and blank texts, a null id, repeated rows, ties and one very long text."""
    long = "\n".join(f"line number {i % 40} of a very long text, again and again" for i in range(20_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "Same words here for everyone to read"),
            (5, "Same words here for everyone to read"), (5, "Same words here for everyone to read"),
            (None, "Same words here for everyone to read"), (None, None), (6, long), (7, "é" * 300),
            (8, "single"), (9, "Σίσυφος ΣΑΣ \x1c odd \x85 spaces <|endoftext|> and marks é")]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns whose names clash with those of the operators."""
    rows = [(i, t, "x", 0.5, 1, "s") for i, t in edge_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double, "
                                       "n_lines int, component string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
