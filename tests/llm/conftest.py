import pytest

SF = "/root/testdata/sf0.001"
LONG = "the word and a token " * 20_000


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, and extra
    columns named like the operators' own."""
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, LONG), (5, "the big cat sat"), (5, "the big cat sat"),
            (None, "the big cat sat"), (7, "é世🙂"), (8, None), (None, None)]
    names = ("doc_id long, text string, fp long, score double, spans string, part int, look int, node long, root long, "
             "kept_id long, row_key string, base_spans string, masked string")
    return spark.createDataFrame([(i, t, 1, 0.5, "x", 1, 1, 1, 1, 1, "k", "b", "m") for i, t in rows], names)
