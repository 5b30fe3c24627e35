import pytest

SF_DIR = "/root/testdata/sf0.001"

# Nulls, empty and long texts, repeated rows and ties, with a column of a clashing name.
ODD = [
    (1, "", "a"),
    (2, None, "a"),
    (3, " \t\n ", None),
    (4, "One two three", "b"),
    (5, "one TWO three", "b"),
    (5, "one TWO three", "b"),
    (None, "One two  three", "b"),
    (None, None, None),
    (7, "word " * 30_000, "a"),
    (8, "x" * 70_000, "c"),
    (9, "éß 漢字 \U0001f600 A'll don't 12345 !!!\n\nA'll", "c"),
    (10, "The MIT License, the mit-license; CC BY and Apache  License, Version 2.0", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(key, text, source, 0, "z") for key, text, source in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, shard string").repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
