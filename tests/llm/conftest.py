import pytest

DOCS = "doc_id bigint, text string, source string, k1 string, score string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like the operators' own."""
    long = " ".join(f"word{i % 977} the of{i % 13}" for i in range(60_000))
    rows = [
        (1, "The cat of the house\nshared line here\nthe end", "a", "x", "y"),
        (2, "The cat of the house\nshared line here\nthe end", "b", "x", None),
        (2, "The cat of the house\nshared line here\nthe end", "b", "x", None),
        (3, None, "c", None, None), (4, "", None, None, "z"), (None, "nobody's text\nshared line here", "c", None, None),
        (None, None, None, None, None), (5, long, "d", "x", "x"), (6, "  shared line here\t\nÀÉ ñ 日本 😀 <|endoftext|>", "d", None, None),
        (7, "shared line here\nshared line here\n\n", "e", None, None), (8, "\n\n", "f", None, None), (9, "one", "g", None, None),
        (10, "one\x1ftwo\xa0three\x85four", "h", None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
