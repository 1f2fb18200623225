import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} thing{i % 31}" for i in range(9000))
SCHEMA = "doc_id long, text string, id long, th string, h int, g string, n string, lang string, kind string, label string, _id string"


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, LONG), (5, LONG), (6, "one two three four five six seven eight nine ten eleven"),
        (7, "One two three four five six seven eight nine ten eleven"), (8, "é🎉 ▁ naïve\x00 Ünï"), (8, "another text of the same name"), (None, "a text without a name"),
        (None, None), (9, "x" * 5000),
    ]
    return spark.createDataFrame([(i, t, 1, "t", 2, "g", None, "en", "k", None, "i") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
