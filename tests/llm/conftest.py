import pytest

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _long(words):
    return " ".join(f"w{i % 997}x{i % 31}" for i in range(words))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties and
    repeated rows."""
    return [
        (1, "One two three four five. Six seven.", "en", "a", 35),
        (1, "One two three four five. Six seven.", "en", "a", 35),   # repeated row
        (2, "One two three four five. Six seven.", "en", "b", 35),   # copy
        (3, None, "en", "a", None), (4, "", "de", None, 0), (5, " \n\t ", None, "a", 4),
        (None, "text without an id", "fr", "c", 18), (None, None, None, None, None),
        (6, "é ü 漢字 😀   x", "xx", "", 9), (7, _long(60_000), "en", "a", 1),
        (8, "word " * 5000, "en", "b", 2), (9, "a", "en", "b", 1), (9, "b", "en", "b", 1),  # one id, two texts
        (10, "x" * 300_000, "en", "c", 3),
    ]


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return spark.createDataFrame(edge_rows, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/labels.parquet")


@pytest.fixture(scope="session")
def clashing(edges):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = ("hash", "row", "size", "gone", "spans", "score", "copies", "bucket", "n", "id", "content", "rest", "node",
             "key", "of", "uid", "n_sentences", "kept", "target")
    return edges.withColumns({n: F.lit(7) for n in names})
