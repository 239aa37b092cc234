import pytest

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASHES = "row string, size string, target string, score string, spans string, words string, component string, u string, start string, pass string, finish string, sets string"
N_CLASHES = len(CLASHES.split(", "))
LONG = " ".join(f"word{i % 9000} of" for i in range(60_000))


def document(doc_id, text, source="s"):
    return (doc_id, text, "en", source, None if text is None else len(text), *["x"] * N_CLASHES)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    same = document(7, "one two three four five six seven eight nine ten eleven twelve")
    rows = [
        document(1, ""), document(2, None), document(3, LONG), same, same,
        document(8, same[1]), document(9, "ONE two three four five six seven eight nine ten eleven twelve", None),
        document(10, "   \n\t "), document(11, "single", "\U0001d4aa"), document(None, "a text without an id at all", "t"),
        document(7, "another text under an id that is there already", "t"), (None,) * (5 + N_CLASHES),
        document(12, "password = 'abcdEFGH12345678' and more\nyou stupid idiot!!", "t"),
    ]
    return spark.createDataFrame(rows, f"{DOCUMENTS}, {CLASHES}").repartition(3)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
