import pytest

ODD = [
    (1, None, "s0", 7, 7),
    (2, "", "s1", 7, 7),
    (3, " \n\t ", None, 7, 7),
    (4, "word", "s1", 7, 7),
    (5, "the cat sat on the mat and then the dog came in to see what the cat was doing there today", "s0", 7, 7),
    (6, "the cat sat on the mat and then the dog came in to see what the cat was doing there today", "s0", 7, 7),
    (6, "the cat sat on the mat and then the dog came in to see what the cat was doing there today", "s0", 7, 7),
    (7, "The Cat  sat\n \n on   the mat ", "s2", 7, 7),
    (8, "x" * 3000 + " " + "long word " * 3000, "s3", 7, 7),
    (9, "größe naïve 日本語 😀 !!! 12 34\r\nlast line", "s3", 7, 7),
    (None, "no id at all here but some words to read", "s4", 7, 7),
]
#: Extra columns with names that operators use.
SCHEMA = "doc_id long, text string, source string, size int, _row int"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """[(doc_id, text)] in ascending order."""
    return sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
