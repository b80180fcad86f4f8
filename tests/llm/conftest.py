import pytest

from tests.sessions import local_session

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty, very long and repeated texts, a repeated row and clashing extra columns."""
    long = " ".join(f"word{k % 977} and{k % 31}" for k in range(20_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 70),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "b", 70),
        (3, "", "en", "a", 0),
        (4, None, None, None, None),
        (None, "le chat et la souris sont dans la maison avec le chien", "fr", "a", 54),
        (6, long, "en", "c", len(long)),
        (6, long, "en", "c", len(long)),
        (7, "123 456 !!! 789", "en", "a", 15),
        (8, "password=abcdef123 and AKIA" + "A" * 16 + " tail " + "0f" * 14, "en", "a", 60),
        (9, "der Hund und die Katze sind in dem Haus mit der Maus", "de", "a", 52),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    extra = ("score", "bits", "row", "label", "key", "word", "ids_x", "count", "size", "shard_x")
    return frame.selectExpr("*", *[f"'x' AS {name}" for name in extra])


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
