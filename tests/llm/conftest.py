import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(11)
    stems = "ta re mi so lu ne ka po vi da".split()
    return ["".join(rng.choices(stems, k=rng.randrange(1, 4))) for _ in range(3000)]


@pytest.fixture(scope="session")
def odd_docs(spark, words):
    """Nulls in every column, empty, blank, short and very long texts, copies, repeated rows, and clashing extra columns."""
    long_text = " ".join(words * 8)
    rows = [
        (1, " ".join(words[:120]), "en", "a", 1), (2, " ".join(words[:120]), None, None, None), (3, None, "en", "a", 0), (4, "", "en", "b", 0),
        (5, " \n\t ", "en", "b", 3), (6, "one two", "en", "b", 7), (7, "one two", "de", "c", 7), (8, long_text, "en", "a", len(long_text)),
        (9, " ".join(words[200:400]) + ".\n" + " ".join(words[:60]), "en", "a", 5), (10, "ONE Two", "en", "c", 7), (10, "ONE Two", "en", "c", 7),
        (None, " ".join(words[500:700]), "en", "d", 9), (11, " ".join([*words[:119], "changed"]), "en", "e", 2),
    ]
    extra = "text2 string, score double, component_id long, size int, bin int, key string, node long, head long"
    return spark.createDataFrame([(*r, "x", 0.5, 1, 2, 3, "k", 4, 5) for r in rows], f"{DOCS}, {extra}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
