import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "row string, spans string, count string, w string")


def prose(seed, words):
    pick = random.Random(seed)
    parts = ["an", "be", "co", "de", "el", "fi", "go", "hu", "it", "jo", "ka", "lu", "é", "ñas"]
    return " ".join("".join(pick.choice(parts) for _ in range(pick.randint(1, 4)))
                    for _ in range(words))


@pytest.fixture(scope="session")
def documents(spark):
    """``documents(texts or (doc_id, text) pairs)``: a table with clashing extra columns."""
    def make(*rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [(d, t, "en", "s1", len(t or ""), "x", "x", "x", "x") for d, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def odd_documents(documents):
    """Nulls, empty texts, repeated rows, ties, a very long text, non-ASCII."""
    shared = prose(1, 150)
    return documents(
        (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "Two words"), (None, shared), (None, None),
        (5, prose(2, 80) + " " + shared), (6, shared + " " + prose(3, 90)),
        (7, prose(4, 300)), (7, prose(4, 300)), (8, prose(4, 300)), (9, prose(4, 299) + " xyz"),
        (10, prose(5, 40_000)), (11, "é" * 900), (12, "ab" * 700), (13, "  two  spaces \r\n x "),
        (14, "IDIOT " * 30 + prose(6, 50)), (15, "<|endoftext|> 😀 it's"))
