import random

import pytest

WORDS = "the motion court plaintiff defendant hearing order granted denied evidence party filed calendar notice counsel".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows, and columns whose names operators use inside."""
    shared, long = prose(1, 60), prose(2, 30_000)
    rows = [
        (1, prose(10, 80) + "\n" + shared + "\n" + prose(11, 80), "en", "s0"),
        (2, prose(12, 80) + "\n" + shared + "\n" + prose(13, 80), "en", "s0"),
        (3, prose(14, 200), "fr", None),
        (4, prose(14, 200), None, "s1"),
        (5, None, "en", "s0"),
        (6, "", "en", "s0"),
        (7, "   \n\t ", "en", "s1"),
        (8, long, "de", "s0"),
        (9, "a.b@c.de +1 (229) 555-4838, 4046195599780836; 10.0.0.1 ▁ 😀 \x00", "en", "s0"),
        (None, prose(15, 70), "en", "s0"),
        (10, "line one\nline two\nline three\n\nown line", "en", "s0"),
        (11, "other\nline one\nline two \nline three\nline four", "en", "s0"),
        (12, prose(16, 90), "en", "s0"),
        (12, prose(16, 90), "en", "s0"),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ("rid", "p", "starts", "topic", "tokens", "score", "ids", "fp", "component_id", "chosen", "removed", "n_lines", "label", "media", "start", "part")
    return df.select("*", *(df["lang"].alias(c) for c in clashing)).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 13)] + [(None, 1, 1), (3, None, None), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
