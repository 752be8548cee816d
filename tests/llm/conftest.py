"""Awkward documents that every operator has to take."""

import pytest

ODD = [
    (1, "The cat sat on the mat and looked at the dog.", "en", "s0", 45, "x"),
    (1, "The cat sat on the mat and looked at the dog.", "en", "s0", 45, "x"),  # a repeated row
    (2, None, None, None, None, None),
    (3, "", "en", "s0", 0, None),
    (4, "   \n\t ", "de", "s1", 6, "y"),
    (5, "1234 !!! 5678", "en", "s1", 13, "y"),
    (6, "\x01\x02\x1c odd \x00 signs  \U0001f600 ß Σς", "fr", "s1", 20, "z"),
    (7, "word " * 20_000, "en", "s2", 100_000, "z"),
    (8, "a" * 50_000, "en", "s2", 50_000, "z"),
    (None, "A text without an id.", "en", "s2", 21, "z"),
]
#: fp, length, votes and the like clash with names that operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string"


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("component_id", "length", "part", "score", "lang_pred", "n_tokens", "least", "key", "item_id", "found"):
        df = df.selectExpr("*", f"'keep' AS {name}")
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def prose():
    """Seeded sentences of invented words, a vocabulary for each language."""
    import random

    def make(language, n, seed):
        syllables = {"en": "th er on in an re ed nd ha", "de": "sch ein ung keit ver zu", "fr": "eau oui ment tre que", "es": "cion ado ar os ez"}[language].split()
        r = random.Random(f"{language}{seed}")
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(n))

    return make
