import random

import pytest

WORDS = "the of and to in that was for with from this are have not but they which one all".split()


@pytest.fixture(scope="session")
def frame(spark):
    """A table from rows of (doc_id, text, ...) with the columns named."""
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, odd white space, other scripts and a very long text."""
    rng = random.Random(5)
    long = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(40_000))
    return [(1, None), (2, ""), (3, "   "), (4, "\n\n\t"), (5, "one"), (6, "one"), (7, "One two"), (None, "no id here at all today"),
            (None, None), (8, "same id same text again and again"), (8, "same id same text again and again"),
            (8, "another text of that id, not the same one"), (9, "a  b   c\n d \n e f  "), (10, "naïve Straße 東京 مرحبا 🙂 ok"),
            (11, " lead and trail "), (12, "don't we'll <|endoftext|> it's 'tis"), (13, long), (14, long + " x"),
            (15, "1234 5678 !!! ???"), (16, "x" * 5000), (17, "a\r\nb\r\nc d e f g h"), (18, "é café ́ z")]


@pytest.fixture(scope="session")
def some_texts():
    rng = random.Random(11)

    def text(n):
        return " ".join("".join(rng.choices("etaoinsr", k=rng.randint(2, 7))) if rng.random() < 0.6 else rng.choice(WORDS)
                        for _ in range(n))

    base = [text(rng.randint(5, 120)) for _ in range(60)]
    out = list(base)
    for _ in range(80):  # copies and near copies of all degrees
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
            words[rng.randrange(len(words))] = text(1)
        out.append(" ".join(words))
    return [(i, t) for i, t in enumerate(out)]
