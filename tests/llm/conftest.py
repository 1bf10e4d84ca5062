import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, a null id, and columns whose names the operators might use."""
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "word"), (6, "x" * 20_000), (7, "long text " * 5_000), (8, "a b c d e f g h i j"), (None, "no id here"), (9, "\u0000\u0001 \U0001f600 café <|im_end|>"),
    ]
    return make(spark, [(i, t, "en", None if i == 4 else "s", len(t or ""), "c", 1.5, 7) for i, t in rows], f"{SCHEMA}, copy string, score double, component_id int")


@pytest.fixture(scope="session")
def empty(spark):
    return make(spark, [], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    r = random.Random(0)
    return make(spark, [(i, r.randint(0, 1), r.randint(0, 1)) for i in range(1, 10)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def corpus(spark):
    """Clean, toxic and poor documents with labels: (documents, labels)."""
    r = random.Random(1)
    plain = ["river", "stone", "garden", "paper", "window", "music", "winter", "forest", "bread", "market", "letter", "harbor", "season", "valley", "copper", "silver"]

    def prose(n):
        return ". ".join(" ".join(f"{r.choice(plain)}{r.choice(plain)[:2]}" for _ in range(9)) for _ in range(n // 9)) + "."

    docs, marks = [], []
    for i in range(600):
        text, toxic, quality = prose(r.randint(60, 160)), 0, 1
        if i % 6 == 1:
            words = text.split()
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["idiot", "you moron", "stupid", "trash"]))
            text, toxic = " ".join(words), 1
        if i % 6 == 2:
            text, quality = " ".join(w + r.choice(["###", "$$$", "%%%"]) for w in text.split()), 0
        docs.append((i, text, "en", f"src{0 if i % 3 else i % 7}", len(text)))
        marks.append((i, quality, toxic))
    return make(spark, docs, SCHEMA), make(spark, marks, "doc_id long, quality int, toxic int")
