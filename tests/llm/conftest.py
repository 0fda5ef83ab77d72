import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, node string, seed int"


def texts_with_repeats(n=60, seed=3):
    """Random texts; some are copies, some near copies, some share a passage."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("the", "on", "er", "ré", "ti") for b in ("", "nd", "ing", "ou", "ß", "an", "st")]
    passage = " ".join(rng.choices(words, k=70))
    out = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.choice((0, 1, 3, 30, 120, 300))))
        if i % 7 == 3:
            text = f"{text} {passage} {' '.join(rng.choices(words, k=20))}"
        if i % 11 == 5 and out:
            text = rng.choice(out)
        if i % 13 == 6:
            parts = rng.choice(out).split(" ")
            if parts:
                parts[rng.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        out.append(text)
    return out


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with nulls, empty and equal texts, repeated rows and columns of the operators' own names."""
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t), "x", "y", 1) for i, t in enumerate(texts_with_repeats())]
    rows += [(900, None, None, None, None, None, None, None), (901, "", "en", "s", 0, "x", "y", 1), rows[10], rows[10], (None, rows[10][1], "en", "s", 1, "x", "y", 1), (902, "!!! 123  ", "en", "s", 1, "x", "y", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
