import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Text_Hash long, row_ string, found string"


@pytest.fixture
def make(spark):
    """Documents with columns whose names the operators might use themselves."""

    def documents(texts, ids=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = ["en"] * len(texts) if langs is None else langs
        rows = [(i, t, k, "s", len(t or ""), 7, "r", "f") for i, t, k in zip(ids, texts, langs)]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return documents


WORDS = [a + b for a in ("ta", "ke", "mo", "ri", "su", "la", "vo", "ni") for b in ("ber", "lon", "mi", "dak", "ster", "pu", "gan", "shi", "f")]


@pytest.fixture
def prose():
    import random

    def text(n, seed):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", ",", "."]) for _ in range(n))

    return text
