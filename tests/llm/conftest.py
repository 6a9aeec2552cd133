"""Small frames with every awkward row the operators must handle."""

from __future__ import annotations

import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, id string, _file string, root int"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(words))


def documents():
    """Null, empty, blank, short, long, repeated and near rows; ties; null ids and sources."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    half = " ".join(words[:60]) + " " + prose(2, 60)
    texts = [
        (0, base, "a"), (1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, "one two", "b"), (5, "ONE two", "b"),
        (6, near, "c"), (7, half, "c"), (8, base.upper(), "a"), (9, prose(3, 20_000), "a"), (10, "É accent É", None),
        (10, "É accent É", None), (11, "a  b\u00a0c \r\n d", "c"), (None, "no id here", "a"), (12, "x" * 5000, "b"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), "clash", "f", 7) for i, t, s in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCUMENT)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)
