"""A small hostile table: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest

WORDS = [f"w{k}" for k in range(60)] + ["Über", "naïve", "日本語", "x!", "--", "MIT", "license", "%%%"]


def random_text(rng: random.Random, words: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "\n", "\t ", "  "]) for _ in range(words))


def hostile_rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(k, random_text(rng, rng.randint(1, 120)), rng.choice(["a", "b", "é", None])) for k in range(60)]
    base = random_text(rng, 200)
    for k in range(60, 75):  # near copies
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"new{k}"
        rows.append((k, " ".join(words), "a"))
    rows += [(k, base, "hot") for k in range(75, 95)]  # exact copies
    rows += [(95, None, "a"), (96, "", "b"), (97, " \n\t", None), (98, "one two", "a"), (99, "ONE two", "b")]
    rows += [(100, "long " * 5000, "long"), (101, "line of text here\n" * 50, "long")]
    rows += [(None, "no id at all but some words", "a"), (None, base, None), (7, rows[7][1], rows[7][2])]
    rng.shuffle(rows)
    return rows


SCHEMA = (
    "doc_id long, text string, source string, size int, rest string, kept int, n_lines int, shard int, "
    "copies int, _copies int, node int, rank int, body int, `a.b` int"
)


@pytest.fixture(scope="session")
def hostile(spark):
    """Clashing columns beside ``doc_id, text, source``."""
    return spark.createDataFrame([(*row, 1, "r", *[k for k in range(9)]) for row in hostile_rows()], SCHEMA)


@pytest.fixture(scope="session")
def empty(hostile):
    return hostile.limit(0)
