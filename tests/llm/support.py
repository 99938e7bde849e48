"""Small tables and plain versions that operators are held against."""

from __future__ import annotations

import random

WORDS = "the of and to in alpha beta gamma delta omega stone river cloud green seven north light paper".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward(spark, rows=()):
    """Nulls in any column, empty and very long texts, ties, a repeated row, and clashing extra columns."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    data = [
        (1, None, None, None, 1, 5.0, "x"),
        (2, "", "en", "s", 2, 5.0, "x"),
        (3, " \n\t ", "en", "s", 2, None, None),
        (4, long, "de", None, 2, 1.0, "y"),
        (5, "one two", None, "s", 3, 1.0, "y"),
        (6, "one two", "en", "s", 3, 1.0, "y"),
        (7, "same row here with words", "en", "s", None, 0.0, "z"),
        (7, "same row here with words", "en", "s", None, 0.0, "z"),
        (None, "no identifier at all", "en", "s", 9, 0.0, "z"),
        *rows,
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, words string"
    return spark.createDataFrame(data, schema)


def empty(spark):
    return awkward(spark).limit(0)


class Union:
    """Smallest member of linked sets."""

    def __init__(self, members):
        self.parent = {m: m for m in members}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
