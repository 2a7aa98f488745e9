from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table of (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS).repartition(3)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, blanks, ties, repeated rows, long texts and words that never end."""
    rng = random.Random(7)
    long = " ".join(rng.choice(["so", "it", "goes", "on", "and", "x" * 9]) + str(rng.randrange(300)) for _ in range(30_000))
    return [
        (5, "one two three four five six"), (6, "one two three four five six"), (6, "one two three four five six"), (7, "one  two\tthree four five\nsix"),
        (8, None), (9, ""), (10, " \n\t "), (11, long), (12, long + " end"), (13, "word"), (13, "other words here"), (None, "word"), (None, None), (None, "a b c d e f g"),
        (14, "z" * 200_000), (15, "Ünïcödé ✓ 𝄞 text with odd spaces"), (-3, "one two three four five six seven"),
    ]


@pytest.fixture
def random_rows():
    """Documents built of few words, shared passages and edits of each other."""

    def make(seed, n=40, distinct=True):
        rng = random.Random(seed)
        vocabulary = ["the", "of", "a", "B", "b", "day", "night", "é", "x1"] + [f"w{i}" for i in range(60)]
        passages = [[rng.choice(vocabulary) for _ in range(rng.choice((3, 12, 45, 80)))] for _ in range(6)]
        rows, texts = [], []
        for i in range(n):
            if texts and rng.random() < 0.4:
                words = list(rng.choice(texts))
                for _ in range(rng.choice((0, 1, 1, 2, 5))):
                    if words:
                        at = rng.randrange(len(words))
                        words[at : at + rng.randrange(2)] = [rng.choice(vocabulary)] * rng.randrange(3)
            else:
                words = []
                for _ in range(rng.randrange(4)):
                    words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
            texts.append(words)
            gaps = [rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in words]
            rows.append((i * 3 if distinct else rng.randrange(n), "".join(w + g for w, g in zip(words, gaps, strict=True))))
        return rows

    return make
