"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

KIND = "doc_id long, text string, lang string, source string, n_chars long, score double, _id string, n_tokens int, _text string"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def awkward(spark):
    """Null and empty texts, null keys, a very long text, repeated rows, ties, clashing columns."""
    long_text = prose(1, 40_000, 5_000)
    texts = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n\x0b\x0c\r ", None),
        (4, long_text, "b"),
        (5, long_text + " ", "b"),
        (6, "same text here", None),
        (6, "same text here", None),
        (6, "another text under the same id", "c"),
        (None, "no id", "a"),
        (None, None, None),
        (7, "Licensed under the Apache License, Version 2.0.", "a"),
        (8, "x" * 5_000 + "é日本" * 300, "c"),
        (9, "same  text here", "a"),
    ]
    rows = [(i, t, None, s, None if t is None else len(t), 0.5, "clash", 3, "clash") for i, t, s in texts]
    return spark.createDataFrame(rows, KIND)


def empty(spark):
    return spark.createDataFrame([], KIND)


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
