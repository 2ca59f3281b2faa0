"""Small tables for the operator tests."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) as a documents table."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
             None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def vocabulary(rng: random.Random, n: int) -> list[str]:
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "vo", "si", "pe", "du"]
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, words: list[str], n: int) -> str:
    return " ".join(rng.choice(words) for _ in range(n))
