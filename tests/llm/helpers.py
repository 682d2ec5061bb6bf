"""Small tables and brute-force versions for the corpus operators' tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(n))


def docs(spark, texts, schema=DOCS):
    """Documents 0, 1, ... from texts, or from (doc_id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], schema)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


ODD_TEXTS = [None, "", " \t\n", "x", "A.", "\n\n", "word", "  two  words ", "é" * 50, "日本語 テスト", "a" * 5000, prose(1, 30000)]
