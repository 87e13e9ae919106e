from __future__ import annotations

import random

import pytest

WORDS = [f"w{k}" for k in range(300)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables to a folder that queries can read."""

    def write(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_docs():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = prose(1, 60_000)
    return [(1, None, "en", None, None), (2, "", None, "s", 0), (3, long, "en", "s", 1), (4, "One two THREE", "en", "s", 13), (4, "One two THREE", "en", "s", 13), (None, "no id here", "en", "s", 10), (5, " \t\n", "en", "s", 3), (6, "x" * 100_000, "en", "s", 9), (7, "é日本 \x00 ok", "fr", "s", 9)]
