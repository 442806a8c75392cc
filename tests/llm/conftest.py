from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy string, row string, fp int, _id int, size string, shard string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    full = [(i, t, g, s, len(t or ""), "c", "r", 1, 2, "s", "x") for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, " \t\n ", "en", None),
    (4, "one", "en", "b"),
    (4, "one", "en", "b"),
    (5, "one", "de", "b"),
    (None, "no id at all", None, None),
    (None, None, None, None),
    (6, "x " * 30_000, "en", "a"),
    (7, sentence(random.Random(1), 300), "en", "a"),
    (8, sentence(random.Random(1), 300), "en", "b"),
    (9, "Ünïcödé 漢字 🙂   end", "de", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
