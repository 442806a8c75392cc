import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, frame, sentence
from tradeloom.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def by_force(rows):
    first = {}
    words = [(LAST if i is None else i, WORD.findall(t or "")) for i, t, _, _ in rows]
    for i, w in words:
        for p in range(len(w) - 49):
            key = tuple(w[p : p + 50])
            first[key] = min(first.get(key, LAST), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        out.append((None if i == LAST else i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, repeats.without_repeats(df).collect()), key=repr)


def passages(seed):
    """Documents that share passages of all lengths, with runs of one word and few different words."""
    rng = random.Random(seed)
    pool = [sentence(rng, rng.choice([20, 49, 50, 51, 70, 120]), 6) for _ in range(8)]
    pool += ["a " * 60, "a " * 45 + "b " * 45, "a b " * 40, "b " * 30 + "a " * 25]
    rows = []
    for i in range(40):
        parts = [rng.choice(pool) if rng.random() < 0.6 else sentence(rng, rng.randrange(60), 5) for _ in range(rng.randrange(1, 5))]
        rows.append((rng.randrange(60), "\n".join(parts), "en", "a"))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_against_every_window(spark, seed):
    rows = passages(seed)
    assert found(frame(spark, rows).repartition(5)) == by_force(rows)


def test_odd_rows(odd):
    assert found(odd) == by_force(ODD)


def test_nothing(nothing):
    assert found(nothing) == []


def test_copies_of_a_hot_text(spark):
    text = sentence(random.Random(3), 200)
    rows = [(i, text if i % 3 else text + f" own{i}", "en", "a") for i in range(60)]
    assert found(frame(spark, rows)) == by_force(rows)


def test_window_of_exactly_fifty_words_across_slices(spark, monkeypatch):
    shared = sentence(random.Random(5), 50)
    rows = [(i, f"{sentence(random.Random(100 + i), 30)} {shared} {sentence(random.Random(200 + i), 30)}", "en", "a") for i in range(5)]
    got = found(frame(spark, rows))
    assert got == by_force(rows)
    assert [r[2] for r in got] == [0, 50, 50, 50, 50]


def test_digest_of_the_query(spark):
    from tradeloom.llm.queries import QUERIES

    out = QUERIES["op5_repeated_passages"](spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.col("text")).collect()}
    want = {i: k for i, _, _, k in by_force([(i, t, "", "") for i, t in docs.items()])}
    assert {r.doc_id: r.kept_sha256 for r in out.collect()} == {i: hashlib.sha256(k.encode()).hexdigest() for i, k in want.items()}


def test_swapped_sequences_are_not_repeats(spark):
    """Words of 1,024 characters and runs of 512 words whose swaps sums of powers modulo 2^64 confuse."""
    swap = lambda n, a, b: [b if i.bit_count() % 2 else a for i in range(n)]
    tail = sentence(random.Random(2), 49)
    rows = [(1, "".join(swap(1024, "a", "b")) + " " + tail, "en", "a"), (2, "".join(swap(1024, "b", "a")) + " " + tail, "en", "a")]
    rows += [(3, " ".join(swap(600, "x", "y")), "en", "a"), (4, " ".join(swap(600, "y", "x")), "en", "a")]
    got = found(frame(spark, rows))
    assert got == by_force(rows) and got[1][2] == 0
