import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD, frame, sentence
from tradeloom.llm import repeated_lines as lines

SPACE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aBÉ \t\n\r漢.", max_size=40)), max_size=6)


def key(line):
    return line.strip(SPACE).translate(FOLD)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_lines_and_keys(values):
    found = lines.find_lines(pa.array(values, pa.string()), least=3)
    want = [line for v in values for line in (v or "").split("\n")]
    assert np.diff(found.first).tolist() == [(v or "").count("\n") + 1 for v in values]
    assert found.keys(np.arange(len(want))) == [key(x) for x in want]
    assert found.judged.tolist() == [len(key(x)) >= 3 for x in want]


def by_force(rows):
    last = 2**63 - 1
    where = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                where.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, text, *_ in rows:
        own = (text or "").split("\n")
        gone = [len(where.get(key(x), ())) > 1 and min(where[key(x)]) < (last if i is None else i) for x in own]
        out.append((i, len(own), sum(gone), "\n".join(x for x, g in zip(own, gone) if not g)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(5)
    shared = [sentence(rng, n) for n in (1, 4, 9, 30)] + ["Exactly 10", "only nine", "ÉÉÉÉÉÉÉÉÉÉ", "éééééééééé"]
    rows = list(ODD)
    for i in range(20, 320):
        own = [sentence(rng, rng.randrange(1, 9)) for _ in range(rng.randrange(6))] + rng.sample(shared, rng.randrange(3))
        own += ["  THE LINE of a third of all documents\t\r"] * (i % 3 == 0) + own[:1] * (i % 5 == 0)
        rng.shuffle(own)
        rows.append((rng.choice([i, i, i, 40, None]), "\n".join(own), "en", "a"))
    rows.append((9_000, "\n".join([sentence(rng, 5) for _ in range(50_000)] + ["the line OF a third of all documents"]), "en", "a"))
    return rows + rows[30:60]


@pytest.mark.parametrize("most_bits", [lines.MOST_BITS, 64])
def test_kept_lines(spark, most_bits):
    """A filter of 64 bits is full, so that every line is compared; the result stays."""
    rows = corpus()
    got = lines.without_repeated_lines(frame(spark, rows).repartition(7), most_bits).collect()
    assert sorted([tuple(r) for r in got], key=repr) == by_force(rows)


def test_empty_table(spark, nothing):
    assert lines.without_repeated_lines(nothing).collect() == []


def test_second_filter_is_merged_over_tasks(spark, monkeypatch):
    rows = corpus()
    texts = lines._identified(frame(spark, rows).repartition(9)).cache()
    bits = 1 << 22
    segments = {r.segment: lines.zlib.compress(bytes(r.bits)) for r in lines.seen_twice(texts, bits).collect()}
    assert len(segments) == 4
    test = lines.Suspects(segments, bits)
    where = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                where.setdefault(line, set()).add(i)
    every = lines.find_lines(pa.array(list(where)))
    hit = test(every.hashes(np.arange(len(where))))
    keys = {}
    for line, ids in where.items():
        keys.setdefault(key(line), set()).update(ids)
    repeated = np.array([len(keys[key(line)]) > 1 for line in where])
    assert hit[repeated].all() and hit[~repeated].mean() < 0.01
