import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import ODD, frame, sentence
from tradeloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Share out by weight; whoever is above the cap stops there, until none is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            out.update({s: level * w[s] for s in open_})
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def documents(seed, n=400):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "é", None]
    return [(i, sentence(rng, int(rng.paretovariate(0.7)) % 400), "en", rng.choice(names[:1] * 4 + names)) for i in range(n)]


@pytest.mark.parametrize("seed, bucket_rows, fan_in", [(0, 10_000, 256), (1, 7, 3), (2, 1, 2)])
def test_totals_meet_the_targets(spark, seed, bucket_rows, fan_in):
    rows = documents(seed)
    plan = mixing.copies(frame(spark, rows), bucket_rows=bucket_rows, fan_in=fan_in).collect()
    assert len(plan) == len(rows)
    source = {i: s for i, _, _, s in rows}
    sizes = Counter()
    for i, t, _, s in rows:
        sizes[s] += len(WORD.findall(t))
    want = targets(sizes)
    taken, closing = Counter(), Counter()
    for r in plan:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        words = r.copies * r["size"] + r.part
        assert 0 <= words <= 2 * r["size"] and (r.part == 0 or r.part < r["size"] + 1)
        taken[s] += words
        closing[s] += r.part > 0
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert max(closing.values()) <= 1


def test_reruns_and_partitions_agree(spark):
    rows = documents(3)
    one = mixing.copies(frame(spark, rows), bucket_rows=10, fan_in=4)
    two = mixing.copies(frame(spark, rows[::-1]).repartition(7), bucket_rows=10, fan_in=4)
    key = lambda df: sorted((r.doc_id, r.copies, r.part) for r in df.collect())
    assert key(one) == key(two)


def test_equal_rows_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_COPIES", 7)
    rows = [(1, "a b c", "en", "a")] * 50 + [(2, "d e", "en", "a")] * 7 + [(3, "f", "en", "b")]
    numbered = mixing._numbered(frame(spark, rows).select("doc_id", "text").repartition(5)).collect()
    assert sorted((r.doc_id, r.nth) for r in numbered) == [(1, i) for i in range(50)] + [(2, i) for i in range(7)] + [(3, 0)]
    one = mixing.copies(frame(spark, rows), bucket_rows=5, fan_in=2)
    two = mixing.copies(frame(spark, rows[::-1]).repartition(7), bucket_rows=5, fan_in=2)
    key = lambda df: sorted((r.doc_id, r.copies, r.part) for r in df.collect())
    assert len(one.collect()) == 58 and key(one) == key(two)


def test_every_document_is_taken_as_often_as_wanted():
    """Over many draws the mean of the settled fractions is the fraction."""
    rng = np.random.default_rng(5)
    size, p = rng.integers(1, 50, 30).astype(float), rng.random(30)
    total = np.zeros(30)
    for _ in range(4000):
        settled, held = mixing.settle(size, p, rng.random(30))
        assert abs((settled * size).sum() - (p * size).sum()) < 1e-6
        assert sum(0 < x < 1 for x in settled) == (held >= 0)
        total += settled
    assert np.abs(total / 4000 - p).max() < 0.05


def test_odd_rows(odd):
    plan = mixing.copies(odd).collect()
    assert len(plan) == len(ODD)
    assert sorted(r["size"] for r in plan) == sorted(len(WORD.findall(t or "")) for _, t, _, _ in ODD)
    assert all(r.copies == 0 and r.part == 0 for r in plan if not r["size"])
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    allowed = defaultdict(int)
    for i, t, _, _ in ODD:
        allowed[(i, t)] += 2
    assert all(n <= allowed[k] for k, n in Counter((r.doc_id, r.text) for r in out.collect()).items())


def test_nothing(nothing):
    assert mixing.copies(nothing).collect() == []
    assert mixing.mixed(nothing).collect() == []
