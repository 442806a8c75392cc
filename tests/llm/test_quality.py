import random

import numpy as np
import pyarrow as pa

from tests.llm.conftest import ODD, frame
from tradeloom.llm import quality


def test_em_finds_accuracies_and_posteriors():
    """Labellers of known accuracy over known classes, most of them silent half of the time."""
    rng = np.random.default_rng(0)
    n, bad = 20_000, rng.random(20_000) < 0.2
    right = [0.95, 0.8, 0.7, 0.9]
    pattern = np.zeros(n, dtype=np.int64)
    for i, a in enumerate(right):
        vote = np.where(rng.random(n) < a, bad, ~bad).astype(int) + 1
        pattern += np.where(rng.random(n) < 0.5, 0, vote) * 3**i
    values, counts = np.unique(pattern, return_counts=True)
    posterior, shares, prior = quality.estimate(values, counts.astype(float), 4)
    assert abs(prior - 0.2) < 0.03
    for i, a in enumerate(right):
        assert abs(shares[1, i, quality.REJECT] - a) < 0.05 and abs(shares[0, i, quality.KEEP] - a) < 0.05
    known = dict(zip(values.tolist(), posterior.tolist()))
    p = np.array([known[x] for x in pattern.tolist()])
    for low in (0.0, 0.4, 0.8):
        here = (p >= low) & (p < low + 0.2)
        assert here.sum() < 50 or abs(bad[here].mean() - p[here].mean()) < 0.08


WORDS = "the of and a thing other water house round small green walk under over light".split()


OTHER = "ein zwei drei haus baum wasser klein rund gehen unter licht ding weg".split()


def prose(rng, n=80, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(["", "", "er", "ly", "s"]) for _ in range(n)).capitalize() + "."


def corpus():
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(600):
        kind, text = i % 6, prose(rng)
        if kind == 1:
            text = " ".join([rng.choice(WORDS)] * 60)
        elif kind == 2:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 3:
            words = text.split()
            for w in ("stupid", "trash", "loser", "idiot"):
                words.insert(rng.randrange(len(words)), w)
            text = " ".join(words)
        elif kind == 5:
            text = prose(rng, words=OTHER)
        elif kind == 4:  # insults that only people know, in a language of which the lists know nothing
            words = prose(rng, words=OTHER).split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), "grobl" + rng.choice("aeiou") + rng.choice("klm"))
            text = " ".join(words)
        rows.append((i, text, "en", "s"))
        if i % 2 or kind == 4 and i % 12 == 4:
            labels.append((i, int(kind not in (1, 2)), int(kind in (3, 4))))
    return rows, labels


def test_rejects_junk_and_insults_and_keeps_the_rest(spark):
    rows, labels = corpus()
    docs = frame(spark, rows)
    people = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judged(docs, quality.train(docs, people)).collect()}
    kept = {k: sum(got[i].keep for i in range(600) if i % 6 == k) for k in range(6)}
    assert kept[0] == kept[5] == 100
    assert all(kept[k] <= 2 for k in (1, 2, 3, 4))
    left = quality.accepted(docs, people)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i in got if got[i].keep}


def test_works_without_labels(spark):
    rows, _ = corpus()
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in quality.judged(docs, quality.train(docs)).collect()}
    assert all(got[i].keep for i in range(600) if i % 6 in (0, 5))
    assert not any(got[i].keep for i in range(600) if i % 6 in (1, 2, 3))


def test_votes_of_plain_cases():
    texts = pa.array(["word " * 40, "ALL LOUD WORDS IN HERE NOW", "a | b | c | d | e", None, "you idiot moron"])
    junk, toxic = quality.votes(texts)
    j, t = quality.digits(junk, len(quality.JUNK)), quality.digits(toxic, len(quality.TOXIC))
    assert j[0, 0] == j[0, 1] == quality.REJECT and j[1, 2] == quality.REJECT and j[2, 5] == quality.REJECT
    assert not j[3].any() and not t[3].any() and t[4, 0] == quality.REJECT


def test_odd_rows(spark, odd):
    people = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 0, 1), (77, 0, 0), (6, None, None)], "doc_id bigint, quality int, toxic int")
    got = quality.judged(odd, quality.train(odd, people)).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(i) for i, *_ in ODD)
    assert all(0 <= r.junk <= 1 and 0 <= r.toxic <= 1 for r in got)
    assert not any(r.keep for r in got if r.doc_id in (1, 2, 3))


def test_nothing(spark, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.accepted(nothing, none).collect() == []
    assert quality.judged(nothing, quality.train(nothing)).collect() == []
