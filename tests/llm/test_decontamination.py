import math
import random
import re

import pytest

from tests.llm.conftest import ODD, frame, sentence
from tradeloom.llm import decontamination


def words_of(text):
    return [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]


def shingles(text, k):
    w = words_of(text)
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}


def by_force(docs, items):
    out = set()
    for i, t, _, _ in docs:
        own = {k: shingles(t, k) for k in range(1, 6)}
        for item, text in items:
            k = max(1, min(5, len(words_of(text))))
            q = shingles(text, k)
            n = len(q & own[k])
            if q and n >= math.ceil(0.8 * len(q) - 1e-9):
                out.add((i, item, len(q), n))
    return out


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_finds_what_counting_finds(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(2)
    items = [(k, sentence(rng, rng.choice([1, 2, 3, 4, 5, 6, 12, 40, 70]), 300)) for k in range(40)] + [(99, None), (98, "")]
    docs = []
    for i in range(120):
        text = sentence(rng, rng.choice([0, 3, 50, 2000]), 300)
        if rng.random() < 0.6:
            _, item = rng.choice(items[:40])
            words = item.split()
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = "changed"
            half = len(words) // 2
            text = " ".join([", ".join(words[:half]).upper(), text, *words]) if rng.random() < 0.5 else f"{text} {' '.join(words)}. {text}"
        docs.append((i, text, "en", "a"))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.item_shingles, r.found) for r in decontamination.contained_items(frame(spark, docs), table).collect()}
    want = by_force(docs, items)
    assert len(want) > 20 and got == want
    assert {len(words_of(dict(items)[item])) for _, item, *_ in want} >= {1, 5, 6, 12}


def test_items_of_one_to_six_words_inside_longer_texts(spark):
    words = "alpha beta gamma delta epsilon zeta".split()
    items = spark.createDataFrame([(n, " ".join(words[:n])) for n in range(1, 7)], "item_id bigint, text string")
    docs = [(i, f"x y z {' '.join(words[: i + 1])} u v w q", "en", "a") for i in range(6)] + [(10, "beta gamma", "en", "a"), (11, "gamma beta alpha", "en", "a")]
    got = {(r.doc_id, r.item_id) for r in decontamination.contained_items(frame(spark, docs), items).collect()}
    assert got == {(i, n) for i in range(6) for n in range(1, i + 2)} | {(11, 1)}


def test_odd_rows_and_clean_documents(spark, odd):
    items = [(1, None), (2, ""), (3, "One!"), (4, ODD[9][1][40:400]), (4, ODD[9][1][40:400]), (None, "no id, at all")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.contained_items(odd, table).collect()
    assert sorted(((r.doc_id, r.item_id) for r in rows), key=repr) == sorted([(4, 3), (5, 3), (7, 4), (8, 4), (None, None)], key=repr)
    clean = decontamination.clean_documents(odd, table)
    assert clean.columns == odd.columns
    assert sorted((repr(r.doc_id), repr(r.text)) for r in clean.collect()) == sorted(
        (repr(i), repr(t)) for i, t, _, _ in ODD if i not in (4, 5, 7, 8) and t != "no id at all"
    )


def test_nothing(spark, nothing, odd):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    assert decontamination.contained_items(nothing, some).collect() == []
    assert decontamination.contained_items(odd, none).collect() == []
    assert decontamination.clean_documents(odd, none).count() == len(ODD)


def test_sketch_is_the_smallest_hashes_by_size(spark):
    rows = decontamination.item_shingles(spark.createDataFrame([(1, sentence(random.Random(0), 34, 10**6))], "item_id bigint, text string")).collect()
    assert {(r.q, r.need, r.partition) for r in rows} == {(30, 24, 4)}
    small = sorted(r.h for r in rows)[:7]
    assert sorted(r.h for r in rows if r.sketch) == small
