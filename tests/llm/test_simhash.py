import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.conftest import ODD, frame, sentence
from tradeloom.llm import simhash
from tradeloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, k=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(lower)
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, near):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def close(a, b):
    return (a ^ b).bit_count() <= 3


def family(rng, n):
    """Fingerprints around few centres, at distances on both sides of the radius."""
    out = set()
    for _ in range(n // 10):
        centre = rng.getrandbits(64)
        for _ in range(10):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
    return sorted(out)


def test_fingerprints_are_those_of_the_definition():
    rng = random.Random(0)
    texts = [t for _, t, _, _ in ODD] + [sentence(rng, rng.randrange(900), 50).upper() for _ in range(20)]
    assert simhash.text_fingerprints(pa.array(texts, pa.string())).tolist() == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_pivot_tables_lose_no_link_in_a_cell(seed):
    values = family(random.Random(seed), 600)
    first = simhash.near_within(np.array(values, dtype=np.uint64)[:, None])
    assert first.tolist() == groups(values, close)


@pytest.mark.parametrize("cell_rows", [4096, 4])
def test_links_connect_what_is_near(spark, cell_rows):
    values = family(random.Random(9), 300)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    got = {r.node: r.root for r in components(simhash.links(df, cell_rows=cell_rows)).collect()}
    order = sorted(range(len(values)), key=lambda i: signed[i])
    ranked = [values[i] for i in order]
    want = groups(ranked, close)
    assert [got.get(signed[i], signed[i]) for i in order] == [signed[order[g]] for g in want]


def test_odd_rows(odd):
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(odd).collect()), key=repr)
    values = [fingerprint(t) for _, t, _, _ in ODD]
    group = groups(values, close)
    ids = {g: min((i for (i, *_), h in zip(ODD, group) if h == g and i is not None), default=None) for g in group}
    assert got == sorted(((i, v, ids[g]) for (i, *_), v, g in zip(ODD, values, group)), key=repr)


def test_nothing(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.one_of_each(nothing).collect() == []


def similar(rng, text, changes):
    words = text.split()
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("cell_rows", [4096, 3])
def test_one_of_each_group_stays(spark, cell_rows):
    rng = random.Random(4)
    rows, base = [], [sentence(rng, 600, 5000) for _ in range(12)]
    for k, text in enumerate(base):
        rows.append((10 * k, text, "en", "a"))
        rows += [(10 * k + c, similar(rng, text, c), "en", "b") for c in range(1, 5)]
        rows += [(10 * k + 8, text.upper(), "en", "b"), (10 * k + 9, similar(rng, text, 120), "en", "b")]
    rows.sort()
    kept = simhash.one_of_each(frame(spark, rows).repartition(4), cell_rows=cell_rows)
    group = groups([fingerprint(t) for _, t, *_ in rows], close)
    want = sorted({rows[g][0] for g in group})
    assert sorted(r.doc_id for r in kept.collect()) == want and 24 <= len(want) < len(rows) - 24
    assert kept.columns == frame(spark, []).columns


def test_one_of_odd_rows(odd):
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(odd).collect()]
    assert len(kept) == len(set(kept))
    assert sorted(i for i, _ in kept if i is not None) == [1, 4, 6, 7, 9]
    assert [t for i, t in kept if i is None] == ["no id at all"]


def test_components_of_a_long_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1100)] + [(5, 5), (8, 7), (7, 8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in [*range(1000, 1100), 7, 8]} == {7}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
