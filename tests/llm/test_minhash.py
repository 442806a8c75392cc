import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD, frame, sentence
from tradeloom.llm import minhash, near_links


def shingles(text, k=5):
    w = (text or "").split()
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(0)
    texts = pa.array([sentence(rng, rng.randrange(200)) for _ in range(40)] + [None, "", "x"])
    whole = minhash.text_signatures(texts)
    monkeypatch.setattr(minhash, "_CHUNK", 37)
    assert np.array_equal(whole, minhash.text_signatures(texts))
    one = np.concatenate([minhash.text_signatures(texts.slice(i, 1)) for i in range(len(texts))], axis=1)
    assert np.array_equal(whole, one)


@pytest.mark.parametrize("buckets", [1, 2, 9])
def test_each_row_against_its_edited_text_and_the_next(spark, buckets):
    rng = random.Random(1)
    rows = [(3 * i, sentence(rng, rng.choice([0, 1, 4, 60, 400])) if i % 7 else None, "en", "a") for i in range(60)]
    rows[20] = (60, rows[19][1], "en", "a")
    got = {r.doc_id: r for r in minhash.compared_with_next(frame(spark, rows[::-1]).repartition(4), buckets).collect()}
    assert len(got) == 60
    for k, (i, text, _, _) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % 60][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = got[i]
        assert (r.n_chars, r.edited) == (len(text), edited)
        assert abs(r.near_edited - jaccard(shingles(text), shingles(edited))) < 0.2
        assert abs(r.near_next - jaccard(shingles(text), shingles(following))) < 0.2
    assert got[57].fingerprint == got[60].fingerprint and got[57].near_next == 1.0


def test_odd_rows(odd, spark):
    rows = minhash.compared_with_next(odd, 3).collect()
    assert sorted((repr(r.doc_id), r.n_chars) for r in rows) == sorted((repr(i), len(t or "")) for i, t, _, _ in ODD)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_text = {}
    for r in minhash.fingerprints(odd).collect():
        by_text.setdefault(r.copy, set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    (alone,) = minhash.compared_with_next(frame(spark, [(1, "ab cd ef gh", "en", "a")])).collect()
    assert alone.edited == "ab cd ef ab" and alone.near_next == 1.0


def test_nothing(nothing):
    assert minhash.compared_with_next(nothing).collect() == []
    assert near_links.near_pairs(nothing)[0].collect() == []
    assert near_links.near_links(nothing).collect() == []


@pytest.mark.parametrize("block_rows, block_bytes, broadcast", [(1024, 8 << 20, 10**6), (2, 8 << 20, 0), (1024, 2000, 10**6)])
def test_near_pairs_are_those_of_all_pairs(spark, monkeypatch, block_rows, block_bytes, broadcast):
    monkeypatch.setattr(near_links, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(near_links, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(near_links, "BROADCAST_ROWS", broadcast)
    rng = random.Random(6)
    rows = []
    for k in range(15):
        words = sentence(rng, 120, 3000).split()
        for c in range(5):
            new = list(words)
            for at in rng.sample(range(120), c * 2):
                new[at] = f"n{rng.randrange(10**6)}"
            rows.append((10 * k + c, " ".join(new), "en", "a"))
        rows.append((10 * k + 9, " ".join(words), "en", "b"))
    pairs, members = near_links.near_pairs(frame(spark, rows))
    name = {r.doc_id: r["class"] for r in members.collect()}
    text = {name[i]: t for i, t, _, _ in rows}
    want = {
        (a, b): jaccard(shingles(text[a]), shingles(text[b])) for a in text for b in text if a < b and jaccard(shingles(text[a]), shingles(text[b])) >= 0.8
    }
    got = [(r.a, r.b, r.similarity) for r in pairs.collect()]
    assert len(got) == len(want) > 10 and {(a, b): s for a, b, s in got} == pytest.approx(want)
    links = {r.doc_id: r.links for r in near_links.near_links(frame(spark, rows)).collect()}
    assert links == {i: sum(name[i] in pair for pair in want) for i, _, _, _ in rows}


def test_links_of_odd_rows(odd):
    got = sorted((repr(r.doc_id), r.links) for r in near_links.near_links(odd).collect())
    assert got == sorted((repr(i), 0) for i, _, _, _ in ODD)


def test_fingerprint_text_is_hexadecimal():
    (text,) = minhash.as_text(minhash.kept(minhash.text_signatures(pa.array(["a b c"]))))
    assert len(bytes.fromhex(text)) == 2 * minhash.PERMUTATIONS and hashlib.md5(text.encode())
