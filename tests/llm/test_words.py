import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm.words import _BASES, find_words, letter_runs, mix, run_hashes, shingle_ranges, slices, token_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0bé漢.", max_size=20)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(values):
    found = find_words(pa.array(values, pa.string()))
    for i, text in enumerate(values):
        assert [w.decode() for w in found.bytes_of(i)] == WORD.findall(text or "")
    hashes = found.hashes()
    names = [w for v in values for w in WORD.findall(v or "")]
    assert len(set(zip(names, hashes.tolist()))) == len(set(names)) == len(set(hashes.tolist()))


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(1, 4))
def test_shingles_of_every_text(values, k):
    found = find_words(pa.array(values, pa.string()))
    start, end, bounds = shingle_ranges(found.first, k)
    hashes = run_hashes(found.hashes(), start, end)
    names = {}
    for i, text in enumerate(values):
        w = WORD.findall(text or "")
        want = [tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))] if w else []
        own = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(own) == len(want)
        for name, h in zip(want, own):
            assert names.setdefault(name, h) == h
    assert len(set(names.values())) == len(names)


def test_slices_keep_all_rows_and_their_order():
    batch = pa.record_batch({"text": ["a" * 10, None, "b" * 50, "", "c", "d" * 9]})
    parts = list(slices(iter([batch, batch.slice(0, 0)]), limit=12))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()
    assert [p.num_rows for p in parts] == [2, 1, 3]


def test_letter_runs_fold_case_and_give_prefixes():
    hashes, first, (four,) = letter_runs(pa.array(["Stupid!! idea", None, "stupid3idea abcd"]), (4,))
    assert first.tolist() == [0, 2, 2, 5]
    assert hashes[0] == hashes[2] == token_hashes(["stupid"])[0]
    assert hashes[1] == hashes[3]
    assert four[4] == 0 and four[0] == four[2] != 0
    assert np.all(four[[1, 3]] == 0)


def swaps(n, one, two):
    """The sequence one, two, two, one, ... of n members, which sums of powers modulo 2^64 confuse with its swap."""
    return [two if i.bit_count() % 2 else one for i in range(n)]


def test_swapped_sequences_have_other_hashes():
    a, b = "".join(swaps(4096, "a", "b")), "".join(swaps(4096, "b", "a"))
    found = find_words(pa.array([a, b, a], pa.string()))
    for lane in (0, 1):
        one, two, three = found.hashes(lane).tolist()
        assert one != two and one == three
    runs = find_words(pa.array([" ".join(swaps(2048, "x", "y")), " ".join(swaps(2048, "y", "x"))], pa.string()))
    for lane in (0, 1):
        one, two = run_hashes(runs.hashes(lane), np.array([0, 2048]), np.array([2048, 4096]), lane)
        assert one != two


def test_run_hashes_are_the_polynomial_modulo_the_prime():
    prime, rng = (1 << 61) - 1, random.Random(1)
    words = np.array([rng.getrandbits(64) for _ in range(300)] + [0, prime, 2**64 - 1], dtype=np.uint64)
    for lane in (0, 1):
        base = _BASES[lane]
        for low, high in [(0, 303), (5, 55), (300, 303), (7, 7)]:
            value = sum(int(words[i]) % prime * pow(base, i - low, prime) for i in range(low, high)) % prime
            want = mix(np.array([value], dtype=np.uint64) ^ mix(np.array([high - low], dtype=np.uint64)))
            assert run_hashes(words, np.array([low]), np.array([high]), lane).tolist() == want.tolist()
