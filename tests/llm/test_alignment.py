import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_pipeline import QUERIES
from tests.llm.conftest import ODD, frame
from tradeloom.llm import alignment

FOLDER = "/root/testdata/sf0.001"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 60)), st.lists(st.integers(0, 60)), st.data())
def test_gallop_finds_the_first_not_below(values, wanted, data):
    long = np.array(sorted(set(values)), dtype=np.int64)
    short = np.array(wanted, dtype=np.int64)
    low = np.array([data.draw(st.integers(0, len(long))) for _ in wanted], dtype=np.int64)
    high = np.array([data.draw(st.integers(a, len(long))) for a in low.tolist()], dtype=np.int64)
    guess = np.array([data.draw(st.integers(-2, len(long) + 2)) for _ in wanted], dtype=np.int64)
    got = alignment.gallop(short, long, low, high, guess)
    assert got.tolist() == [a + int(np.searchsorted(long[a:b], s)) for s, a, b in zip(wanted, low.tolist(), high.tolist())]


@pytest.fixture(scope="module")
def tools():
    slow = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    slow.encode_special_tokens = True
    return slow, alignment.ByteTokens(), alignment.PieceTokens()


ALPHABET = st.sampled_from(["a", "B", " ", "  ", "\t", "\n", "\r\n", "é", "漢", "🙂", "1", "12", "'s", "'ll", "_", "<|endoftext|>", "<s>", "　", "\xa0", "▁", "\x00", "ſ", "don't", "…", "x́", "٣", "Ⅷ"])


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=25).map("".join))
def test_fast_ids_are_the_librarys(tools, text):
    slow, one, _ = tools
    assert one.encode(text) == slow.encode(text, add_special_tokens=False).ids


def test_ids_of_all_documents_and_long_blanks(spark, tools):
    slow, one, _ = tools
    texts = [" " + (r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += [" " * 1_200_000, "x" + "\n" * 150_000 + " y", "ab " * 100_000]
    assert [one.encode(t) for t in texts] == [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]


def by_force(rows, tools):
    slow, one, two = tools
    found, counts = [], Counter()
    for i, text in rows:
        a = slow.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        want = b" " + (text or "").encode()
        if b"".join(one.bytes[x] for x in a) != want or b"".join(two.bytes[x] for x in b) != want:
            a, b = [], []
        ends_a, ends_b = np.cumsum([len(one.bytes[x]) for x in a]).tolist(), np.cumsum([len(two.bytes[x]) for x in b]).tolist()
        links, k = [], 0
        for x, low, high in zip(a, [0] + ends_a, ends_a):
            while ends_b[k] <= low:
                k += 1
            j = k
            while j < len(b) and (j == k or ends_b[j - 1] < high):
                links.append((x, b[j]))
                j += 1
        both = sorted(set(ends_a) & set(ends_b))
        place_a, place_b = ({end: n + 1 for n, end in enumerate(ends)} for ends in (ends_a, ends_b))
        groups, pa, pb = [], 0, 0
        for cut in both:
            qa, qb = place_a[cut], place_b[cut]
            groups.append(",".join(map(str, a[pa:qa])) + "|" + ",".join(map(str, b[pb:qb])))
            pa, pb = qa, qb
        counts.update(links)
        found.append((i, a, b, groups, links))
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(highest.get(y, 0), n)
    out = []
    for i, a, b, groups, links in found:
        best = sum(counts[p] == highest[p[1]] for p in links)
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), ";".join(groups)))
    return sorted(out, key=repr)


def test_against_brute_force(spark, tools):
    rows = [r for r in ODD if len(r[1] or "") < 10_000]
    rows += [(50 + i, t, "en", "a") for i, t in enumerate(["<|endoftext|> and <s> are words", "tab\tand \x00 nul", "  two spaces", "▁ is a sign", "é漢🙂" * 20, "don't" * 9])]
    rows += [(80, "tab\tand \x00 nul", None, None)] * 3
    got = alignment.aligned(frame(spark, rows).repartition(4)).collect()
    want = by_force([(r[0], r[1]) for r in rows], tools)
    assert sorted([tuple(r) for r in got], key=repr) == want
    assert sum(w[3] > 0 for w in want) > 8 and any(w[1] == 0 and w[0] is not None and w[0] >= 50 for w in want)


def test_a_long_text(spark):
    got = alignment.aligned(frame(spark, [(1, "wörd one " * 300_000, "en", "a"), (2, " " * 400_000, "en", "a")])).collect()
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups for r in got) and min(r.n_a for r in got) > 0


def test_empty_table(spark, nothing):
    assert alignment.aligned(nothing).collect() == []


def test_query(spark, tools):
    got = QUERIES["op13_aligned_tokens"](spark, FOLDER).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in by_force(rows, tools)]
    assert sorted([tuple(r) for r in got], key=repr) == sorted(want, key=repr)
