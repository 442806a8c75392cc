import random
import zlib

from tests.llm.conftest import ODD, frame
from tradeloom.llm import language


def made_up(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


TONGUES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["ал", "ро", "ни", "ту"]}


def test_held_out_texts_are_recognised(spark):
    rng = random.Random(0)
    rows = [(i, made_up(rng, TONGUES[g], rng.randrange(2, 80)).upper() if i % 5 else made_up(rng, TONGUES[g], 40), g, "a") for i in range(300) for g in [list(TONGUES)[i % 3]]]
    rows += [(1000 + i, made_up(rng, ["zzq", "wxx"], 40), None, "a") for i in range(5)]
    got = {r.doc_id: r for r in language.identified(frame(spark, rows)).collect()}
    assert len(got) == 305
    for i, _, g, _ in rows:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if g:
            assert r.lang_pred == g
        else:
            assert r.rejected and r.lang_pred in TONGUES


def test_labels_of_held_out_texts_are_not_learned(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    rest = [i for i in range(400) if i not in held][:60]
    rng = random.Random(1)
    rows = [(i, made_up(rng, TONGUES["aa"], 30), "aa", "s") for i in rest] + [(i, made_up(rng, TONGUES["bb"], 30), "bb", "s") for i in held]
    assert {r.lang_pred for r in language.identified(frame(spark, rows)).collect()} == {"aa"}


def test_odd_rows(odd):
    got = sorted(((r.doc_id, r.lang_pred == "und", r.score == 0) for r in language.identified(odd).collect()), key=repr)
    none = lambda t: not any(c.isalpha() for c in t or "")
    assert [x[:2] for x in got] == sorted([(i, none(t)) for i, t, _, _ in ODD], key=repr)
    assert all(zero for _, unknown, zero in got if unknown)


def test_nothing_to_learn_from(spark, nothing):
    assert language.identified(nothing).collect() == []
    rows = language.identified(frame(spark, [(1, "some text", None, "a")])).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in rows] == [("und", 0.0, True)]
