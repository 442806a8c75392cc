import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, frame
from tradeloom.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0bé漢.🙂", max_size=40)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_every_rank_of_every_text(values):
    lists = infill.SkipLists(pa.array(values, pa.string()))
    for i, text in enumerate(values):
        units = UNIT.findall(text or "")
        assert lists.n[i] == len(units) and "".join(units) == (text or "")
        ranks = np.arange(len(units) + 1)
        assert lists.points(np.full(len(ranks), i), ranks).tolist() == [len("".join(units[:r])) for r in ranks]


def test_lanes_thin_out_and_widths_add_up():
    lists = infill.SkipLists(pa.array(["wörd " * 100_000 + " ", "x"], pa.string()))
    sizes = [len(lane.units) for lane in lists.lanes]
    assert len(sizes) > 6 and all(b < a / 2 for a, b in zip(sizes[:5], sizes[1:6]))
    for lane in lists.lanes:
        inner = lane.units < infill._NO_LINK
        assert lane.units[inner].sum() == lists.n.sum() and lane.points.sum() == 500_001 + 1
    assert lists.points(np.array([0, 0]), np.array([77_777, 100_001])).tolist() == [77_777 * 5 - 1, 500_001]


def by_force(i, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_outputs_and_round_trip(spark):
    marks = [(100 + i, t, "en", "a") for i in range(40) for t in ("a <P> b c", "< P> <S >a<M", "x<S>", "<P <S <M words of text <", "one\ntwo  three ")]
    long = [(300 + i, "Ünï \t" * 200_000 + " \n", "en", "a") for i in range(4)]
    rows = ODD + marks + long
    out = infill.infilled(frame(spark, rows).repartition(3)).withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in out), key=key) == sorted(
        ((i, *by_force(i, t), t or "") for i, t, *_ in rows), key=key
    )
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_no_shuffle_and_empty_table(spark, nothing):
    df = infill.infilled(nothing)
    assert df.collect() == [] and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
