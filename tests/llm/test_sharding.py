import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import ODD, frame
from tradeloom.llm import sharding


@pytest.fixture(scope="module")
def many(spark):
    return frame(spark, [(i, f"text {i % 7}", "en", "a") for i in range(8000)])


def test_law_sizes_and_slots(spark, many):
    rows = sharding.shard_plan(many).collect()
    assert len(rows) == 8000
    slots = defaultdict(list)
    for r in rows:
        text = f"text {r.doc_id % 7}".encode()
        assert (r["size"], r.text_crc32, r.law) == (len(text) + 1, zlib.crc32(text), "key")
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = Counter(r.grown_shard for r in rows)
    assert all(abs(counts[s] - 8000 / 17) < 5 * (8000 / 17) ** 0.5 for s in range(17))


@pytest.mark.parametrize("shards", [1, 5, 12, 16])
def test_one_more_shard_takes_rows_only_into_itself(many, shards):
    rows = sharding.shard_plan(many, shards).collect()
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {shards} and abs(len(moved) - 8000 / (shards + 1)) < 5 * (8000 / (shards + 1)) ** 0.5
    assert sharding.grown(sharding.tree([1.0] * 16)) == sharding.tree([1.0] * 17)


def test_weights_and_confined_movement(many):
    even, heavy = [1.0] * 16, [1.0] * 16
    heavy[5] = 3.0
    a = {r.doc_id: r.shard for r in sharding.with_shard(many, 16, even).collect()}
    b = {r.doc_id: r.shard for r in sharding.with_shard(many, 16, heavy).collect()}
    # Rows move only into the region of shard 5 (0 to 7), within it only into its rack (4 to 7), within that only into it.
    for i, old in a.items():
        new = b[i]
        if new != old:
            assert new < 8
            assert old >= 8 or 4 <= new
            assert old >= 8 or old < 4 or new == 5
    assert abs(Counter(b.values())[5] / 8000 - 3 / 18) < 0.02
    assert abs(Counter(b.values())[12] / 8000 - 1 / 18) < 0.015


def test_odd_rows(odd):
    rows = sharding.shard_plan(odd).collect()
    assert sorted((repr(r.doc_id), r["size"]) for r in rows) == sorted((repr(i), len((t or "").encode()) + 1) for i, t, _, _ in ODD)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert len({(r.shard, r.slot) for r in rows}) == len(ODD)
    assert all((r.text_crc32 is None) == (r["size"] == 1 and r.doc_id != 2) for r in rows)
    placed = sharding.with_shard(odd)
    assert placed.columns == odd.columns and dict(placed.dtypes)["shard"] == "int"


def test_nothing_and_wrong_weights(nothing):
    assert sharding.shard_plan(nothing).collect() == []
    for weights in ([1.0, 0.0], [1.0]):
        with pytest.raises(ValueError):
            sharding.with_shard(nothing, 2, weights)


def test_plan_has_no_python_and_shuffles_no_text(many):
    plan = sharding.with_shard(many)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
