"""Kept results equal the results computed anew, after every batch and under replay."""

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tradeloom.operators.maintained import Leaderboard, OrphanWatch, VisitorSketches


def _board(scores):
    ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))
    return sorted(((m, s, i + 1) for i, (m, s) in enumerate(ranked)), key=repr)


def test_leaderboard_after_each_batch(spark, tmp_path):
    draw = random.Random(3)
    board = Leaderboard(spark, str(tmp_path / "b"), F.floor(F.col("score") / 10))
    scores: dict[int, int] = {}
    for number in range(3):
        batch = [(draw.randrange(30), draw.randrange(-15, 40)) for _ in range(40)]
        batch += [(99, 0), (None, 5)]
        for member, change in batch:
            if member is not None:
                scores[member] = scores.get(member, 0) + change
        df = spark.createDataFrame(batch, "member bigint, score bigint")
        assert board.add(df, number) is True
        assert board.add(df, number) is False
        assert rows(board.positions()) == _board(scores)
    asked = spark.createDataFrame([(7,), (99,), (1000,)], "member bigint")
    assert rows(board.positions_of(asked)) == [r for r in _board(scores) if r[0] in (7, 99)]
    assert rows(board.between(5, 25)) == [r for r in _board(scores) if 5 <= r[1] <= 25]


def test_leaderboard_batch_completes_after_a_crash(spark, tmp_path, monkeypatch):
    board = Leaderboard(spark, str(tmp_path / "b"), F.floor(F.col("score") / 10))
    first = spark.createDataFrame([(1, 5), (2, 15), (3, 15)], "member bigint, score bigint")
    board.add(first, 0)
    more = spark.createDataFrame([(1, 20), (2, -9)], "member bigint, score bigint")

    def crash(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(board.counts, "add", crash)
        try:
            board.add(more, 1)
        except RuntimeError:
            pass
    assert board.add(more, 1) is True
    assert rows(board.positions()) == _board({1: 25, 2: 6, 3: 15})


def test_empty_leaderboard(spark, tmp_path):
    board = Leaderboard(spark, str(tmp_path / "b"), F.floor(F.col("score") / 10))
    assert board.positions().count() == 0
    assert board.add(spark.createDataFrame([], "member bigint, score bigint"), 0) is True
    assert board.positions().count() == 0


def test_orphans_after_each_batch(spark, tmp_path):
    draw = random.Random(5)
    watch = OrphanWatch(spark, str(tmp_path / "w"), buckets=4)
    parents, children = set(), {}
    for number in range(4):
        change_p, change_c = [], []
        for key in draw.sample(range(12), 6):
            change_p.append((key, -1 if key in parents else 1))
            parents ^= {key}
        for child in draw.sample(range(60), 25):
            if child in children:
                change_c.append((child, children.pop(child), -1))
            else:
                children[child] = draw.randrange(12)
                change_c.append((child, children[child], 1))
        change_c.append((1000 + number, None, 1))
        p = spark.createDataFrame(change_p, "key bigint, n bigint")
        c = spark.createDataFrame(change_c, "child bigint, key bigint, n bigint")
        assert watch.apply(p, c, number) is True
        assert watch.apply(p, c, number) is False
        assert rows(watch.orphans()) == sorted(((a, b) for a, b in children.items() if b not in parents), key=repr)


def test_orphans_read_only_buckets_of_parents_that_went(spark, tmp_path, monkeypatch):
    watch = OrphanWatch(spark, str(tmp_path / "w"), buckets=8)
    keys = spark.range(100).select(F.col("id").alias("key"), F.lit(1).cast("bigint").alias("n"))
    watch.apply(keys, keys.select((F.col("key") + 1000).alias("child"), "key", "n"), 0)
    asked = []
    read = watch.children.read
    monkeypatch.setattr(watch.children, "read", lambda parts=None: (asked.append(parts), read(parts))[1])
    gone = spark.createDataFrame([(17, -1)], "key bigint, n bigint")
    watch.apply(gone, spark.createDataFrame([], "child bigint, key bigint, n bigint"), 1)
    assert [len(parts) for parts in asked] == [1]
    assert rows(watch.orphans()) == [(1017, 17)]


def test_sketches_under_replay_and_repeats(spark, tmp_path):
    visits = VisitorSketches(spark, str(tmp_path / "v"))
    events = spark.range(4000).select(
        (F.col("id") % 700).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("event_type"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 1800).alias("ts"),
    )
    for number, part in enumerate(events.randomSplit([1.0, 1.0, 1.0], 4)):
        assert visits.add(part, number) is True
    once = rows(visits.between("2023-11-20", "2023-12-10"))
    assert visits.add(events, 2) is False
    assert visits.add(events, 3) is True  # the same events again
    assert rows(visits.between("2023-11-20", "2023-12-10")) == once
    exact = rows(
        events.where("ts >= '2023-11-20' AND ts < '2023-12-11'").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    )
    assert [t for t, _ in once] == [t for t, _ in exact]
    assert all(abs(a - b) <= 0.03 * b for (_, a), (_, b) in zip(once, exact))
    assert visits.between("2030-01-01", "2030-02-01").count() == 0
