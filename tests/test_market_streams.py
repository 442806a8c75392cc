"""The endless feed and the order facts that two streams fill."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tradeloom.operators import generate, joins
from tradeloom.plans.snapshots import SnapshotTable
from tradeloom.streaming.market import EndlessFeed, OrderFacts, closing_rows


def _pairs(spark, data):
    return spark.createDataFrame(data, "id bigint, k string, v bigint")


def test_insert_new_skips_and_counts(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "id bigint, k string, v bigint", ["k", "v"], F.pmod(F.xxhash64("k", "v"), F.lit(4)))
    assert table.insert_new(_pairs(spark, [(2, "a", 1), (1, "a", 1), (3, "b", 1)]), ["id"], 0) == (2, 1)
    again = _pairs(spark, [(4, "a", 1), (5, "c", 1), (6, None, 1), (7, None, 1)])
    assert table.insert_new(again, ["id"], 1) == (3, 1)
    assert table.insert_new(again, ["id"], 1) is None
    assert table.insert_new(_pairs(spark, []), ["id"], 2) == (0, 0)
    assert rows(table.read(), "id") == [(1,), (3,), (5,), (6,), (7,)]


def test_feed_twice_gives_the_same_rows(spark, seed, tmp_path):
    runs = []
    for name, sizes in (("a", [40, 40, 40]), ("b", [60, 60])):
        feed = EndlessFeed(spark, str(tmp_path / name))
        for ticks in sizes:
            feed.run(seed.users, seed.goods, str(tmp_path / f"{name}-progress"), "2024-01-01", ticks, 110).awaitTermination()
        runs.append((rows(feed.orders()), rows(feed.reviews.read())))
        told = feed.runs.read().agg(F.sum("ticks"), F.sum("said"), F.sum("kept"), F.sum("skipped")).first()
        assert tuple(told) == (110, 220, len(runs[-1][1]), 220 - len(runs[-1][1]))
        assert told[3] > 0
    ticks = spark.range(110).withColumnRenamed("id", "tick")
    orders, reviews = generate.event_feed(ticks, seed.users, seed.goods, "2024-01-01")
    assert runs[0] == runs[1] == (rows(orders), rows(reviews))


def _at(day):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day)


ORDERS = "id bigint, user_id bigint, good_id bigint, order_ts timestamp_ntz"
REVIEWS = "user_id bigint, good_id bigint, rating bigint, review_ts timestamp_ntz"
# (orders, reviews) of each run: (id, user, good, day) and (user, good, rating, day).
RUNS = [
    ([(1, 6, 1, 0), (2, 6, 7, 1), (3, 7, 3, 2), (4, None, 5, 2)], [(6, 1, 5, 3)]),
    # A review far behind its order, an order after its review, one of a good that does not exist, one exactly a grace behind.
    ([(5, 6, 1, 100), (6, 8, 5, 100), (7, 8, 999, 100), (11, 9, 9, 1)], [(6, 7, 2, 101), (8, 5, None, 102)]),
    # Rows long behind the watermark, and an order without a time.
    ([(8, 7, 8, 5), (9, 9, 2, None), (10, 6, 1, 4)], [(7, 3, 4, 6), (7, 8, 1, 7), (9, 2, 3, None)]),
]


@pytest.mark.parametrize("crash", [False, True])
def test_facts_equal_the_join_of_all_input(spark, seed, tmp_path, monkeypatch, crash):
    facts = OrderFacts(spark, str(tmp_path / "facts"), "bigint")
    names = (seed.users, seed.goods, seed.categories)
    all_orders, all_reviews = [], []
    for n, (orders, reviews) in enumerate(RUNS):
        all_orders += [(*o[:3], None if o[3] is None else _at(o[3])) for o in orders]
        all_reviews += [(*r[:3], None if r[3] is None else _at(r[3])) for r in reviews]
        own = (
            spark.createDataFrame(all_orders[-len(orders):], ORDERS),
            spark.createDataFrame(all_reviews[-len(reviews):], REVIEWS),
        )
        if n == len(RUNS) - 1:
            own = [a.unionByName(b) for a, b in zip(own, closing_rows(spark, "2100-01-01"))]
        streams = []
        for df, side in zip(own, ("orders", "reviews")):
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / side))
            streams.append(spark.readStream.schema(df.schema).parquet(str(tmp_path / side)))
        if crash and n == 1:
            with monkeypatch.context() as broken:
                def fail(*_):
                    raise RuntimeError("executor lost")

                broken.setattr(facts.marks, "upsert", fail)
                with pytest.raises(Exception):
                    facts.fill(*streams, *names, str(tmp_path / "progress")).awaitTermination()
        facts.fill(*streams, *names, str(tmp_path / "progress")).awaitTermination()
    want = joins.order_facts(
        spark.createDataFrame(all_orders, ORDERS), *names, spark.createDataFrame(all_reviews, REVIEWS)
    )
    got = facts.facts.read()
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    assert {r["order_id"]: (r["rating"], r["has_review"]) for r in got.collect()}[2] == (2, 1)
