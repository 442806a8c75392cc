"""Golden results on the exact relational seed."""

import random

import pytest

from pyspark.sql import functions as F

from bench import fan_out_customer_stats
from tests.conftest import rows
from tradeloom.operators import graph as g
from tradeloom.operators import joins, rankings, reports


def test_merchant_stats(seed):
    report = reports.merchant_stats(seed.users, seed.goods, seed.reviews)
    assert [tuple(r)[0:1] + tuple(r)[2:] for r in report.collect()] == [
        (2, 5, None, 0), (3, 5, None, 0), (4, 5, 4.5, 2), (1, 5, 4.33, 6), (5, 5, 4.0, 2),
    ]


def test_category_stats(seed):
    got = {r["caty_id"]: tuple(r)[2:] for r in reports.category_stats(seed.categories, seed.goods, seed.orders, seed.reviews).collect()}
    assert got == {1: (5, 6, 6), 2: (5, 5, 0), 3: (5, 5, 0), 4: (5, 5, 2), 5: (5, 5, 2), **{c: (0, 0, 0) for c in range(6, 11)}}


def test_customer_stats(seed):
    got = {r["user_id"]: tuple(r)[2:] for r in reports.customer_stats(seed.users, seed.orders, seed.reviews).collect()}
    ratings = {6: 5, 7: 4, 8: 5, 9: 3, 10: 5, 11: 4, 12: 5, 13: 4, 14: 5, 15: 3}
    assert got == {u: (3 if u < 12 else 2, 1, float(r)) for u, r in ratings.items()}


def test_eager_fold_equals_fan_out(seed):
    folded = reports.customer_stats(seed.users, seed.orders, seed.reviews, k=None)
    assert rows(folded) == rows(fan_out_customer_stats(seed.users, seed.orders, seed.reviews))


def test_goods_ordered_more_than_once(seed):
    counts = reports.order_totals(seed.orders, "good_id").where("n_orders > 1")
    assert rows(counts) == [(1, 2)]


def test_category_share(seed):
    share = rankings.category_share(seed.categories, seed.goods, seed.orders)
    got = {r["caty_id"]: r["percentage_of_total_orders"] for r in share.collect()}
    assert got == {1: 23.08, **dict.fromkeys(range(2, 6), 19.23), **dict.fromkeys(range(6, 11), 0.0)}


def test_moving_ratings(seed):
    for split in (False, True):
        moving = rankings.moving_ratings(seed.goods, seed.reviews, split=split).where("good_id = 1")
        assert rows(moving, "review_id", "moving_avg_rating") == [(1, 5.0), (6, 4.5)]


def test_rating_histogram(seed):
    assert rows(reports.rating_histogram(seed.reviews)) == [(3, 2), (4, 3), (5, 5)]


def test_anti_joins(seed):
    assert joins.lacking(seed.goods, seed.reviews, "good_id").count() == 16
    assert joins.lacking(seed.reviews, seed.orders, ["user_id", "good_id"]).count() == 0


def test_common_neighbours(seed):
    totals = {r["common_neighbours"]: r["pairs"] for r in g.common_neighbour_totals(seed.goods).collect()}
    assert totals == {1: 0, 2: 50}
    pairs = g.common_neighbours(seed.goods, 60)
    assert pairs.count() == 50
    assert rows(pairs.limit(2), "good1", "good2", "common_neighbours") == [(1, 2, 2), (1, 3, 2)]


def test_also_bought(seed):
    bought = reports.purchase_edges(seed.orders)
    assert rows(g.also_bought(bought, 6)) == [(16, 1), (20, 1)]


def test_graph_sizes(seed):
    graph = g.build_graph(seed.users, seed.goods, seed.categories, seed.orders, seed.reviews)
    sizes = [graph.users, graph.products, graph.categories, graph.sold_by, graph.in_category, graph.bought, graph.reviewed]
    assert [df.count() for df in sizes] == [15, 25, 10, 25, 25, 26, 10]


def test_dangling_edges_are_dropped(seed):
    few = seed.users.where("user_id <> 6")
    graph = g.build_graph(few, seed.goods.where("good_id <> 3"), seed.categories, seed.orders, seed.reviews)
    assert graph.bought.where("user_id = 6 or good_id = 3").count() == 0
    assert graph.bought.count() == 26 - 3 - 1


def test_paths_between_users(seed):
    bought = reports.purchase_edges(seed.orders)
    edges = [g.Edges(bought, "user_id", "u", "good_id", "g")]
    assert rows(g.shortest_path(edges, "u6", "u11", 3)) == [(2, ["u6", "g1", "u11"])]
    assert g.shortest_path(edges, "u6", "u12", 5).count() == 0
    assert rows(g.shortest_path(edges, "u6", "u6", 3)) == [(0, ["u6"])]
    assert g.shortest_path(edges, "u6", "u11", 1).count() == 0
    assert rows(g.reachable(edges, "u6", 3).where("hops = 3"), "node") == [("g16",), ("g20",)]


def similar_by_force(sets, k):
    out = []
    for a, x in sets.items():
        for b, y in sets.items():
            if a != b:
                common, total = len(x & y), len(x | y)
                out.append((-(common / total), -common, a, b))
    return [(a, b, -c, round(-s, 9)) for s, c, a, b in sorted(out)[:k]]


def shops(spark, sets):
    goods = [(m, c) for m, own in sets.items() for c in own]
    users = [(m, f"shop {m}", "merchant") for m in sets]
    return spark.createDataFrame(goods, "merch_id bigint, caty_id bigint"), spark.createDataFrame(users, "user_id bigint, name string, user_type string")


def top_similar(spark, sets, k):
    found = g.similar_merchants(*shops(spark, sets), k)
    got = [(r.user1, r.user2, r.common_categories, round(r.similarity, 9)) for r in found.collect()]
    return sorted(got, key=lambda r: (-r[3], -r[2], r[0], r[1]))


def odd_shops():
    rng = random.Random(6)
    hub = {m: {0, 100 + m} for m in range(1, 120)}
    mixed = {m: {0} | set(rng.sample(range(1, 14), rng.randrange(0, 6))) for m in range(1, 60)}
    ends = {m: set(rng.sample([1, 2, 3], rng.randrange(1, 4))) | {10 * m} for m in range(1, 40)}
    few = {1: {1}, 2: {2}, 3: {1, 3}, 4: {4}, 5: {5, 6}, 6: {7}}
    return {"hub": hub, "mixed": mixed, "ends": ends, "few": few}


@pytest.mark.parametrize("shape", ["hub", "mixed", "ends", "few"])
def test_most_similar_merchants_are_those_of_all_pairs(spark, shape):
    sets = odd_shops()[shape]
    for k in (1, 10, 60):
        assert top_similar(spark, sets, k) == similar_by_force(sets, k)


def test_a_category_of_all_merchants_joins_few_classes(spark):
    """2,000 shops of two categories, one of them everyone's: 4 million pairs have similarity 1/3."""
    goods, _ = shops(spark, {m: {0, 100 + m} for m in range(1, 2001)})
    sets = goods.groupBy(F.col("merch_id").alias("user_id")).agg(F.sort_array(F.collect_list("caty_id")).alias("cats"))
    members = sets.withColumn("n", F.size("cats").cast("bigint"))
    assert g._met_classes(members, 0.2, 10).count() == 11 * 10


def walks(pairs, start, goal, most):
    """All shortest walks over undirected pairs, by trying."""
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    layer = [[start]]
    for _ in range(most + 1):
        hit = [p for p in layer if p[-1] == goal]
        if hit:
            return min(hit)
        layer = [p + [n] for p in layer for n in near.get(p[-1], ()) if n not in p]
    return None


def test_two_sided_search_finds_the_smallest_path(spark):
    rng = random.Random(8)
    one = [(rng.randrange(1, 14), rng.randrange(1, 14)) for _ in range(16)]
    two = [(rng.randrange(1, 14), rng.randrange(1, 9)) for _ in range(10)]
    edges = [
        g.Edges(spark.createDataFrame(one + one[:3], "a bigint, b bigint"), "a", "u", "b", "g"),
        g.Edges(spark.createDataFrame(two, "x bigint, y bigint"), "x", "g", "y", "c"),
    ]
    pairs = [(f"u{a}", f"g{b}") for a, b in one] + [(f"g{x}", f"c{y}") for x, y in two]
    for goal, most in (("u2", 4), ("g5", 5), ("c3", 5), ("u9", 3), ("u1", 0)):
        want = walks(pairs, "u1", goal, most)
        assert rows(g.shortest_path(edges, "u1", goal, most)) == ([] if want is None else [(len(want) - 1, want)])


def test_a_hub_is_not_opened_while_the_other_side_is_smaller(spark, monkeypatch):
    hub = [(1, good) for good in range(1, 2001)] + [(2, 7), (2, 3000), (3, 3000)]
    edges = [g.Edges(spark.createDataFrame(hub, "a bigint, b bigint"), "a", "u", "b", "g")]
    sizes, grow = [], g._Side.grow
    monkeypatch.setattr(g._Side, "grow", lambda self: (grow(self), sizes.append(self.size))[0])
    # u3 - g3000 - u2 - g7 - u1: three layers of one or two nodes from u3, one of 2,000 from the hub at the end.
    assert rows(g.shortest_path(edges, "u3", "u1", 4)) == [(4, ["u3", "g3000", "u2", "g7", "u1"])]
    assert sizes.count(2000) <= 1 and len(sizes) == 4
    assert "u1" not in {r.path[0] for r in g.shortest_path(edges, "u2", "u3", 2).collect()}


def test_review_takes_one_order(spark):
    """A good bought twice gives its review one row: the latest order before it."""
    day = "timestamp_ntz'2024-01-0{}'"
    orders = spark.sql(
        "select * from values (1L, 7L, 9L, {}), (2L, 7L, 9L, {}), (3L, 7L, 9L, {}) t(id, user_id, good_id, order_ts)".format(
            day.format(1), day.format(3), day.format(8)
        )
    )
    reviews = spark.sql(
        "select * from values (50L, 7L, 9L, 5L, {}), (51L, 8L, 9L, 4L, {}) t(id, user_id, good_id, rating, review_ts)".format(
            day.format(5), day.format(5)
        )
    )
    assert rows(joins.review_orders(reviews, orders), "id", "order_id") == [(50, 2), (51, 0)]


def test_null_keys_do_not_break_the_anti_join(spark, seed):
    orders = seed.orders.unionByName(spark.sql("select 99L id, cast(null as bigint) user_id, cast(null as bigint) good_id"))
    assert joins.lacking(seed.goods, orders, "good_id").count() == 0
    assert joins.lacking(seed.goods.where(F.lit(True)), orders.where("good_id is null"), "good_id").count() == 25
