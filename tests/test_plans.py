"""Physical plans: what must be pushed down, folded early, or never appear."""

import re

import pytest
from pyspark.sql import functions as F

from bench import fan_out_customer_stats
from tests.conftest import plan_text, rows
from tradeloom.catalog import REGISTRY
from tradeloom.functions.hashing import mix, pick
from tradeloom.operators import changes, documents, generate, joins, rankings, reports
from tradeloom.plans import ordered
from tradeloom.sources.market import Market

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def market(spark):
    return Market(spark, FOLDER)


def test_columns_and_filters_reach_the_scan(market):
    plan = plan_text(market.reviews.groupBy("rating").count())
    line = next(p for p in plan.splitlines() if "FileScan" in p and "lineitem" in p)
    assert "l_extendedprice" not in line and "l_tax" not in line
    assert "EqualTo(l_returnflag,R)" in line and "LessThanOrEqual(l_linenumber,2)" in line


def test_unused_review_order_join_disappears(market):
    # Purchases once and reviews once; the review-to-order lookup is not read.
    plan = plan_text(REGISTRY["category_daily_stats"](market.spark, FOLDER))
    assert len(re.findall(r"FileScan[^\n]*lineitem", plan)) == 2


def test_children_are_folded_before_they_meet(market):
    plan = plan_text(reports.customer_stats(market.users, market.orders, market.reviews, k=None))
    assert "Expand" not in plan  # no multi-distinct
    naive = plan_text(fan_out_customer_stats(market.users, market.orders, market.reviews))
    assert "Expand" in naive


def test_count_and_position_share_one_exchange(market):
    plan = plan_text(rankings.order_sequence(market.users, market.orders.select("id", "user_id"), split=False))
    window = plan[plan.index("Window") :]
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", window)) == 1


def test_top_k_does_not_sort_everything(market):
    plan = plan_text(reports.merchant_stats(market.users, market.goods, market.reviews))
    assert "TakeOrderedAndProject" in plan


def test_merchant_filter_prunes_the_customer_table(market):
    plan = plan_text(market.users.where("user_type = 'merchant'"))
    assert "customer.parquet" not in plan


def test_order_ids_have_one_type_and_do_not_collide(spark):
    orders = Market(spark, FOLDER).orders
    assert dict(orders.dtypes)["id"] == "decimal(38,0)"
    assert orders.select("id").distinct().count() == orders.count()


def test_draws_reach_all_of_a_large_pool(spark):
    keys = spark.range(2000).select(F.explode(F.array("id", F.col("id") + 2147483647, F.col("id") + 2**40)).alias("k"))
    drawn = keys.select(mix("k", 3).alias("m"), pick("k", 2**40, 5).alias("p")).agg(
        F.count_distinct("m").alias("m"), F.max("p").alias("most"), F.min("p").alias("least"), F.avg("p").alias("mean")
    ).first()
    assert drawn.m == 6000
    assert drawn.most > 2**39 * 1.99 and drawn.least < 2**30 * 2 and abs(drawn.mean / 2**39 - 1) < 0.05


@pytest.mark.parametrize(
    "name",
    ["leaderboard", "order_sequence", "moving_ratings", "nested_reviews", "enumerated_categories", "generated_orders", "generated_goods", "shuffled_customers"],
)
def test_plain_windows_give_the_same_rows(spark, monkeypatch, name):
    """The registered queries use the split plan; a plain window must agree."""
    split = rows(REGISTRY[name](spark, FOLDER))

    def plain(df, keys, order, number="rn", total=None, split=True):
        return ordered.row_index(df, keys, order, number, total, False)

    for module in (rankings, documents, joins, generate, changes):
        if hasattr(module, "row_index"):
            monkeypatch.setattr(module, "row_index", plain)
    assert rows(REGISTRY[name](spark, FOLDER)) == split
