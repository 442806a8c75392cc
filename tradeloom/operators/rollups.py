"""Event facts, daily rollups, and the dashboards on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.dialect import nulls_last, ratio_half_even, top_k
from tradeloom.operators.filters import in_last_days
from tradeloom.operators.joins import review_orders

COUNTERS = ["orders_count", "reviewed_count", "rating_sum", "review_count"]

# Key columns of each rollup; the good's category and merchant follow from the
# good and belong to the key, so they are never added up.
ROLLUP_KEYS = {
    "category": ["date", "category_id"],
    "merchant": ["date", "merchant_id"],
    "product": ["good_id", "category_id", "merchant_id"],
}


def order_events(orders: DataFrame, goods: DataFrame) -> DataFrame:
    sold = goods.select("good_id", F.col("merch_id").alias("merchant_id"), F.col("caty_id").alias("category_id"))
    return orders.join(sold, "good_id").select(
        F.col("id").alias("order_id"), "user_id", "merchant_id", "good_id", "category_id", "order_ts", "price"
    )


def review_events(reviews: DataFrame, goods: DataFrame, orders: DataFrame) -> DataFrame:
    sold = goods.select("good_id", F.col("merch_id").alias("merchant_id"), F.col("caty_id").alias("category_id"))
    return review_orders(reviews, orders).join(sold, "good_id").select(
        F.col("id").alias("review_id"),
        "order_id",
        "user_id",
        "good_id",
        "merchant_id",
        "category_id",
        "rating",
        F.coalesce("comment", F.lit("")).alias("comment"),
        "review_ts",
    )


def order_deltas(orders: DataFrame) -> DataFrame:
    """What one order adds: a count of 1 and nothing else."""
    zero = F.lit(0).cast("bigint")
    return orders.select(
        F.to_date("order_ts").alias("date"), "category_id", "merchant_id", "good_id",
        F.lit(1).cast("bigint").alias("orders_count"), zero.alias("reviewed_count"),
        zero.alias("rating_sum"), zero.alias("review_count"),
    )


def review_deltas(reviews: DataFrame) -> DataFrame:
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return reviews.select(
        F.to_date("review_ts").alias("date"), "category_id", "merchant_id", "good_id",
        zero.alias("orders_count"), one.alias("reviewed_count"),
        F.coalesce(F.col("rating").cast("bigint"), F.lit(0)).alias("rating_sum"), one.alias("review_count"),
    )


def fold(deltas: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the counters per key; rows that add up to nothing are dropped."""
    summed = deltas.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return summed.where(sum((F.col(c) for c in COUNTERS), F.lit(0)) != 0)


def rollup(orders: DataFrame, reviews: DataFrame, kind: str) -> DataFrame:
    """Batch form of a rollup over both event tables."""
    return fold(order_deltas(orders).unionByName(review_deltas(reviews)), ROLLUP_KEYS[kind])


def sales_summary(orders: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    recent = orders.where(in_last_days("order_ts", days, as_of))
    return recent.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("price").alias("total_revenue"),
        F.avg("price").alias("avg_order_value"),
        F.countDistinct("user_id").alias("unique_customers"),
    )


def _rated(counters: DataFrame, key: str, days_back: tuple[int, str] | None) -> DataFrame:
    if days_back is not None:
        days, as_of = days_back
        counters = counters.where(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return counters.groupBy(key).agg(
        F.sum("orders_count").alias("total_orders"),
        F.sum("reviewed_count").alias("total_reviews"),
        F.sum("rating_sum").alias("_s"),
        F.sum("review_count").alias("_n"),
        # Mean of the daily means, over the days that have reviews.
        F.avg(F.try_divide(F.col("rating_sum").cast("double"), F.col("review_count"))).alias("_daily"),
    )


def category_report(stats: DataFrame, as_of: str, days: int = 30, k: int | None = 5) -> DataFrame:
    """Categories by orders, with the average rating over all their reviews.

    ``avg_of_daily_avg`` weighs every day the same, whatever its reviews.
    """
    report = _rated(stats, "category_id", (days, as_of)).select(
        "category_id",
        "total_orders",
        "total_reviews",
        ratio_half_even("_s", "_n").alias("avg_rating"),
        F.round("_daily", 6).alias("avg_of_daily_avg"),
    )
    return top_k(report, [nulls_last("total_orders"), F.col("category_id")], k)


def product_report(stats: DataFrame, k: int | None = 20) -> DataFrame:
    """Reviewed goods by orders.  Aggregates on read, so it is right also while
    a rollup still holds several rows per key."""
    summed = stats.groupBy("good_id").agg(
        F.sum("orders_count").alias("total_orders"),
        F.sum("review_count").alias("review_count"),
        F.sum("rating_sum").alias("_s"),
    )
    report = summed.where(F.col("review_count") > 0).select(
        "good_id", "total_orders", "review_count", ratio_half_even("_s", "review_count").alias("avg_rating")
    )
    return top_k(report, [nulls_last("total_orders"), nulls_last("avg_rating"), F.col("good_id")], k)


def recent_rating_histogram(reviews: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    recent = reviews.where(in_last_days("review_ts", days, as_of))
    return recent.groupBy("rating").agg(F.count(F.lit(1)).alias("count_reviews"))


def repeat_customers(orders: DataFrame, as_of: str, days: int = 90, k: int | None = 50) -> DataFrame:
    """Customers with more than one order, by spend.  ``order_id`` may repeat in
    an at-least-once feed, so each order is folded once before it is counted."""
    recent = orders.where(in_last_days("order_ts", days, as_of))
    per_order = recent.groupBy("user_id", "order_id").agg(F.sum("price").alias("_spent"))
    report = (
        per_order.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("total_orders_per_user"), F.sum("_spent").alias("total_spent"))
        .where(F.col("total_orders_per_user") > 1)
    )
    return top_k(report, [nulls_last("total_spent"), F.col("user_id")], k)


def low_rated_merchants(
    stats: DataFrame, as_of: str, days: int = 30, more_than: int = 10, below: float = 3.0
) -> DataFrame:
    return (
        _rated(stats, "merchant_id", (days, as_of))
        .select("merchant_id", "total_orders", "total_reviews", ratio_half_even("_s", "_n").alias("avg_rating"))
        .where((F.col("total_reviews") > more_than) & (F.col("avg_rating") < below))
    )


def expire(df: DataFrame, ts: str | Column, ttl: str, as_of: str) -> DataFrame:
    """Drop rows older than ``ttl`` (an interval such as '30 days') at ``as_of``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return df.where(ts >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {ttl}"))
