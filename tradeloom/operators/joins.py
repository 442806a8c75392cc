"""Joins between users, goods, categories, orders and reviews.

No side is forced to broadcast: Spark's own threshold (and AQE, from the size
really seen) decides, and beyond it the skew split handles a hot good or user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.hashing import pick
from tradeloom.plans.ordered import row_index


def _named(df: DataFrame, key: str, as_key: str, as_name: str) -> DataFrame:
    return df.select(F.col(key).alias(as_key), F.col("name").alias(as_name))


def customers(users: DataFrame) -> DataFrame:
    return users.where(F.col("user_type") == "customer")


def merchants(users: DataFrame) -> DataFrame:
    return users.where(F.col("user_type") == "merchant")


def customer_orders(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders of customers with the customer's name."""
    buyers = _named(customers(users), "user_id", "user_id", "customer_name")
    return orders.join(buyers, "user_id").select("user_id", "customer_name", F.col("id").alias("order_id"))


def good_reviews(goods: DataFrame, reviews: DataFrame) -> DataFrame:
    names = _named(goods, "good_id", "good_id", "product_name")
    return reviews.join(names, "good_id").select(
        "good_id", "product_name", F.col("id").alias("review_id"), "rating", "comment"
    )


def order_details(orders: DataFrame, users: DataFrame, goods: DataFrame) -> DataFrame:
    """Each order with the names of its customer and its good."""
    return (
        orders.join(_named(users, "user_id", "user_id", "customer_name"), "user_id")
        .join(_named(goods, "good_id", "good_id", "product_name"), "good_id")
        .select(F.col("id").alias("order_id"), "customer_name", "product_name")
    )


def review_details(reviews: DataFrame, users: DataFrame, goods: DataFrame) -> DataFrame:
    return (
        reviews.join(_named(users, "user_id", "user_id", "customer_name"), "user_id")
        .join(_named(goods, "good_id", "good_id", "product_name"), "good_id")
        .select(F.col("id").alias("review_id"), "customer_name", "product_name", "rating")
    )


def goods_catalog(goods: DataFrame, users: DataFrame, categories: DataFrame) -> DataFrame:
    """Each good with the names of its merchant and its category."""
    return (
        goods.withColumnRenamed("name", "product_name")
        .join(_named(users, "user_id", "merch_id", "merchant_name"), "merch_id")
        .join(_named(categories, "caty_id", "caty_id", "category_name"), "caty_id")
        .select("good_id", "product_name", "merchant_name", "category_name")
    )


def order_categories(orders: DataFrame, goods: DataFrame, categories: DataFrame) -> DataFrame:
    named = goods.select("good_id", F.col("name").alias("product_name"), "caty_id").join(
        _named(categories, "caty_id", "caty_id", "category_name"), "caty_id"
    )
    return orders.join(named, "good_id").select(F.col("id").alias("order_id"), "product_name", "category_name")


def order_parties(orders: DataFrame, users: DataFrame, goods: DataFrame) -> DataFrame:
    """Customer, good and merchant of each order: ``users`` joined twice.

    The two small tables meet first, so the large one is joined once per key.
    """
    sold = goods.select("good_id", F.col("name").alias("product_name"), "merch_id").join(
        _named(users, "user_id", "merch_id", "merchant_name"), "merch_id"
    )
    return (
        orders.join(sold, "good_id")
        .join(_named(users, "user_id", "user_id", "customer_name"), "user_id")
        .select(F.col("id").alias("order_id"), "customer_name", "product_name", "merchant_name")
    )


def review_parties(
    reviews: DataFrame, users: DataFrame, goods: DataFrame, categories: DataFrame
) -> DataFrame:
    catalog = goods_catalog(goods, users, categories)
    return (
        reviews.join(catalog, "good_id")
        .join(_named(users, "user_id", "user_id", "customer_name"), "user_id")
        .select(
            F.col("id").alias("review_id"),
            "customer_name",
            "product_name",
            "merchant_name",
            "category_name",
            "rating",
            "comment",
        )
    )


def order_facts(
    orders: DataFrame, users: DataFrame, goods: DataFrame, categories: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Wide fact: one row per order with all names, and the buyer's rating.

    ``has_review`` is 1 when this user reviewed this good; ``rating`` is 0 then
    only if the review carries none.
    """
    names = (
        goods.withColumnRenamed("name", "good_name")
        .join(_named(users, "user_id", "merch_id", "merchant_name"), "merch_id")
        .join(_named(categories, "caty_id", "caty_id", "category_name"), "caty_id")
    )
    rated = reviews.select("user_id", "good_id", "rating", F.lit(1).alias("seen"))
    return (
        orders.join(names, "good_id")
        .join(rated, ["user_id", "good_id"], "left")
        .select(
            F.col("id").alias("order_id"),
            "user_id",
            F.col("merch_id").alias("merchant_id"),
            "good_id",
            F.col("caty_id").alias("category_id"),
            "category_name",
            "merchant_name",
            "good_name",
            F.coalesce("rating", F.lit(0)).alias("rating"),
            F.coalesce("seen", F.lit(0)).alias("has_review"),
            F.to_date("order_ts").alias("order_date"),
            F.col("order_ts").alias("order_timestamp"),
        )
    )


def having(df: DataFrame, other: DataFrame, on: str | list[str], where: Column | None = None) -> DataFrame:
    """Rows of ``df`` with a partner in ``other`` (EXISTS / IN)."""
    return df.join(other if where is None else other.where(where), on, "left_semi")


def lacking(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` without a partner (NOT EXISTS; NULL keys never match)."""
    return df.join(other, on, "left_anti")


def with_scalar(df: DataFrame, source: DataFrame, value: Column, name: str) -> DataFrame:
    """Add one number computed from ``source`` to every row.

    A scalar subquery: computed once and put in as a literal, so there is no
    Cartesian step in the plan.
    """
    return df.withColumn(name, source.select(value).scalar())


def optional_edges(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Every node with its edges, or one row of NULLs (OPTIONAL MATCH)."""
    return nodes.join(edges, key, "left")


def review_orders(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Each review with the order it belongs to, exactly one row per review.

    A good bought twice would repeat the review, so the latest order up to the
    review is taken (ties: larger id); ``order_id`` 0 when there is none.  The
    review key (user, good) is unique, so the join never fans out beyond the
    orders.  The two folds use plain columns, which keeps both hash-based.
    """
    candidates = orders.select("user_id", "good_id", F.col("id").alias("order_id"), "order_ts")
    matched = (
        reviews.select("user_id", "good_id", "id", "review_ts")
        .join(candidates, ["user_id", "good_id"])
        .where(F.col("order_ts") <= F.col("review_ts"))
        .groupBy("id", "order_ts")
        .agg(F.max("order_id").alias("order_id"))
        .groupBy("id")
        .agg(F.max_by("order_id", "order_ts").alias("order_id"))
    )
    return reviews.join(matched, "id", "left").withColumn("order_id", F.coalesce("order_id", F.lit(0)))


def numbered_pool(pool: DataFrame, member: str) -> tuple[DataFrame, Column]:
    """Members numbered 1..n in their order, and n: what ``assign_from`` hands out."""
    numbered = row_index(pool.select(member), [], [member], number="_slot")
    return numbered, pool.select(F.count(F.lit(1))).scalar()


def assign_from(keys: DataFrame, key: str, numbered: DataFrame, size: Column, seed: int = 0) -> DataFrame:
    """Give every key one member of a numbered pool by hash of the key.

    The pool is joined on the computed number: an equi join on an expression,
    so it stays a hash join at any size.
    """
    return keys.withColumn("_slot", pick(key, size, seed) + 1).join(numbered, "_slot").drop("_slot")


def assign_by_hash(keys: DataFrame, key: str, pool: DataFrame, member: str, seed: int = 0) -> DataFrame:
    """Give every key one member of ``pool`` by hash of the key."""
    return assign_from(keys, key, *numbered_pool(pool, member), seed)
