"""Aggregation reports.

Reports over two child tables (orders and reviews of the same user or good)
never join the children to each other.  Each child is first folded to one row
per key, then joined: two hash aggregates instead of orders x reviews rows per
key, and a hot key is one row before any join sees it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.dialect import nulls_first, nulls_last, ratio_half_even, ratio_half_up, top_k
from tradeloom.operators.joins import customers, merchants
from tradeloom.plans.ordered import top_per_group


# -- folds: one row per key ---------------------------------------------------

def order_totals(orders: DataFrame, *keys: str) -> DataFrame:
    return orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_orders"))


def review_totals(reviews: DataFrame, *keys: str) -> DataFrame:
    """Count, rating sum and number of ratings (a review may lack a rating)."""
    return reviews.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("n_ratings"),
    )


def _zero(*names: str) -> list[Column]:
    return [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]


def goods_activity(goods: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per good: orders, reviews, rating sum and count."""
    return (
        goods.join(order_totals(orders, "good_id"), "good_id", "left")
        .join(review_totals(reviews, "good_id"), "good_id", "left")
        .select(*goods.columns, *_zero("n_orders", "n_reviews", "rating_sum", "n_ratings"))
    )


# -- relational reports ---------------------------------------------------------

def merchant_stats(users: DataFrame, goods: DataFrame, reviews: DataFrame, k: int | None = 10) -> DataFrame:
    """Merchants with goods: number of goods, average rating, reviews."""
    per_merchant = (
        goods.select("good_id", F.col("merch_id").alias("user_id"))
        .join(review_totals(reviews, "good_id"), "good_id", "left")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_products"),
            F.coalesce(F.sum("n_reviews"), F.lit(0)).alias("total_reviews"),
            F.coalesce(F.sum("rating_sum"), F.lit(0)).alias("_sum"),
            F.coalesce(F.sum("n_ratings"), F.lit(0)).alias("_n"),
        )
    )
    report = merchants(users).join(per_merchant, "user_id").select(
        "user_id",
        F.col("name").alias("merchant_name"),
        "total_products",
        ratio_half_up("_sum", "_n").alias("avg_rating"),
        "total_reviews",
    )
    return top_k(report, [nulls_first("total_products"), nulls_first("avg_rating"), F.col("user_id")], k)


def category_stats(
    categories: DataFrame, goods: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Every category with its goods, orders and reviews, zeros included."""
    per_category = (
        goods_activity(goods.select("good_id", "caty_id"), orders, reviews)
        .groupBy("caty_id")
        .agg(
            F.count(F.lit(1)).alias("total_products"),
            F.sum("n_orders").alias("total_orders"),
            F.sum("n_reviews").alias("total_reviews"),
        )
    )
    return categories.join(per_category, "caty_id", "left").select(
        "caty_id", F.col("name").alias("category_name"), *_zero("total_products", "total_orders", "total_reviews")
    )


def customer_stats(users: DataFrame, orders: DataFrame, reviews: DataFrame, k: int | None = 10) -> DataFrame:
    """Customers with orders: orders, reviews and the average rating they give."""
    report = (
        customers(users)
        .join(order_totals(orders, "user_id"), "user_id")
        .join(review_totals(reviews, "user_id"), "user_id", "left")
        .select(
            "user_id",
            F.col("name").alias("customer_name"),
            F.col("n_orders").alias("total_orders"),
            F.coalesce("n_reviews", F.lit(0)).alias("total_reviews"),
            ratio_half_up("rating_sum", "n_ratings").alias("avg_rating_given"),
        )
    )
    return top_k(report, [nulls_first("total_orders"), F.col("user_id")], k)


def goods_popularity(
    goods: DataFrame, users: DataFrame, orders: DataFrame, reviews: DataFrame, k: int | None = 10
) -> DataFrame:
    """Ordered goods with orders, reviews, rating and merchant."""
    names = users.select(F.col("user_id").alias("merch_id"), F.col("name").alias("merchant_name"))
    report = (
        goods.join(order_totals(orders, "good_id"), "good_id")
        .join(review_totals(reviews, "good_id"), "good_id", "left")
        .join(names, "merch_id", "left")
        .select(
            "good_id",
            F.col("name").alias("product_name"),
            F.col("n_orders").alias("times_ordered"),
            F.coalesce("n_reviews", F.lit(0)).alias("total_reviews"),
            ratio_half_up("rating_sum", "n_ratings").alias("avg_rating"),
            "merchant_name",
        )
    )
    return top_k(report, [nulls_first("times_ordered"), nulls_first("avg_rating"), F.col("good_id")], k)


def customer_activity(
    users: DataFrame, goods: DataFrame, orders: DataFrame, reviews: DataFrame, k: int | None = 10
) -> DataFrame:
    """Customers with orders: orders, reviews and how many different goods.

    Orders are folded to (user, good) first; the same small table then gives
    both the order count and the count of different goods.
    """
    pairs = order_totals(orders, "user_id", "good_id")
    known = pairs.join(goods.select("good_id", F.lit(1).alias("known")), "good_id", "left")
    bought = known.groupBy("user_id").agg(
        F.sum("n_orders").alias("total_orders"), F.count("known").alias("unique_products_bought")
    )
    report = (
        customers(users)
        .join(bought, "user_id")
        .join(review_totals(reviews, "user_id"), "user_id", "left")
        .select(
            "user_id",
            F.col("name").alias("customer_name"),
            "total_orders",
            F.coalesce("n_reviews", F.lit(0)).alias("total_reviews"),
            "unique_products_bought",
        )
    )
    return top_k(report, [nulls_first("total_orders"), F.col("user_id")], k)


def goods_per_category(goods: DataFrame, categories: DataFrame, at_least: int = 0, k: int | None = None) -> DataFrame:
    counts = goods.groupBy("caty_id").agg(F.count(F.lit(1)).alias("product_count"))
    report = categories.join(counts, "caty_id", "left").select(
        "caty_id", F.col("name").alias("category"), *_zero("product_count")
    )
    return top_k(report.where(F.col("product_count") >= at_least), [nulls_first("product_count"), F.col("caty_id")], k)


def top_categories(products: DataFrame, k: int | None = 10) -> DataFrame:
    """Document form: categories by number of products."""
    report = products.groupBy(F.col("category_name").alias("category")).agg(F.count(F.lit(1)).alias("count"))
    return top_k(report, [nulls_last("count"), F.col("category")], k)


def good_ratings(reviews: DataFrame, at_least: int = 1, k: int | None = None) -> DataFrame:
    """Average rating (half to even) and count per reviewed good."""
    report = (
        review_totals(reviews, "good_id")
        .where(F.col("n_reviews") >= at_least)
        .select(
            F.col("good_id").alias("product_id"),
            ratio_half_even("rating_sum", "n_ratings").alias("avg_rating"),
            F.col("n_reviews").alias("count"),
        )
    )
    return top_k(report, [nulls_last("avg_rating"), F.col("product_id")], k)


def good_rating(goods: DataFrame, reviews: DataFrame, good_id: int) -> DataFrame:
    """Rating of one good; the key filter reaches both scans before the join."""
    one = goods.where(F.col("good_id") == good_id)
    return one.join(review_totals(reviews.where(F.col("good_id") == good_id), "good_id"), "good_id", "left").select(
        "good_id",
        F.col("name").alias("product_name"),
        F.coalesce("n_reviews", F.lit(0)).alias("review_count"),
        ratio_half_up("rating_sum", "n_ratings").alias("avg_rating"),
    )


def top_merchants(products: DataFrame, category_id: int | None = None, k: int | None = 10) -> DataFrame:
    """Document form: merchants by number of products, all or in one category."""
    if category_id is not None:
        products = products.where(F.col("category_id") == category_id)
    # Names are grouped first: a minimum over text needs a sort, and this way it
    # runs over one row per merchant and name only.
    named = products.groupBy("merchant_id", "merchant_name").agg(F.count(F.lit(1)).alias("_n"))
    report = named.groupBy("merchant_id").agg(
        F.min("merchant_name").alias("merchant_name"), F.sum("_n").alias("count")
    )
    return top_k(report, [nulls_last("count"), F.col("merchant_id")], k)


def merchants_with_goods(goods: DataFrame, at_least: int = 3) -> DataFrame:
    counts = goods.groupBy("merch_id").agg(
        F.count(F.lit(1)).alias("product_count"), F.countDistinct("caty_id").alias("category_count")
    )
    return counts.where(F.col("product_count") >= at_least)


def rating_by_category(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """How often each rating was given in each category.

    Reviews are folded to (good, rating) before the lookup; a review of an
    unknown good keeps category NULL.
    """
    folded = reviews.groupBy("good_id", "rating").agg(F.count(F.lit(1)).alias("_n"))
    names = products.select("good_id", F.col("category_name").alias("category"))
    return folded.join(names, "good_id", "left").groupBy("category", "rating").agg(F.sum("_n").alias("count"))


def rating_histogram(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("count_reviews"))


# -- graph-style aggregates -----------------------------------------------------

def users_by_type(users: DataFrame, sold_by: DataFrame) -> DataFrame:
    """Users of each type with their incoming and outgoing SOLD_BY edges."""
    incoming = sold_by.groupBy(F.col("user_id")).agg(F.count(F.lit(1)).alias("_in"))
    return (
        users.join(incoming, "user_id", "left")
        .groupBy("user_type")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.coalesce(F.sum("_in"), F.lit(0)).alias("incoming_sold_by"),
        )
        .withColumn("outgoing_sold_by", F.lit(0).cast("bigint"))
    )


def label_counts(**tables: DataFrame) -> DataFrame:
    """Row count per label (nodes or edge types), as one table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(label).alias("label"), "count")
        for label, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def census(**tables: DataFrame) -> DataFrame:
    """All row counts in one row, each a scalar subquery."""
    (first, df), *rest = tables.items()
    row = df.agg(F.count(F.lit(1)).alias(first))
    for name, other in rest:
        row = row.withColumn(name, other.select(F.count(F.lit(1))).scalar())
    return row


def average_goods_per_merchant(users: DataFrame, goods: DataFrame) -> DataFrame:
    counts = (
        merchants(users)
        .join(goods.groupBy(F.col("merch_id").alias("user_id")).agg(F.count(F.lit(1)).alias("product_count")), "user_id")
        .select("user_id", F.col("name").alias("merchant"), "product_count")
    )
    return counts.agg(
        ratio_half_up(F.sum("product_count"), F.count(F.lit(1)), 4).alias("avg_products_per_merchant")
    )


def sample_merchants(users: DataFrame, goods: DataFrame, k: int = 5) -> DataFrame:
    """The sample list shown next to the average: ``k`` merchants with counts."""
    counts = goods.groupBy(F.col("merch_id").alias("user_id")).agg(F.count(F.lit(1)).alias("product_count"))
    named = merchants(users).join(counts, "user_id").select("user_id", F.col("name").alias("merchant"), "product_count")
    return named.orderBy("user_id").limit(k)


def category_samples(goods: DataFrame, categories: DataFrame, names: int = 10, k: int | None = 5) -> DataFrame:
    """Categories by size, each with its first good names.

    Only ``names`` rows per category survive the map side, so the list is
    short however large the category is.
    """
    counts = goods.groupBy("caty_id").agg(F.count(F.lit(1)).alias("total_products"))
    first = top_per_group(goods.select("caty_id", "good_id", "name"), ["caty_id"], ["good_id"], names)
    lists = first.groupBy("caty_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("good_id", "name"))), lambda g: g["name"]).alias("products")
    )
    report = (
        counts.join(lists, "caty_id")
        .join(categories.withColumnRenamed("name", "category"), "caty_id")
        .select("caty_id", "category", "products", "total_products")
    )
    return top_k(report, [nulls_first("total_products"), F.col("caty_id")], k)


def purchases_by_category(bought: DataFrame, goods: DataFrame) -> DataFrame:
    """Units each user bought in each category."""
    return (
        bought.join(goods.select("good_id", "caty_id"), "good_id")
        .groupBy("user_id", "caty_id")
        .agg(F.sum("cnt").alias("total"))
    )


def buyer_totals(bought: DataFrame, more_than: int = 0, k: int | None = None) -> DataFrame:
    totals = bought.groupBy("user_id").agg(F.sum("cnt").alias("total")).where(F.col("total") > more_than)
    return top_k(totals, [nulls_first("total"), F.col("user_id")], k)


def merchant_chain(
    users: DataFrame, goods: DataFrame, categories: DataFrame, more_than: int = 1, k: int | None = 15
) -> DataFrame:
    """Merchant, number of goods and categories, and goods per category.

    The list holds one entry per category, so its length is bounded by the
    number of categories and not by the goods.
    """
    named = categories.where(F.col("name").isNotNull() & (F.trim("name") != ""))
    per_pair = (
        goods.groupBy(F.col("merch_id").alias("user_id"), "caty_id")
        .agg(F.count(F.lit(1)).alias("products"))
        .join(named.withColumnRenamed("name", "category"), "caty_id")
    )
    per_merchant = per_pair.groupBy("user_id").agg(
        F.sum("products").alias("total_products"),
        F.count(F.lit(1)).alias("categories_count"),
        F.sort_array(F.collect_list(F.struct("category", "products"))).alias("by_category"),
    )
    report = (
        merchants(users)
        .join(per_merchant.where(F.col("total_products") > more_than), "user_id")
        .select("user_id", F.col("name").alias("merchant_name"), "total_products", "categories_count", "by_category")
    )
    order = [nulls_first("total_products"), nulls_first("categories_count"), F.col("user_id")]
    return top_k(report, order, k)


def category_ratings(goods: DataFrame, categories: DataFrame, reviews: DataFrame) -> DataFrame:
    totals = (
        goods.select("good_id", "caty_id")
        .join(review_totals(reviews, "good_id"), "good_id")
        .groupBy("caty_id")
        .agg(F.sum("rating_sum").alias("_s"), F.sum("n_ratings").alias("_n"), F.sum("n_reviews").alias("review_count"))
    )
    return categories.join(totals, "caty_id").select(
        F.col("name").alias("category"), ratio_half_up("_s", "_n", 4).alias("avg_rating"), "review_count"
    )


def merchant_turnover(users: DataFrame, goods: DataFrame, bought: DataFrame, k: int | None = 10) -> DataFrame:
    """Units sold and different goods sold per merchant."""
    per_good = bought.groupBy("good_id").agg(F.sum("cnt").alias("sold"))
    totals = (
        goods.select("good_id", F.col("merch_id").alias("user_id"))
        .join(per_good, "good_id")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("products"), F.sum("sold").alias("sold"))
    )
    report = merchants(users).join(totals, "user_id").select(
        "user_id", F.col("name").alias("merchant_name"), "products", "sold"
    )
    return top_k(report, [nulls_first("sold"), F.col("user_id")], k)


def segment(total: Column | str) -> Column:
    """Buying segment by number of purchases."""
    total = F.col(total) if isinstance(total, str) else total
    return F.when(total <= 2, "low").when(total <= 5, "medium").otherwise("high")


def customer_segments(users: DataFrame, bought: DataFrame) -> DataFrame:
    totals = customers(users).join(buyer_totals(bought), "user_id")
    return totals.groupBy(segment("total").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))


def shared_goods(offers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Goods offered by several sellers: one row per (good, seller) with the
    seller count.  Rows instead of one list per good, so a good everybody
    sells is never gathered in one place."""
    pairs = offers.select("good_id", "seller_id").distinct()
    counts = pairs.groupBy("good_id").agg(F.count(F.lit(1)).alias("seller_count")).where(F.col("seller_count") > 1)
    return (
        pairs.join(counts, "good_id")
        .join(sellers, "seller_id")
        .select("good_id", "seller_id", "seller_name", "seller_count")
    )


def rating_extent(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.sum("rating").alias("rating_sum"),
        ratio_half_up(F.sum("rating"), F.count("rating")).alias("avg_rating"),
    )


def distinct_pairs(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Number of different (customer, good) pairs."""
    buyers = customers(users).select("user_id")
    pairs = orders.select("user_id", "good_id").distinct().join(buyers, "user_id", "left_semi")
    return pairs.agg(F.count(F.lit(1)).alias("unique_user_good_pairs"))


def approximate_visitors(events: DataFrame) -> DataFrame:
    """Distinct users per event type from a mergeable sketch."""
    sketch = F.hll_sketch_agg("user_id", 14)
    return events.groupBy("event_type").agg(F.hll_sketch_estimate(sketch).alias("approx_users"))


def bitmap_visitors(events: DataFrame) -> DataFrame:
    """Exact distinct users per event type from bitmaps.

    Ids are cut into fixed-size bitmaps; two small aggregations replace the
    set of ids, and a hot type is spread over its bitmap numbers.
    """
    bits = events.groupBy("event_type", F.bitmap_bucket_number("user_id").alias("_bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("user_id"))).alias("_ones")
    )
    return bits.groupBy("event_type").agg(F.sum("_ones").alias("distinct_users"))


def purchase_edges(orders: DataFrame) -> DataFrame:
    """Orders folded to one (user, good) edge with its count."""
    return orders.groupBy("user_id", "good_id").agg(F.count(F.lit(1)).alias("cnt"))


def event_counts(events: DataFrame, k: int | None = 5) -> DataFrame:
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, [nulls_last("n"), F.col("event_type")], k)


def customer_spend(users: DataFrame, orders: DataFrame, k: int | None = 10) -> DataFrame:
    spend = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("order_count"), F.sum("price").alias("total_spent"))
    report = users.join(spend, "user_id").select("user_id", "name", "order_count", "total_spent")
    return top_k(report, [nulls_first("order_count"), F.col("user_id")], k)


def tag_counts(products: DataFrame) -> DataFrame:
    return products.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("count"))


def merchant_categories(goods: DataFrame, users: DataFrame, categories: DataFrame) -> DataFrame:
    """Goods per (merchant, category) with both names."""
    counts = goods.groupBy("merch_id", "caty_id").agg(F.count(F.lit(1)).alias("product_count"))
    return (
        counts.join(merchants(users).select(F.col("user_id").alias("merch_id"), F.col("name").alias("merchant")), "merch_id")
        .join(categories.select("caty_id", F.col("name").alias("category")), "caty_id")
        .select("merch_id", "merchant", "category", "product_count")
    )


def merchant_category_matrix(goods: DataFrame, categories: list[int]) -> DataFrame:
    """The same counts with one column per given category."""
    wide = goods.groupBy("merch_id").pivot("caty_id", categories).agg(F.count(F.lit(1)))
    return wide.select("merch_id", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"category_{c}") for c in categories])


def leaderboard(scores: DataFrame, member: str, score: str) -> DataFrame:
    """Sorted set: scores added up per member, highest rank 1, ties by member."""
    from tradeloom.plans.ordered import row_index

    totals = scores.groupBy(member).agg(F.sum(score).alias("score"))
    return row_index(totals, [], [F.col("score").desc_nulls_last(), F.col(member)], number="position")


def score_range(board: DataFrame, low, high) -> DataFrame:
    return board.where(F.col("score").between(F.lit(low), F.lit(high)))
