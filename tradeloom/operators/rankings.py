"""Reports with positions, ranks and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.functions.dialect import nulls_first, percent_half_up, ratio_half_up, top_k
from tradeloom.functions.hashing import mix
from tradeloom.operators.joins import customers, merchants
from tradeloom.plans.ordered import rank_by_value, row_index, sliding_frame


def merchant_ranks(users: DataFrame, goods: DataFrame, k: int | None = 10) -> DataFrame:
    """RANK and DENSE_RANK of merchants by number of goods."""
    counts = goods.groupBy(F.col("merch_id").alias("user_id")).agg(F.count(F.lit(1)).alias("product_count"))
    all_merchants = (
        merchants(users)
        .join(counts, "user_id", "left")
        .select(
            "user_id",
            F.col("name").alias("merchant_name"),
            F.coalesce("product_count", F.lit(0)).alias("product_count"),
        )
    )
    ranked = rank_by_value(all_merchants, [], "product_count", "rank_by_products", "dense_rank_products")
    return top_k(ranked, [nulls_first("product_count"), F.col("user_id")], k)


def goods_rank_in_category(
    goods: DataFrame, categories: DataFrame, orders: DataFrame, k: int | None = None
) -> DataFrame:
    """Ordered goods with their RANK by orders inside the category."""
    counts = orders.groupBy("good_id").agg(F.count(F.lit(1)).alias("order_count"))
    counted = goods.select("good_id", F.col("name").alias("product_name"), "caty_id").join(counts, "good_id")
    ranked = rank_by_value(counted, ["caty_id"], "order_count", "rank_in_category")
    report = ranked.join(categories.select("caty_id", F.col("name").alias("category_name")), "caty_id").select(
        "good_id", "product_name", "category_name", "order_count", "rank_in_category"
    )
    return top_k(report, [F.col("category_name"), nulls_first("order_count"), F.col("good_id")], k)


def order_sequence(users: DataFrame, orders: DataFrame, split: bool = True) -> DataFrame:
    """Orders numbered per customer, with the customer's order count.

    Position and count come from the same partitioning: one exchange.
    """
    owned = orders.select("user_id", F.col("id").alias("order_id"))
    numbered = row_index(owned, ["user_id"], ["order_id"], "order_sequence", "total_orders_per_customer", split)
    names = customers(users).select("user_id", F.col("name").alias("customer_name"))
    return numbered.join(names, "user_id").select(
        "user_id", "customer_name", "order_id", "total_orders_per_customer", "order_sequence"
    )


def moving_ratings(goods: DataFrame, reviews: DataFrame, rows: int = 3, split: bool = True) -> DataFrame:
    """Average of a good's last ``rows`` ratings, in review order."""
    rated = reviews.select("good_id", F.col("id").alias("review_id"), "rating")
    placed = row_index(rated, ["good_id"], ["review_id"], "_pos", split=split)
    framed = sliding_frame(
        placed, ["good_id"], "_pos", rows - 1, {"_s": F.sum("rating"), "_n": F.count("rating")}
    )
    names = goods.select("good_id", F.col("name").alias("product_name"))
    return framed.join(names, "good_id").select(
        "good_id", "product_name", "review_id", "rating", ratio_half_up("_s", "_n", 4).alias("moving_avg_rating")
    )


def category_share(categories: DataFrame, goods: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per category and their share of all orders.

    The total is a scalar subquery over the one row per category, so no row of
    the report waits for all others in one task.
    """
    per_good = orders.groupBy("good_id").agg(F.count(F.lit(1)).alias("_n"))
    per_category = (
        goods.select("good_id", "caty_id").join(per_good, "good_id").groupBy("caty_id").agg(F.sum("_n").alias("_n"))
    )
    counts = categories.join(per_category, "caty_id", "left").select(
        "caty_id", F.col("name").alias("category_name"), F.coalesce("_n", F.lit(0)).alias("order_count")
    )
    everything = counts.select(F.sum("order_count")).scalar()
    return counts.select(
        "*", percent_half_up("order_count", F.nullif(everything, F.lit(0))).alias("percentage_of_total_orders")
    )


def shuffled(df: DataFrame, key: str, seed: int = 0, number: str = "rn", total: str = "total") -> DataFrame:
    """Rows in a seeded random order, numbered, with the row count."""
    return row_index(
        df.withColumn("_draw", mix(key, seed)), [], ["_draw", key], number=number, total=total
    ).drop("_draw")


def enumerated(df: DataFrame, key: str, number: str = "rn") -> DataFrame:
    """Rows numbered 1..n by key."""
    return row_index(df, [], [key], number=number)


def counter_rate(
    samples: DataFrame, series: list[str], at_ms: str, value: str, range_ms: int = 300_000
) -> DataFrame:
    """Per-second increase of a counter over the last ``range_ms``, at each sample.

    A drop in value is a restart, so the new value counts in full.  The
    increase is extended to the edges of the range as far as the sample spacing
    supports it.  Every sample also goes to the next time slice, which gives
    each slice its whole lookback and keeps a busy series spread over slices.
    A series has at most one sample per millisecond; samples at one time are
    taken in the order of their values.
    """
    slice_no = F.floor(F.col(at_ms) / range_ms)
    placed = samples.select("*", F.explode(F.array(slice_no, slice_no + 1)).alias("_slice"))
    own = F.col("_slice") == slice_no
    per_slice = W.partitionBy(*series, "_slice")
    ordered = per_slice.orderBy(at_ms, value)
    stepped = placed.withColumn("_prev", F.lag(value).over(ordered)).withColumn(
        "_step",
        F.when(F.col("_prev").isNull(), 0.0)
        .when(F.col(value) < F.col("_prev"), F.col(value))
        .otherwise(F.col(value) - F.col("_prev"))
        .cast("double"),
    )
    # Running sum and count, so that only the first sample of the range has to
    # be looked up; everything in between is a difference.
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = stepped.withColumn("_sum", F.sum("_step").over(so_far)).withColumn("_no", F.row_number().over(ordered))
    opening = F.struct("_sum", "_no", F.col(value).cast("double").alias("_value"), F.col(at_ms).alias("_at"))
    opened = summed.withColumn("_own_first", F.first(F.when(own, opening), ignorenulls=True).over(so_far))
    # A frame that slides is folded anew at each of its rows.  Instead the
    # earlier slice's samples are put at the last time whose range still holds
    # them; read backwards, the newest one met is the first of the range.
    last_held = F.when(own, F.col(at_ms)).otherwise(F.col(at_ms) + (range_ms - 1))
    backwards = per_slice.orderBy(last_held.desc(), own, F.col("_no").desc())
    held = F.last(F.when(~own, opening), ignorenulls=True).over(
        backwards.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    seen = opened.withColumn("_first", F.coalesce(held, "_own_first")).where(own)
    increase = F.col("_sum") - F.col("_first._sum")
    sampled = (F.col(at_ms) - F.col("_first._at")) / 1000.0
    count = F.col("_no") - F.col("_first._no") + 1
    return seen.select(
        *series,
        at_ms,
        _extended_rate(increase, sampled, count, F.col("_first._value"), range_ms / 1000.0).alias("rate"),
    )


def _extended_rate(increase: Column, sampled: Column, n: Column, first: Column, seconds: float) -> Column:
    spacing = F.try_divide(sampled, n - 1)
    lead = F.lit(seconds) - sampled
    lead = F.when(lead >= spacing * 1.1, spacing / 2).otherwise(lead)
    to_zero = sampled * F.try_divide(first, increase)
    lead = F.when((increase > 0) & (first >= 0) & (to_zero < lead), to_zero).otherwise(lead)
    return F.when(n > 1, increase * F.try_divide(sampled + lead, sampled) / seconds)
