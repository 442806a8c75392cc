"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line.  Each query is written to the no-op sink, so every row
and column is computed; one warm-up run, then the best of ``$BENCH_RUNS``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tradeloom.catalog import REGISTRY
from tradeloom.session import build_session

HEADLINE = [
    "merchant_stats",
    "category_stats",
    "customer_stats",
    "goods_popularity",
    "customer_activity",
    "order_parties",
    "order_facts",
    "merchant_ranks",
    "goods_rank_in_category",
    "order_sequence",
    "moving_ratings",
    "category_share",
    "products_with_reviews",
    "rating_by_category",
    "category_daily_stats",
    "merchant_daily_stats",
    "repeat_customers",
    "merchant_chain",
    "common_neighbours",
    "similar_merchants",
    "also_bought",
    "bought_together",
    "cross_sell",
    "windowed_counts",
    "late_events",
    "counter_rates",
    "merged_users",
    "generated_orders",
    "similar_merchants_many",
    "review_orders",
    "cascade_after_customer_delete",
    "streamed_windowed_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        best = None
        for attempt in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt and (best is None or took < best):
                best = took
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


def fan_out_customer_stats(users, orders, reviews):
    """``customer_stats`` as a product of orders and reviews, which the folded form is measured against."""
    from pyspark.sql import functions as F

    from tradeloom.functions.dialect import ratio_half_up
    from tradeloom.operators.joins import customers

    joined = (
        customers(users)
        .join(orders.select("user_id", F.col("id").alias("oid")), "user_id", "left")
        .join(reviews.select("user_id", F.col("id").alias("rid"), "rating"), "user_id", "left")
    )
    return (
        joined.groupBy("user_id", F.col("name").alias("customer_name"))
        .agg(
            F.countDistinct("oid").alias("total_orders"),
            F.countDistinct("rid").alias("total_reviews"),
            ratio_half_up(F.sum("rating"), F.count("rating")).alias("avg_rating_given"),
        )
        .where(F.col("total_orders") > 0)
    )


def compare() -> None:
    """Spark against itself: the plans chosen here and the plain ones."""
    from pyspark.sql import functions as F

    from tradeloom.operators import graph, reports, rollups
    from tradeloom.plans.staging import stage
    from tradeloom.sources.market import Market
    from tradeloom.streaming.jobs import rollup_tables
    from tradeloom.plans.staging import new_folder

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    m = Market(spark, folder)
    orders, reviews, goods = stage(m.orders), stage(m.reviews), stage(m.goods)

    def timed(run, times=3):
        best = None
        for _ in range(times + 1):
            start = time.perf_counter()
            run()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        return round(best, 3)

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    def all_pairs():
        ends = goods.select("good_id", F.col("caty_id").alias("n")).unionByName(
            goods.select("good_id", F.col("merch_id").alias("n"))
        )
        a, b = ends.select(F.col("good_id").alias("good1"), "n"), ends.select(F.col("good_id").alias("good2"), "n")
        pairs = a.join(b, "n").where("good1 < good2").groupBy("good1", "good2").count()
        drain(pairs.orderBy(F.desc("count"), "good1", "good2").limit(20))

    order_events = stage(rollups.order_events(orders, goods))
    review_events = stage(rollups.review_events(reviews, goods, orders))
    keys = rollups.ROLLUP_KEYS["category"]
    deltas = rollups.order_deltas(order_events).unionByName(rollups.review_deltas(review_events))
    table = rollup_tables(spark, new_folder(spark, "compare"))["category"]
    table.add(rollups.fold(deltas, keys), rollups.COUNTERS, 0)
    late = deltas.where(F.col("date") >= F.lit("2001-07-01").cast("date"))
    batch = iter(range(1, 100))
    print(json.dumps({
        "customer_stats_folded": timed(lambda: drain(reports.customer_stats(m.users, orders, reviews, k=None))),
        "customer_stats_fan_out": timed(lambda: drain(fan_out_customer_stats(m.users, orders, reviews))),
        "common_neighbours_guarded": timed(lambda: drain(graph.common_neighbours(goods, 20))),
        "common_neighbours_all_pairs": timed(all_pairs, 1),
        "category_rollup_recomputed": timed(lambda: drain(rollups.rollup(order_events, review_events, "category"))),
        "category_rollup_one_month_added": timed(lambda: table.add(rollups.fold(late, keys), rollups.COUNTERS, next(batch))),
    }))
    spark.stop()


if __name__ == "__main__":
    compare() if sys.argv[1:] == ["--compare"] else main()
