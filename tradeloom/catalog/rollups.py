"""Event facts, rollups and dashboards on the marketplace tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.base import check_sql, half_even_sql, query
from tradeloom.operators import rollups
from tradeloom.plans.staging import new_folder
from tradeloom.sources.market import Market
from tradeloom.sources.tables import write_fact
from tradeloom.streaming.jobs import maintain_rollups, rollup_tables

AS_OF = "2001-08-01"


def _events(m: Market):
    return rollups.order_events(m.orders, m.goods), rollups.review_events(m.reviews, m.goods, m.orders)


def _rollup(m: Market, kind: str):
    # The order behind a review is no part of any rollup; its join is pruned.
    return rollups.rollup(*_events(m), kind)


def _rollup_sql(keys: str, order_keys: str, review_keys: str) -> str:
    return f"""
      SELECT {keys}, CAST(sum(o) AS BIGINT) AS orders_count, CAST(sum(v) AS BIGINT) AS reviewed_count,
             CAST(sum(s) AS BIGINT) AS rating_sum, CAST(sum(n) AS BIGINT) AS review_count
      FROM (SELECT {order_keys}, 1 AS o, 0 AS v, 0 AS s, 0 AS n FROM order_events
            UNION ALL SELECT {review_keys}, 0, 1, rating, 1 FROM review_events) GROUP BY ALL"""


_DAY_O, _DAY_R = "strftime(order_ts, '%Y-%m-%d') AS date", "strftime(review_ts, '%Y-%m-%d') AS date"
_CATEGORY = _rollup_sql("date, category_id", f"{_DAY_O}, category_id", f"{_DAY_R}, category_id")
_MERCHANT = _rollup_sql("date, merchant_id", f"{_DAY_O}, merchant_id", f"{_DAY_R}, merchant_id")
_PRODUCT = _rollup_sql(*["good_id, category_id, merchant_id"] * 3)
_USES = "order_events review_events"


def _dated(df):
    return df.withColumn("date", F.col("date").cast("string"))


@query(
    "order_events",
    "A12 F10",
    check_sql(
        "order_events",
        """SELECT order_id, user_id, merchant_id, good_id, category_id, strftime(order_ts, '%Y%m') AS month,
                  CAST(price AS DOUBLE) AS price FROM order_events""",
    ),
)
def _(m: Market):
    return rollups.order_events(m.orders, m.goods).select(
        "order_id", "user_id", "merchant_id", "good_id", "category_id",
        F.date_format("order_ts", "yyyyMM").alias("month"), F.col("price").cast("double").alias("price"),
    )


@query("category_daily_stats", "A12", check_sql(_USES, _CATEGORY))
def _(m: Market):
    return _dated(_rollup(m, "category"))


@query("merchant_daily_stats", "A12", check_sql(_USES, _MERCHANT))
def _(m: Market):
    return _dated(_rollup(m, "merchant"))


@query("product_stats", "A12", check_sql(_USES, _PRODUCT))
def _(m: Market):
    return _rollup(m, "product")


@query(
    "sales_summary",
    "A11",
    check_sql(
        "order_events",
        f"""SELECT count(*) AS total_orders, CAST(sum(price) AS DOUBLE) AS total_revenue,
                   round(CAST(sum(price) AS DOUBLE) / count(*), 4) AS avg_order_value, count(DISTINCT user_id) AS unique_customers
            FROM order_events WHERE order_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY""",
    ),
)
def _(m: Market):
    summary = rollups.sales_summary(rollups.order_events(m.orders, m.goods), AS_OF)
    return summary.select(
        "total_orders",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        F.round(F.col("avg_order_value").cast("double"), 4).alias("avg_order_value"),
        "unique_customers",
    )


_RECENT = f"WHERE CAST(date AS DATE) >= DATE '{AS_OF}' - INTERVAL 30 DAY"
_RATED = half_even_sql("sum(rating_sum)", "sum(review_count)")
_CATEGORY_REPORT = f"""
  SELECT category_id, CAST(sum(orders_count) AS BIGINT) AS total_orders, CAST(sum(reviewed_count) AS BIGINT) AS total_reviews,
         {_RATED} AS avg_rating,
         round(avg(CASE WHEN review_count > 0 THEN rating_sum / review_count END), 6) AS avg_of_daily_avg
  FROM stats {_RECENT} GROUP BY 1"""


@query(
    "category_report",
    "A13",
    check_sql(_USES, _CATEGORY_REPORT + " ORDER BY total_orders DESC, category_id LIMIT 5", stats=_CATEGORY),
)
def _(m: Market):
    return rollups.category_report(_rollup(m, "category"), AS_OF)


@query("category_report_all", "A13", check_sql(_USES, _CATEGORY_REPORT, stats=_CATEGORY))
def _(m: Market):
    return rollups.category_report(_rollup(m, "category"), AS_OF, k=None)


_PRODUCT_REPORT = f"""
  SELECT good_id, CAST(sum(orders_count) AS BIGINT) AS total_orders, CAST(sum(review_count) AS BIGINT) AS review_count,
         {_RATED} AS avg_rating FROM stats GROUP BY 1 HAVING sum(review_count) > 0"""


@query(
    "product_report",
    "A14",
    check_sql(
        _USES,
        f"SELECT * FROM ({_PRODUCT_REPORT}) ORDER BY total_orders DESC, avg_rating DESC, good_id LIMIT 20",
        stats=_PRODUCT,
    ),
)
def _(m: Market):
    return rollups.product_report(_rollup(m, "product"))


@query("product_report_all", "A14", check_sql(_USES, _PRODUCT_REPORT, stats=_PRODUCT))
def _(m: Market):
    return rollups.product_report(_rollup(m, "product"), k=None)


@query(
    "recent_rating_histogram",
    "A10",
    check_sql(
        "review_events",
        f"""SELECT rating, count(*) AS count_reviews FROM review_events
            WHERE review_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1""",
    ),
)
def _(m: Market):
    return rollups.recent_rating_histogram(_events(m)[1], AS_OF)


_REPEAT = f"""
  SELECT user_id, count(DISTINCT order_id) AS total_orders_per_user, CAST(sum(price) AS DOUBLE) AS total_spent FROM order_events
  WHERE order_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY GROUP BY 1 HAVING count(DISTINCT order_id) > 1"""


@query("repeat_customers", "A15", check_sql("order_events", _REPEAT + " ORDER BY total_spent DESC, user_id LIMIT 50"))
def _(m: Market):
    top = rollups.repeat_customers(rollups.order_events(m.orders, m.goods), AS_OF)
    return top.withColumn("total_spent", F.col("total_spent").cast("double"))


@query("repeat_customers_all", "A15", check_sql("order_events", _REPEAT))
def _(m: Market):
    everyone = rollups.repeat_customers(rollups.order_events(m.orders, m.goods), AS_OF, k=None)
    return everyone.withColumn("total_spent", F.col("total_spent").cast("double"))


@query(
    "low_rated_merchants",
    "A16",
    check_sql(
        _USES,
        f"""SELECT merchant_id, CAST(sum(orders_count) AS BIGINT) AS total_orders, CAST(sum(reviewed_count) AS BIGINT) AS total_reviews,
                   {_RATED} AS avg_rating FROM stats WHERE CAST(date AS DATE) >= DATE '{AS_OF}' - INTERVAL 3000 DAY
            GROUP BY 1 HAVING sum(reviewed_count) > 10 AND {_RATED} < 3.0""",
        stats=_MERCHANT,
    ),
)
def _(m: Market):
    return rollups.low_rated_merchants(_rollup(m, "merchant"), AS_OF, days=3000)


@query(
    "unexpired_rollup",
    "SNK6",
    check_sql(_USES, f"SELECT * FROM stats {_RECENT}", stats=_CATEGORY),
)
def _(m: Market):
    stats = _rollup(m, "category")
    return _dated(rollups.expire(stats, F.col("date").cast("timestamp_ntz"), "30 days", AS_OF))


@query(
    "unexpired_events",
    "SNK6",
    """SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR""",
)
def _(m: Market):
    return rollups.expire(m.table("events"), "ts", "24 hours", "2024-01-30 12:00:00").select("event_id", "event_type")


@query(
    "order_fact_months",
    "SNK4 F10",
    check_sql(
        "order_events",
        """SELECT CAST(strftime(order_ts, '%Y%m') AS BIGINT) AS month, count(*) AS n, CAST(sum(price) AS DOUBLE) AS revenue
           FROM order_events GROUP BY 1""",
    ),
)
def _(m: Market):
    """Write the order fact by month and read the months back."""
    path = new_folder(m.spark, "order-fact")
    write_fact(rollups.order_events(m.orders, m.goods), path, "order_ts", ["category_id", "merchant_id", "good_id"])
    back = m.spark.read.parquet(path)
    return back.groupBy(F.col("month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").cast("double").alias("revenue")
    )


def _streamed(m: Market, kind: str):
    """Rollup built by the stream from order and review deltas, batch by batch."""
    orders, reviews = _events(m)
    deltas = rollups.order_deltas(orders).unionByName(rollups.review_deltas(reviews))
    source, target = new_folder(m.spark, "deltas"), new_folder(m.spark, "rollups")
    deltas.repartition(8).write.parquet(source)
    stream = m.spark.readStream.schema(deltas.schema).option("maxFilesPerTrigger", 4).parquet(source)
    maintain_rollups(stream, target, new_folder(m.spark, "progress"), kinds=(kind,)).awaitTermination()
    return rollup_tables(m.spark, target)[kind].read()


@query("streamed_category_stats", "S8", check_sql(_USES, _CATEGORY))
def _(m: Market):
    return _dated(_streamed(m, "category"))


@query("streamed_merchant_stats", "S8", check_sql(_USES, _MERCHANT))
def _(m: Market):
    return _dated(_streamed(m, "merchant"))


@query("streamed_product_stats", "S8", check_sql(_USES, _PRODUCT))
def _(m: Market):
    return _streamed(m, "product")
