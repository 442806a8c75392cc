"""Change application and data-quality checks on the marketplace tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.base import check_sql, query
from tradeloom.operators import changes, quality
from tradeloom.operators.maintained import OrphanWatch
from tradeloom.plans.staging import new_folder
from tradeloom.sources.market import MERCHANT_BASE, Market


@query(
    "inserted_users",
    "M1",
    check_sql(
        "users",
        """SELECT user_id, name, user_type, NULL::VARCHAR AS created_at FROM users
           UNION ALL SELECT user_id + 500000000, name, 'customer', '2001-08-01' FROM users WHERE user_type = 'merchant'""",
    ),
)
def _(m: Market):
    """Every merchant also signs up as a customer."""
    fresh = m.users.where(F.col("user_type") == "merchant").select(
        (F.col("user_id") + 500000000).alias("user_id"), "name", F.lit("customer").alias("user_type")
    )
    return changes.insert(m.users, fresh, created_at=F.lit("2001-08-01"))


@query(
    "inserted_if_new",
    "M2",
    check_sql(
        "reviews lines",
        """SELECT user_id, good_id, id, rating FROM reviews UNION ALL
           SELECT user_id, good_id, id, rating FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id, good_id ORDER BY id) AS pick FROM lines WHERE l_returnflag = 'A') l
           WHERE pick = 1 AND NOT EXISTS (SELECT 1 FROM reviews r WHERE r.user_id = l.user_id AND r.good_id = l.good_id)""",
    ),
)
def _(m: Market):
    """Reviews of the other returned lines come in; the first per pair wins."""
    lines = m._purchase_lines.where(F.col("l_returnflag") == "A").select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("good_id"),
        "id",
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).alias("rating"),
    )
    have = m.reviews.select("user_id", "good_id", "id", "rating")
    return changes.insert_new(have, lines, ["user_id", "good_id"], ["id"])


@query(
    "renamed_goods",
    "M3",
    check_sql(
        "goods",
        """SELECT good_id, CASE WHEN caty_id = 3 THEN 'renamed' ELSE name END AS name,
                  CASE WHEN caty_id = 3 THEN 2 ELSE caty_id END AS caty_id, merch_id FROM goods""",
    ),
)
def _(m: Market):
    return changes.update_where(m.goods, F.col("caty_id") == 3, name=F.lit("renamed"), caty_id=F.lit(2).cast("bigint"))


@query(
    "goods_updated_by_key",
    "M3",
    check_sql(
        "goods reviews",
        """SELECT g.good_id, CASE WHEN r.top IS NOT NULL THEN r.top ELSE g.name END AS name, g.caty_id, g.merch_id
           FROM goods g LEFT JOIN (SELECT good_id, max(comment) AS top FROM reviews GROUP BY 1) r USING (good_id)""",
    ),
)
def _(m: Market):
    fresh = m.reviews.groupBy("good_id").agg(F.max("comment").alias("name"))
    return changes.update_from(m.goods, fresh, ["good_id"])


@query(
    "goods_updated_from_merchants",
    "M4",
    check_sql(
        "goods users",
        """SELECT good_id, CASE WHEN u.user_id IS NULL THEN g.name ELSE g.name || ' (updated)' END AS name, caty_id, merch_id
           FROM goods g LEFT JOIN users u ON u.user_id = g.merch_id AND u.user_type = 'merchant' AND u.user_id % 2 = 0""",
    ),
)
def _(m: Market):
    even = m.users.where((F.col("user_type") == "merchant") & (F.pmod("user_id", F.lit(2)) == 0))
    named = F.concat("name", F.lit(" (updated)"))
    return changes.update_joined(m.goods, even.select(F.col("user_id").alias("merch_id")), ["merch_id"], name=named)


@query(
    "users_without_hash_column",
    "M3",
    check_sql("users", "SELECT user_id, user_type FROM users"),
)
def _(m: Market):
    return changes.unset(m.users, "name")


@query(
    "reviews_after_delete",
    "M5",
    check_sql("reviews", "SELECT id, rating FROM reviews WHERE NOT (rating = 1 OR good_id = 1)"),
)
def _(m: Market):
    return changes.delete_where(m.reviews, (F.col("rating") == 1) | (F.col("good_id") == 1)).select("id", "rating")


@query(
    "orders_after_customer_delete",
    "M5",
    check_sql(
        "purchases users",
        """SELECT id FROM purchases WHERE user_id NOT IN (SELECT user_id FROM users WHERE user_type = 'customer' AND user_id % 3 = 1)""",
    ),
)
def _(m: Market):
    gone = m.users.where((F.col("user_type") == "customer") & (F.pmod("user_id", F.lit(3)) == 1))
    return changes.delete_keys(m.orders, gone, ["user_id"]).select("id")


def _tables(m: Market):
    return {
        "users": m.users,
        "categories": m.categories,
        "goods": m.goods,
        "orders": m.orders,
        "reviews": m.reviews,
        "purchase_history": m.purchase_history,
    }


@query(
    "cascade_after_customer_delete",
    "M6",
    check_sql(
        "users purchases reviews history goods",
        """SELECT 'users' AS "table", count(*) AS n FROM users WHERE NOT (user_type = 'customer' AND user_id < 100)
           UNION ALL SELECT 'goods', count(*) FROM goods
           UNION ALL SELECT 'orders', count(*) FROM purchases WHERE user_id >= 100
           UNION ALL SELECT 'reviews', count(*) FROM reviews WHERE user_id >= 100
           UNION ALL SELECT 'purchase_history', count(*) FROM history WHERE user_id >= 100""",
    ),
)
def _(m: Market):
    gone = m.users.where((F.col("user_type") == "customer") & (F.col("user_id") < 100))
    after, _ = changes.cascade_delete(_tables(m), "users", gone)
    counts = [
        after[t].agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table"), "n")
        for t in ("users", "goods", "orders", "reviews", "purchase_history")
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query(
    "restricted_by_orders",
    "M6",
    check_sql(
        "purchases goods",
        f"SELECT o.id, o.good_id FROM purchases o JOIN goods g USING (good_id) WHERE g.merch_id = {MERCHANT_BASE + 3}",
    ),
)
def _(m: Market):
    """Orders that forbid deleting a merchant, as its goods would go with it."""
    gone = m.users.where(F.col("user_id") == MERCHANT_BASE + 3)
    _, blocked = changes.cascade_delete(_tables(m), "users", gone)
    return blocked["orders.good_id"].select("id", "good_id")


@query(
    "edges_after_detach_delete",
    "M6 M5",
    check_sql("bought", "SELECT user_id, good_id, cnt FROM bought WHERE user_id >= 50"),
)
def _(m: Market):
    from tradeloom.operators.reports import purchase_edges

    bought = purchase_edges(m.orders)
    _, edges = changes.detach_delete(m.users, "user_id", F.col("user_id") < 50, bought=bought)
    return edges["bought"]


@query(
    "merged_users",
    "M7",
    check_sql(
        "users reviews",
        """SELECT coalesce(u.user_id, c.user_id) AS user_id, coalesce(c.name, u.name) AS name, coalesce(u.user_type, 'customer') AS user_type,
                  CASE WHEN u.user_id IS NULL THEN 'now' END AS created, CASE WHEN u.user_id IS NOT NULL AND c.user_id IS NOT NULL THEN 'now' END AS updated
           FROM users u FULL JOIN (SELECT good_id AS user_id, 'from good ' || good_id AS name FROM reviews GROUP BY 1) c
             ON u.user_id = c.user_id""",
    ),
)
def _(m: Market):
    """Reviewed goods' ids as incoming users: some exist, some do not."""
    stamped = m.users.withColumn("created", F.lit(None).cast("string")).withColumn("updated", F.lit(None).cast("string"))
    incoming = m.reviews.select(F.col("good_id").alias("user_id")).distinct()
    incoming = incoming.withColumn("name", F.concat(F.lit("from good "), F.col("user_id").cast("string")))
    return changes.merge(
        stamped,
        incoming,
        ["user_id"],
        on_create={"created": F.lit("now"), "user_type": F.lit("customer")},
        on_match={"updated": F.lit("now")},
    )


@query(
    "rows_with_new_keys",
    "M8",
    check_sql(
        "categories users",
        """SELECT (SELECT max(caty_id) FROM categories) + row_number() OVER (ORDER BY user_id) AS caty_id, name
           FROM users WHERE user_type = 'merchant'""",
    ),
)
def _(m: Market):
    fresh = m.users.where(F.col("user_type") == "merchant").select("user_id", "name")
    return changes.with_new_keys(m.categories, "caty_id", fresh, ["user_id"]).select("caty_id", "name")


@query(
    "partition_rows",
    "A30 M9",
    check_sql(
        "purchases",
        """SELECT CASE WHEN user_id >= 1 AND user_id <= 1000 THEN (user_id - 1) // 100 ELSE -1 END AS bucket, count(*) AS n
           FROM purchases GROUP BY 1""",
    ),
)
def _(m: Market):
    return m.orders.groupBy(changes.range_bucket("user_id", 100, 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "list_partition_rows",
    "M9",
    """SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'industry' WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'home'
              ELSE 'default' END AS bucket, count(*) AS n FROM customer GROUP BY 1""",
)
def _(m: Market):
    bucket = changes.list_bucket("c_mktsegment", industry=["BUILDING", "MACHINERY"], home=["HOUSEHOLD", "FURNITURE"])
    return m.table("customer").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "partitioned_copy_range",
    "M9 P6",
    check_sql("users", "SELECT user_id, name FROM users WHERE user_id BETWEEN 95 AND 420"),
)
def _(m: Market):
    """Write users in range partitions, then read a key range with pruning."""
    path = new_folder(m.spark, "users")
    old, new = changes.write_partitioned(m.users, changes.range_bucket("user_id", 100, 10), path)
    if old != new:
        raise RuntimeError(f"copy has {new} rows of {old}")
    return changes.read_range(m.spark, path, "user_id", 95, 420, 100, 10).select("user_id", "name")


# ---------------------------------------------------------------- quality


@query(
    "repeated_line_numbers",
    "C1",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(m: Market):
    lines = m.table("lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query(
    "repeated_review_pairs",
    "C1",
    check_sql("reviews", "SELECT user_id, good_id, 1 + count(*) FILTER (rating = 5) + count(*) FILTER (rating >= 4) AS n FROM reviews WHERE rating >= 4 GROUP BY 1, 2"),
)
def _(m: Market):
    """Good reviews come in a second time, the best ones a third time."""
    again = m.reviews.where("rating >= 4").unionByName(m.reviews.where("rating = 5"))
    return quality.duplicate_keys(m.reviews.unionByName(again), ["user_id", "good_id"])


@query(
    "orphan_events",
    "C2",
    """SELECT event_id, user_id FROM events WHERE user_id NOT IN
       (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def _(m: Market):
    """Events whose user never completed an order."""
    buyers = m.table("orders").where(F.col("o_orderstatus") == "F")
    return quality.orphans(m.table("events"), "user_id", buyers, "o_custkey").select("event_id", "user_id")


@query(
    "orphans_by_change",
    "C2",
    """SELECT event_id, user_id FROM events WHERE user_id NOT IN
       (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'P'))""",
)
def _(m: Market):
    """Events without a buyer of urgent goods, kept over three batches.

    Events come in two halves, the first with all buyers; then buyers without a finished urgent order go, and those with a partly
    finished one return.
    """
    events = m.table("events").select(F.col("event_id").alias("child"), F.col("user_id").alias("key"), F.lit(1).cast("bigint").alias("n"))
    urgent, state = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus")
    buyers = (
        m.table("orders")
        .groupBy(F.col("o_custkey").alias("key"))
        .agg(F.bool_or(urgent & (state == "F")).alias("done"), F.bool_or(urgent & (state == "P")).alias("partly"))
    )
    come, go = F.lit(1).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("n")
    early = F.pmod(F.xxhash64("child"), F.lit(2)) == 0
    watch = OrphanWatch(m.spark, new_folder(m.spark, "orphans"))
    watch.apply(buyers.select("key", come), events.where(early), 0)
    watch.apply(buyers.where("NOT done").select("key", go), events.where(~early), 1)
    watch.apply(buyers.where("NOT done AND partly").select("key", come), events.where(F.lit(False)), 2)
    return watch.orphans().select(F.col("child").alias("event_id"), F.col("key").alias("user_id"))


@query(
    "foreign_key_orphans",
    "C2",
    check_sql(
        "goods users categories purchases reviews history",
        """SELECT 'goods.merch_id' AS foreign_key, count(*) AS n FROM goods WHERE merch_id NOT IN (SELECT user_id FROM users)
           UNION ALL SELECT 'goods.caty_id', count(*) FROM goods WHERE caty_id NOT IN (SELECT caty_id FROM categories)
           UNION ALL SELECT 'orders.user_id', count(*) FROM purchases WHERE user_id NOT IN (SELECT user_id FROM users)
           UNION ALL SELECT 'orders.good_id', count(*) FROM purchases WHERE good_id NOT IN (SELECT good_id FROM goods)
           UNION ALL SELECT 'reviews.user_id', count(*) FROM reviews WHERE user_id NOT IN (SELECT user_id FROM users)
           UNION ALL SELECT 'reviews.good_id', count(*) FROM reviews WHERE good_id NOT IN (SELECT good_id FROM goods)
           UNION ALL SELECT 'purchase_history.user_id', count(*) FROM history WHERE user_id NOT IN (SELECT user_id FROM users)
           UNION ALL SELECT 'purchase_history.order_id', count(*) FROM history WHERE order_id NOT IN (SELECT id FROM purchases)
           UNION ALL SELECT 'pickup_points.addr_id', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
           UNION ALL SELECT 'warehouses.addr_id', count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)""",
    ),
)
def _(m: Market):
    out = None
    for child, fk, parent, key, _rule in changes.FOREIGN_KEYS:
        lost = quality.orphans(getattr(m, child), fk, getattr(m, parent), key)
        row = lost.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{child}.{fk}").alias("foreign_key"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "check_violations",
    "C4",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE NOT coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END IN ('1-URGENT', '2-HIGH'), true)""",
)
def _(m: Market):
    """An IN-set check; the lowest priority counts as unknown and passes."""
    level = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return quality.check_violations(m.table("orders"), level.isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "one_line_per_number",
    "C5",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS pick FROM lineitem)
       WHERE pick = 1""",
)
def _(m: Market):
    kept = quality.keep_first(m.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])
    return kept.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey")


@query(
    "copy_parity",
    "C6",
    check_sql(
        "users purchases",
        """SELECT 'users' AS "table", count(*) AS left_rows, count(*) AS right_rows, true AS same FROM users
           UNION ALL SELECT 'orders', count(*), count(*) - count(*) FILTER (WHERE user_id = 5), count(*) FILTER (WHERE user_id = 5) = 0 FROM purchases""",
    ),
)
def _(m: Market):
    """Users against a written copy; orders against a copy lacking one user."""
    path = new_folder(m.spark, "copy")
    m.users.write.parquet(path)
    copy = m.spark.read.schema(m.users.schema).parquet(path)
    slim = m.orders.select("id", "user_id", "good_id")
    return quality.copy_parity(users=(m.users, copy), orders=(slim, slim.where(F.col("user_id") != 5)))
