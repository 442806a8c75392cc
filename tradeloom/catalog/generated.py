"""Generators driven by the test tables, so their output grows with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.base import check_sql, query
from tradeloom.functions.hashing import mix_sql
from tradeloom.operators import generate as gen
from tradeloom.operators.joins import assign_by_hash, customers, merchants
from tradeloom.operators.rankings import shuffled
from tradeloom.sources.market import Market


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values, key: str, seed: int) -> str:
    return f"{_list(values)}[CAST({mix_sql(key, seed)} % {len(values)} + 1 AS INTEGER)]"


def _draw(key: str, seed: int) -> str:
    return f"({mix_sql(key, seed)} % 10000)"


def _rounded(key: str, seed: int, spread: int, least: int) -> str:
    return f"CAST(floor({_draw(key, seed)} / 10000.0::DOUBLE * {spread} + {least} + 0.5) AS BIGINT)"


def _ids(m: Market):
    return m.table("customer").select(F.col("c_custkey").alias("id"))


@query(
    "generated_users",
    "GEN1 F7 F16",
    f"""SELECT c_custkey AS user_id, md5(CAST({mix_sql('c_custkey', 1)} AS VARCHAR)) AS password_hash,
               {_pick(gen.FIRST_NAMES, 'c_custkey', 2)} || ' ' || {_pick(gen.LAST_NAMES, 'c_custkey', 3)} AS name,
               CASE WHEN {_draw('c_custkey', 4)} < 2000 THEN 'merchant' ELSE 'customer' END AS user_type FROM customer""",
)
def _(m: Market):
    return gen.users(_ids(m))


@query(
    "generated_addresses",
    "GEN1 F1",
    f"""SELECT c_custkey AS addr_id, {_pick(gen.CITIES, 'c_custkey', 11)} || ', ' || {_pick(gen.STREET_KINDS, 'c_custkey', 12)} || ' ' ||
               {_pick(gen.STREETS, 'c_custkey', 13)} || ', д. ' || ({mix_sql('c_custkey', 14)} % 100 + 1) AS name FROM customer""",
)
def _(m: Market):
    return gen.addresses(_ids(m))


@query(
    "generated_goods",
    "GEN2 W6 J16",
    check_sql(
        "users categories",
        """SELECT base + n AS good_id, merch_id, c.caty_id FROM (
             SELECT user_id AS merch_id, rn, (t // k) * (rn - 1) + least(rn - 1, t % k) AS base,
                    unnest(range(1, t // k + CASE WHEN rn <= t % k THEN 1 ELSE 0 END + 1)) AS n FROM sh) e
           JOIN (SELECT caty_id, row_number() OVER (ORDER BY caty_id) AS rn FROM categories) c
             ON c.rn = 1 + (e.rn + e.n - 2) % (SELECT count(*) FROM categories)""",
        sh=f"""SELECT user_id, row_number() OVER (ORDER BY {mix_sql('user_id', 21)}, user_id) AS rn, count(*) OVER () AS k,
                      (SELECT count(*) FROM part) AS t FROM users WHERE user_type = 'merchant'""",
    ),
)
def _(m: Market):
    """As many goods as parts, in even quotas over the suppliers."""
    total = m.table("part").select(F.count(F.lit(1))).scalar()
    return gen.goods(merchants(m.users), total, m.categories).select("good_id", "merch_id", "caty_id")


_BANDS = (
    "CASE "
    + " ".join(
        f"WHEN {_draw('user_id', 31)} / 10000.0::DOUBLE < {bound} THEN " + (_rounded("user_id", 32, spread, least) if spread else str(least))
        for bound, least, spread in gen.ORDER_BANDS
    )
    + " END"
)
_GEN_ORDERS = f"""
  SELECT k.id, k.user_id, g.good_id FROM (
    SELECT user_id, id, 1 + {mix_sql('id', 33)} % (SELECT count(*) FROM goods) AS gn FROM (
      SELECT user_id, user_id * 100 + n AS id FROM (
        SELECT user_id, unnest(range(1, {_BANDS} + 1)) AS n FROM users WHERE user_type = 'customer'))) k
  JOIN (SELECT good_id, row_number() OVER (ORDER BY good_id) AS rn FROM goods) g ON g.rn = k.gn"""


@query("generated_orders", "GEN3 J16 F15", check_sql("users goods", "SELECT * FROM o", o=_GEN_ORDERS))
def _(m: Market):
    return gen.orders(m.users, m.goods)


@query(
    "generated_orders_capped",
    "GEN3 T8",
    check_sql("users goods", f"SELECT * FROM o ORDER BY {mix_sql('id', 34)}, id LIMIT 500", o=_GEN_ORDERS),
)
def _(m: Market):
    return gen.orders(m.users, m.goods, cap=500)


_PAIR_KEY = "user_id * 1000003 + good_id"


@query(
    "generated_reviews",
    "GEN4 T5 T7 P9",
    check_sql(
        "bought",
        f"""SELECT user_id, good_id, {_rounded(_PAIR_KEY, 42, 4, 1)} AS rating,
                   {_list(gen.COMMENTS)}[CAST({_rounded(_PAIR_KEY, 43, 4, 0)} + 1 AS INTEGER)] AS comment
            FROM bought WHERE {_draw(_PAIR_KEY, 41)} < 3500""",
    ),
)
def _(m: Market):
    return gen.reviews(m.users, m.orders)


@query(
    "generated_rows_per_customer",
    "GEN5",
    check_sql(
        "users",
        f"""SELECT user_id, unnest(range(1, {mix_sql('user_id', 51)} % 8 + 1)) AS n FROM users WHERE user_type = 'customer'""",
    ),
)
def _(m: Market):
    """Nought to seven orders per customer."""
    return gen.per_owner(customers(m.users), "user_id", 0, 7)


@query(
    "generated_goods_per_merchant",
    "GEN5",
    check_sql(
        "users",
        f"""SELECT user_id, unnest(range(1, {mix_sql('user_id', 52)} % 20 + 40 + 1)) AS n FROM users WHERE user_type = 'merchant'""",
    ),
)
def _(m: Market):
    """Forty to fifty-nine goods per merchant."""
    return gen.per_owner(merchants(m.users), "user_id", 40, 59, seed=52)


@query(
    "sampled_history",
    "GEN6 T8",
    check_sql("history", f"SELECT id, user_id FROM history ORDER BY {mix_sql('id', 61)}, id LIMIT 300"),
)
def _(m: Market):
    return gen.sample_rows(m.purchase_history, "id", 300).select("id", "user_id")


@query(
    "sampled_warehouses",
    "GEN6 T8",
    f"SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS addr_id FROM supplier ORDER BY {mix_sql('s_suppkey', 62)}, s_suppkey LIMIT 50",
)
def _(m: Market):
    return gen.sample_rows(m.warehouses, "id", 50, seed=62)


@query(
    "sampled_share",
    "T7",
    check_sql("purchases", f"SELECT id FROM purchases WHERE {_draw('id', 61)} < 3500"),
)
def _(m: Market):
    return gen.sample_share(m.orders, "id", 0.35).select("id")


@query(
    "shuffled_customers",
    "W6",
    check_sql(
        "users",
        f"""SELECT user_id, row_number() OVER (ORDER BY {mix_sql('user_id', 9)}, user_id) AS rn, count(*) OVER () AS total
            FROM users WHERE user_type = 'customer'""",
    ),
)
def _(m: Market):
    return shuffled(customers(m.users).select("user_id"), "user_id", seed=9)


@query(
    "customers_assigned_goods",
    "J16 F8",
    check_sql(
        "users goods",
        f"""SELECT u.user_id, g.good_id FROM users u JOIN (SELECT good_id, row_number() OVER (ORDER BY good_id) AS rn FROM goods) g
              ON g.rn = 1 + {mix_sql('u.user_id', 3)} % (SELECT count(*) FROM goods)""",
    ),
)
def _(m: Market):
    return assign_by_hash(m.users.select("user_id"), "user_id", m.goods, "good_id", 3)


def _seed_ids(m: Market):
    return m.table("part").select((F.col("p_partkey") + 1).alias("id"))


@query(
    "seed_products",
    "GEN7",
    f"""SELECT id AS good_id, 'Товар ' || {_list(gen.SEED_GOODS)}[(id - 1) % 10 + 1] || ' ' || id AS name, id % 3 + 1 AS merchant_id,
               id % 5 + 1 AS category_id, {_list(gen.SEED_MERCHANTS)}[(id - 1) % 3 + 1] AS merchant_name,
               {_list(gen.SEED_CATEGORIES)}[id % 5 + 1] AS category_name FROM (SELECT p_partkey + 1 AS id FROM part)""",
)
def _(m: Market):
    return gen.seed_products(_seed_ids(m)).drop("attributes", "tags")


@query(
    "seed_reviews",
    "GEN7",
    """SELECT rid AS review_id, pid AS product_id, (rid + 1) % 100 + 1 AS user_id, (rid + 1) % 5 + 1 AS rating, 'Отзыв ' || (rid + 1) AS comment
       FROM (SELECT pid, row_number() OVER (ORDER BY pid, n) AS rid FROM (
         SELECT p_partkey + 1 AS pid, unnest(range(1, (p_partkey + 1) % 4 + 3)) AS n FROM part))""",
)
def _(m: Market):
    return gen.seed_reviews(_seed_ids(m))


@query(
    "generated_business_events",
    "GEN8",
    f"""SELECT event_id, kind AS "eventType", lower(kind) || '-' || ref AS "entityId",
               CASE kind WHEN 'OrderCreated' THEN '{{"orderId":"' || ref || '","amount":99.5,"currency":"RUB"}}'
                         WHEN 'OrderPaid' THEN '{{"orderId":"' || ref || '","paymentId":"' || other || '"}}'
                         WHEN 'OrderCancelled' THEN '{{"orderId":"' || ref || '","reason":"user_request"}}'
                         WHEN 'TrainingBooked' THEN '{{"slotId":"' || other || '","coach":"ivan"}}'
                         WHEN 'SubscriptionExpired' THEN '{{"memberId":"' || ref || '","plan":"gold"}}'
                         WHEN 'TripCreated' THEN '{{"routeId":"42","vehicleId":"bus-7"}}'
                         WHEN 'CrashDetected' THEN '{{"vehicleId":"bus-7","severity":"high"}}'
                         WHEN 'BookIssued' THEN '{{"isbn":"978-5-000","readerId":"' || ref || '"}}'
                         ELSE '{{"isbn":"978-5-000","readerId":"' || ref || '","fineRub":0}}' END AS payload
        FROM (SELECT event_id, {_pick(gen.EVENT_TYPES, 'event_id', 71)} AS kind,
                     lpad(upper(to_hex({mix_sql('event_id', 72)})), 8, '0') AS ref,
                     lpad(upper(to_hex({mix_sql('event_id', 73)})), 8, '0') AS other FROM events)""",
)
def _(m: Market):
    ids = m.table("events").select(F.col("event_id").alias("id"), "ts")
    made = gen.business_events(ids, F.col("ts"), types=gen.EVENT_TYPES)
    number = F.element_at(F.split("eventId", "-"), -1).cast("bigint")
    return made.select(number.alias("event_id"), "eventType", "entityId", "payload")
