"""Registry of queries over the test tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradeloom.sources.market import Market


@dataclass(frozen=True)
class Entry:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Market], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        # Checked, not changed: the session is the caller's.
        if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
            spark = spark.newSession()
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Market(spark, folder))


REGISTRY: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(market) -> DataFrame``; ``covers`` lists survey ids."""

    def add(fn: Callable[[Market], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(name, tuple(covers.split()), fn, sql)
        return fn

    return add


# The market tables as the checking engine sees them.
MARKET_SQL = {
    "users": """
      SELECT c_custkey AS user_id, c_name AS name, 'customer' AS user_type FROM customer
      UNION ALL SELECT 1000000000000 + s_suppkey, s_name, 'merchant' FROM supplier""",
    "categories": """
      SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS caty_id, p_brand AS name FROM part""",
    "goods": """
      SELECT p_partkey AS good_id, p_name AS name, CAST(substr(p_brand, 7) AS BIGINT) AS caty_id,
             CAST(floor(sqrt(p_partkey)) AS BIGINT) % (SELECT count(*) FROM supplier) + 1000000000000 AS merch_id
      FROM part""",
    "lines": """
      SELECT CAST((l_orderkey * 10 + l_linenumber)::HUGEINT * 100000000000000000000000
                  + l_partkey::HUGEINT * 100000000000 + l_suppkey AS DECIMAL(38,0)) AS id,
             o_custkey AS user_id, l_partkey AS good_id, o_orderdate AS order_ts,
             CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS price,
             l_returnflag, l_linenumber, CAST(floor((l_quantity - 1) / 10) AS BIGINT) + 1 AS rating, l_shipdate
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
    "purchases": "SELECT id, user_id, good_id, order_ts, price FROM lines",
    "reviews": """
      SELECT id, user_id, good_id, rating, 'rated ' || rating AS comment, l_shipdate AS review_ts
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id, good_id ORDER BY id) AS pick
            FROM lines WHERE l_returnflag = 'R' AND l_linenumber <= 2) WHERE pick = 1""",
    "history": "SELECT id, user_id, id AS order_id FROM purchases",
    "products": """
      SELECT g.good_id, g.name, g.merch_id AS merchant_id, g.caty_id AS category_id,
             u.name AS merchant_name, c.name AS category_name,
             p_brand, p_type, p_size, string_split(p_name, ' ') AS tags
      FROM goods g JOIN users u ON g.merch_id = u.user_id JOIN categories c ON g.caty_id = c.caty_id
      JOIN part ON p_partkey = g.good_id""",
    "bought": "SELECT user_id, good_id, count(*) AS cnt FROM purchases GROUP BY 1, 2",
    "order_events": """
      SELECT o.id AS order_id, o.user_id, g.merch_id AS merchant_id, o.good_id, g.caty_id AS category_id, o.order_ts, o.price
      FROM purchases o JOIN goods g ON o.good_id = g.good_id""",
    "review_events": """
      SELECT r.id AS review_id, r.user_id, r.good_id, g.merch_id AS merchant_id, g.caty_id AS category_id,
             r.rating, r.comment, r.review_ts
      FROM reviews r JOIN goods g ON r.good_id = g.good_id""",
}
_NEEDS = {
    "purchases": ["lines"],
    "reviews": ["lines"],
    "history": ["purchases"],
    "products": ["goods", "users", "categories"],
    "bought": ["purchases"],
    "order_events": ["purchases", "goods"],
    "review_events": ["reviews", "goods"],
}


def check_sql(uses: str, body: str, recursive: bool = False, **ctes: str) -> str:
    """``body`` behind the market tables named in ``uses`` and extra CTEs."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in uses.split():
        need(name)
    if body.lstrip().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    parts = [f"{name} AS ({MARKET_SQL[name]})" for name in wanted]
    parts += [f"{name} AS ({text})" for name, text in ctes.items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + body


def half_up_sql(total: str, count: str, scale: int = 2) -> str:
    unit = 10**scale
    s, n = f"CAST({total} AS BIGINT)", f"CAST({count} AS BIGINT)"
    return f"CASE WHEN {n} > 0 THEN (({s} * {2 * unit} + {n}) // ({n} * 2)) / {unit}.0::DOUBLE END"


def half_even_sql(total: str, count: str, scale: int = 2) -> str:
    unit = 10**scale
    s, n = f"CAST({total} AS BIGINT)", f"CAST({count} AS BIGINT)"
    whole, rest = f"(({s} * {unit}) // {n})", f"(({s} * {unit}) % {n})"
    up = f"CASE WHEN {rest} * 2 > {n} OR ({rest} * 2 = {n} AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CASE WHEN {n} > 0 THEN ({whole} + {up}) / {unit}.0::DOUBLE END"
