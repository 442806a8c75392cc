"""Graph questions on the marketplace tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.base import check_sql, query
from tradeloom.operators import graph as g
from tradeloom.operators.reports import purchase_edges
from tradeloom.sources.market import Market


def _bought(m: Market):
    """BOUGHT edges alone; the orders of the test tables all have both ends."""
    return purchase_edges(m.orders)


def _graph(m: Market) -> g.Graph:
    return g.build_graph(m.users, m.goods, m.categories, m.orders, m.reviews)


@query("edges_sold_by", "G1", check_sql("goods", "SELECT good_id, merch_id AS user_id FROM goods"))
def _(m: Market):
    return _graph(m).sold_by


@query("edges_in_category", "G1", check_sql("goods", "SELECT good_id, caty_id FROM goods"))
def _(m: Market):
    return _graph(m).in_category


@query("edges_bought", "G1 A29", check_sql("bought", "SELECT user_id, good_id, cnt FROM bought"))
def _(m: Market):
    return _graph(m).bought


@query("edges_reviewed", "G1", check_sql("reviews", "SELECT user_id, good_id, rating, comment FROM reviews"))
def _(m: Market):
    return _graph(m).reviewed


@query(
    "bought_chain",
    "G2",
    check_sql(
        "bought goods users categories",
        """SELECT b.user_id, b.good_id, g.caty_id, u.name AS user_name, g.name AS product_name, c.name AS category_name
           FROM bought b JOIN goods g USING (good_id) JOIN users u ON u.user_id = b.user_id JOIN categories c ON c.caty_id = g.caty_id""",
    ),
)
def _(m: Market):
    return g.bought_chain(_graph(m))


@query(
    "sold_chain",
    "G2",
    check_sql(
        "goods users categories",
        """SELECT g.good_id, g.merch_id AS user_id, g.caty_id, u.name AS merchant_name, c.name AS category_name
           FROM goods g JOIN users u ON u.user_id = g.merch_id JOIN categories c ON c.caty_id = g.caty_id""",
    ),
)
def _(m: Market):
    return g.sold_chain(_graph(m))


@query(
    "user_product_edges",
    "G2 J18 F20",
    check_sql(
        "goods bought reviews",
        """SELECT merch_id AS user_id, good_id, 'SOLD_BY' AS edge_type FROM goods
           UNION ALL SELECT user_id, good_id, 'BOUGHT' FROM bought UNION ALL SELECT user_id, good_id, 'REVIEWED' FROM reviews""",
    ),
)
def _(m: Market):
    return g.any_edge(_graph(m))


_PAIRS = """
  SELECT least(a.good_id, b.good_id) AS good1, greatest(a.good_id, b.good_id) AS good2, count(*) AS n FROM (
    SELECT good_id, 'c' || caty_id AS node FROM goods UNION ALL SELECT good_id, 'm' || merch_id FROM goods) a
  JOIN (SELECT good_id, 'c' || caty_id AS node FROM goods UNION ALL SELECT good_id, 'm' || merch_id FROM goods) b
    ON a.node = b.node AND a.good_id < b.good_id GROUP BY 1, 2"""


@query(
    "common_neighbours",
    "G3 J17",
    check_sql(
        "goods",
        """SELECT good1, good2, x.name AS product1, y.name AS product2, n AS common_neighbours
           FROM pairs JOIN goods x ON x.good_id = good1 JOIN goods y ON y.good_id = good2
           ORDER BY n DESC, good1, good2 LIMIT 20""",
        pairs=_PAIRS,
    ),
)
def _(m: Market):
    return g.common_neighbours(m.goods, 20)


@query(
    "common_neighbours_many",
    "G3",
    check_sql(
        "goods",
        """SELECT good1, good2, x.name AS product1, y.name AS product2, n AS common_neighbours
           FROM pairs JOIN goods x ON x.good_id = good1 JOIN goods y ON y.good_id = good2
           ORDER BY n DESC, good1, good2 LIMIT 5000""",
        pairs=_PAIRS,
    ),
)
def _(m: Market):
    """More pairs than share two neighbours, so single-neighbour pairs show."""
    return g.common_neighbours(m.goods, 5000)


@query(
    "common_neighbour_totals",
    "G3 J17",
    check_sql("goods", "SELECT n AS common_neighbours, count(*) AS pairs FROM pairs GROUP BY 1", pairs=_PAIRS),
)
def _(m: Market):
    totals = g.common_neighbour_totals(m.goods)
    return totals.withColumn("pairs", F.col("pairs").cast("bigint"))


@query(
    "common_purchases",
    "G4",
    check_sql(
        "bought",
        """SELECT a.good_id, a.cnt + b.cnt AS total_bought FROM bought a JOIN bought b USING (good_id)
           WHERE a.user_id = 1 AND b.user_id = 10""",
    ),
)
def _(m: Market):
    return g.common_purchases(_bought(m), 1, 10)


_SIMILAR = """
  SELECT a.m AS user1, b.m AS user2, count(*) AS common_categories, any_value(sa.n) + any_value(sb.n) - count(*) AS total_categories
  FROM s a JOIN s b ON a.c = b.c AND a.m <> b.m JOIN n sa ON sa.m = a.m JOIN n sb ON sb.m = b.m GROUP BY 1, 2"""


def _similar_sql(k: int) -> str:
    return check_sql(
        "goods users",
        f"""SELECT user1, user2, u1.name AS seller1, u2.name AS seller2, common_categories, total_categories,
                  common_categories::DOUBLE / total_categories AS similarity
           FROM (SELECT * FROM p UNION ALL
                 SELECT a.m, b.m, 0, a.n + b.n FROM n a JOIN n b ON a.m <> b.m
                 WHERE NOT EXISTS (SELECT 1 FROM s x JOIN s y ON x.c = y.c WHERE x.m = a.m AND y.m = b.m)) p
           JOIN users u1 ON u1.user_id = user1 JOIN users u2 ON u2.user_id = user2
           ORDER BY similarity DESC, common_categories DESC, user1, user2 LIMIT {k}""",
        s="SELECT DISTINCT merch_id AS m, caty_id AS c FROM goods",
        n="SELECT m, count(*) AS n FROM s GROUP BY 1",
        p=_SIMILAR,
    )


@query("similar_merchants", "G5 T6", _similar_sql(10))
def _(m: Market):
    return g.similar_merchants(m.goods, m.users, 10)


@query("similar_merchants_many", "G5", _similar_sql(400))
def _(m: Market):
    """More pairs than merchants with equal sets make."""
    return g.similar_merchants(m.goods, m.users, 400)


_ALSO = """
  SELECT good_id, count(*) AS times FROM bought
  WHERE user_id IN (SELECT user_id FROM bought WHERE user_id <> 5 AND good_id IN (SELECT good_id FROM bought WHERE user_id = 5))
    AND good_id NOT IN (SELECT good_id FROM bought WHERE user_id = 5)
  GROUP BY 1"""


@query("also_bought", "G6", check_sql("bought", _ALSO + " ORDER BY times DESC, good_id LIMIT 5"))
def _(m: Market):
    return g.also_bought(_bought(m), 5)


@query("also_bought_all", "G6", check_sql("bought", _ALSO))
def _(m: Market):
    return g.also_bought(_bought(m), 5, k=None)


_TOGETHER = """
  SELECT good_id, CAST(sum(cnt) AS BIGINT) AS co_purchase_count FROM bought
  WHERE good_id <> 42 AND user_id IN (SELECT user_id FROM bought WHERE good_id = 42) GROUP BY 1"""


@query("bought_together", "G7", check_sql("bought", _TOGETHER + " ORDER BY co_purchase_count DESC, good_id LIMIT 5"))
def _(m: Market):
    return g.bought_together(_bought(m), 42)


@query("bought_together_all", "G7", check_sql("bought", _TOGETHER))
def _(m: Market):
    return g.bought_together(_bought(m), 42, k=None)


@query(
    "cross_sell",
    "G8",
    check_sql(
        "bought goods categories",
        """SELECT c.caty_id, c.name AS category, count(DISTINCT b.user_id) AS co_purchases
           FROM bought b JOIN goods g USING (good_id) JOIN categories c ON c.caty_id = g.caty_id
           WHERE c.name <> 'Brand#7' AND b.user_id IN
             (SELECT user_id FROM bought JOIN goods USING (good_id) WHERE caty_id = 7)
           GROUP BY 1, 2 ORDER BY co_purchases DESC, c.caty_id LIMIT 10""",
    ),
)
def _(m: Market):
    return g.cross_sell(_graph(m), "Brand#7")


def _bought_edges(m: Market):
    return [g.Edges(_bought(m), "user_id", "u", "good_id", "g")]


_EDGES = """
  SELECT 'u' || user_id AS src, 'g' || good_id AS dst FROM bought UNION ALL SELECT 'g' || good_id, 'u' || user_id FROM bought"""


@query(
    "shortest_bought_path",
    "G9",
    check_sql(
        "bought",
        """SELECT len(path) - 1 AS hops, array_to_string(path, '>') AS path FROM walk WHERE node = 'u10'
           ORDER BY len(path), path LIMIT 1""",
        recursive=True,
        edges=_EDGES,
        walk="""SELECT 'u1' AS node, ['u1'] AS path UNION
                SELECT e.dst, list_append(w.path, e.dst) FROM walk w JOIN edges e ON e.src = w.node
                WHERE len(w.path) <= 3 AND NOT list_contains(w.path, e.dst)""",
    ),
)
def _(m: Market):
    found = g.shortest_path(_bought_edges(m), "u1", "u10", 3)
    return found.withColumn("path", F.array_join("path", ">"))


@query(
    "hops_between_users",
    "G9",
    check_sql(
        "bought goods reviews",
        "SELECT min(hops) AS hops FROM walk WHERE node = 'u20' HAVING count(*) > 0",
        recursive=True,
        links=_EDGES
        + """ UNION ALL SELECT 'g' || good_id, 'u' || merch_id FROM goods UNION ALL SELECT 'u' || merch_id, 'g' || good_id FROM goods
              UNION ALL SELECT 'g' || good_id, 'c' || caty_id FROM goods UNION ALL SELECT 'c' || caty_id, 'g' || good_id FROM goods""",
        walk="""SELECT 'u1' AS node, 0::BIGINT AS hops UNION
                SELECT e.dst, w.hops + 1 FROM walk w JOIN links e ON e.src = w.node WHERE w.hops < 5""",
    ),
)
def _(m: Market):
    """Any edge type, at most five hops."""
    graph = _graph(m)
    edges = [
        g.Edges(graph.bought, "user_id", "u", "good_id", "g"),
        g.Edges(graph.reviewed, "user_id", "u", "good_id", "g"),
        g.Edges(graph.sold_by, "good_id", "g", "user_id", "u"),
        g.Edges(graph.in_category, "good_id", "g", "caty_id", "c"),
    ]
    return g.shortest_path(edges, "u1", "u20", 5).select("hops")


@query(
    "paths_up_to_two",
    "G10",
    check_sql(
        "bought",
        """SELECT 1::BIGINT AS hops, good_id, NULL::BIGINT AS other FROM bought WHERE user_id = 6
           UNION ALL SELECT 2, a.good_id, b.user_id FROM bought a JOIN bought b USING (good_id) WHERE a.user_id = 6 AND b.user_id <> 6""",
    ),
)
def _(m: Market):
    return g.paths_up_to_two(_bought(m), 6)


@query(
    "reachable_in_four",
    "G10",
    check_sql(
        "bought",
        "SELECT node, min(hops) AS hops FROM walk GROUP BY 1",
        recursive=True,
        edges=_EDGES,
        walk="""SELECT 'u6' AS node, 0::BIGINT AS hops UNION
                SELECT e.dst, w.hops + 1 FROM walk w JOIN edges e ON e.src = w.node WHERE w.hops < 4""",
    ),
)
def _(m: Market):
    return g.reachable(_bought_edges(m), "u6", 4)


@query(
    "user_to_user",
    "G10",
    check_sql(
        "bought reviews goods",
        """SELECT x.user_id, g.merch_id AS merchant_id, count(*) AS paths
           FROM (SELECT user_id, good_id FROM bought UNION ALL SELECT user_id, good_id FROM reviews) x JOIN goods g USING (good_id)
           GROUP BY 1, 2""",
    ),
)
def _(m: Market):
    return g.user_to_user(_graph(m))


_DEGREES = """
  SELECT u.user_id, u.name, u.user_type, count(*) AS connection_count, count(*) FILTER (WHERE t = 'S') AS sold_by,
         count(*) FILTER (WHERE t = 'B') AS bought, count(*) FILTER (WHERE t = 'R') AS reviewed
  FROM users u JOIN (SELECT merch_id AS user_id, 'S' AS t FROM goods UNION ALL SELECT user_id, 'B' FROM bought
                     UNION ALL SELECT user_id, 'R' FROM reviews) e USING (user_id) GROUP BY 1, 2, 3"""


@query(
    "user_degrees",
    "A35 G11",
    check_sql("users goods bought reviews", _DEGREES + " ORDER BY connection_count DESC, user_id LIMIT 10"),
)
def _(m: Market):
    return g.user_degrees(_graph(m))


@query("user_degrees_all", "A35 G11", check_sql("users goods bought reviews", _DEGREES))
def _(m: Market):
    return g.user_degrees(_graph(m), k=None)


@query(
    "bought_degrees",
    "G11",
    check_sql(
        "bought",
        """SELECT 'user_id' AS label, user_id AS node, count(*) AS degree FROM bought GROUP BY 2
           UNION ALL SELECT 'good_id', good_id, count(*) FROM bought GROUP BY 2""",
    ),
)
def _(m: Market):
    return g.node_degrees(_bought(m), "user_id", "good_id")
