"""Graph questions over one DataFrame per node label and edge type.

Traversal is equi-joins on edges.  Nothing here lists all pairs of a group:
pair questions are answered from group sizes, or only for the ``k`` pairs that
can reach the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.functions.dialect import nulls_first, ratio
from tradeloom.operators.joins import merchants
from tradeloom.plans.ordered import top_per_group
from tradeloom.plans.staging import stage


@dataclass(frozen=True)
class Graph:
    """Nodes: users, products, categories.  Edges point as their names read."""

    users: DataFrame  # user_id, name, user_type
    products: DataFrame  # good_id, name
    categories: DataFrame  # caty_id, name
    sold_by: DataFrame  # good_id -> user_id
    in_category: DataFrame  # good_id -> caty_id
    bought: DataFrame  # user_id -> good_id, cnt
    reviewed: DataFrame  # user_id -> good_id, rating, comment


def build_graph(
    users: DataFrame, goods: DataFrame, categories: DataFrame, orders: DataFrame, reviews: DataFrame
) -> Graph:
    """Nodes and edges; edges with a missing end are left out, one per pair."""

    def linked(edges: DataFrame, *ends: tuple[DataFrame, str]) -> DataFrame:
        for nodes, key in ends:
            edges = edges.join(nodes.select(key), key, "left_semi")
        return edges

    sold_by = goods.select("good_id", F.col("merch_id").alias("user_id")).distinct()
    in_category = goods.select("good_id", "caty_id").distinct()
    bought = orders.groupBy("user_id", "good_id").agg(F.count(F.lit(1)).alias("cnt"))
    reviewed = reviews.groupBy("user_id", "good_id").agg(
        F.max_by("rating", "id").alias("rating"), F.max_by("comment", "id").alias("comment")
    )
    return Graph(
        users=users.select("user_id", "name", "user_type"),
        products=goods.select("good_id", "name"),
        categories=categories,
        sold_by=linked(sold_by, (users, "user_id")),
        in_category=linked(in_category, (categories, "caty_id")),
        bought=linked(bought, (users, "user_id"), (goods, "good_id")),
        reviewed=linked(reviewed, (users, "user_id"), (goods, "good_id")),
    )


def bought_chain(graph: Graph) -> DataFrame:
    """User -BOUGHT-> Product -IN_CATEGORY-> Category."""
    return (
        graph.bought.join(graph.in_category, "good_id")
        .join(graph.users.select("user_id", F.col("name").alias("user_name")), "user_id")
        .join(graph.products.select("good_id", F.col("name").alias("product_name")), "good_id")
        .join(graph.categories.select("caty_id", F.col("name").alias("category_name")), "caty_id")
        .select("user_id", "good_id", "caty_id", "user_name", "product_name", "category_name")
    )


def sold_chain(graph: Graph) -> DataFrame:
    """Category <-IN_CATEGORY- Product -SOLD_BY-> User."""
    return (
        graph.sold_by.join(graph.in_category, "good_id")
        .join(graph.users.select("user_id", F.col("name").alias("merchant_name")), "user_id")
        .join(graph.categories.select("caty_id", F.col("name").alias("category_name")), "caty_id")
        .select("good_id", "user_id", "caty_id", "merchant_name", "category_name")
    )


def any_edge(graph: Graph) -> DataFrame:
    """User--Product edges of any type, seen without direction."""
    kinds = [("SOLD_BY", graph.sold_by), ("BOUGHT", graph.bought), ("REVIEWED", graph.reviewed)]
    parts = [e.select("user_id", "good_id", F.lit(kind).alias("edge_type")) for kind, e in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def user_degrees(graph: Graph, k: int | None = 10) -> DataFrame:
    """Number of edges per user, in total and by type.

    The list of types is given as counts per type: bounded, however many edges
    a user has.
    """
    counts = any_edge(graph).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("connection_count"),
        *[F.count_if(F.col("edge_type") == t).alias(t.lower()) for t in ("SOLD_BY", "BOUGHT", "REVIEWED")],
    )
    report = graph.users.join(counts, "user_id")
    return report if k is None else report.orderBy(nulls_first("connection_count"), "user_id").limit(k)


def node_degrees(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Degree of every node of one edge table, both ends."""
    ends = edges.select(F.lit(src).alias("label"), F.col(src).alias("node")).unionByName(
        edges.select(F.lit(dst).alias("label"), F.col(dst).alias("node"))
    )
    return ends.groupBy("label", "node").agg(F.count(F.lit(1)).alias("degree"))


# -- common neighbours ------------------------------------------------------------

def common_neighbour_totals(goods: DataFrame) -> DataFrame:
    """How many pairs of goods share one and two neighbours (category, merchant).

    Counted from group sizes, n(n-1)/2 per group; no pair is formed.
    """

    def pairs(*keys: str) -> DataFrame:
        # Decimals: a group of billions has more pairs than a bigint can count.
        sizes = goods.groupBy(*keys).agg(F.count(F.lit(1)).cast("decimal(18,0)").alias("n"))
        return sizes.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1)) / 2, F.lit(0)).cast("decimal(38,0)").alias("p"))

    both = pairs("caty_id", "merch_id").select(F.col("p").alias("both"))
    totals = both.withColumn("cat", pairs("caty_id").scalar()).withColumn("mer", pairs("merch_id").scalar())
    one = (F.col("cat") + F.col("mer") - F.col("both") * 2).cast("decimal(38,0)")

    def row(neighbours: int, count) -> "F.Column":
        return F.struct(F.lit(neighbours).cast("bigint").alias("common_neighbours"), count.alias("pairs"))

    return totals.select(F.inline(F.array(row(1, one), row(2, F.col("both")))))


def common_neighbours(goods: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` pairs of goods with most common neighbours, smallest ids first.

    Two common neighbours (same category and merchant) beat one, so those
    pairs come first and single-neighbour pairs are looked at only when they do
    not fill ``k``.  A pair can reach the result only if its smaller good is
    among the first ``k`` that have a partner, and its larger good among the
    first partners of that one: at most ``k`` goods are broadcast and ``k`` rows
    per good survive the map side.
    """
    slim = goods.select("good_id", "name", "caty_id", "merch_id")
    double = _first_pairs(slim, ["caty_id", "merch_id"], k).withColumn("common_neighbours", F.lit(2).cast("bigint"))
    # Written down: k rows for each of k goods at most, counted now and used below.
    double = stage(double, "double")
    best = double
    if double.count() < k:
        single = None
        for key, other in (("caty_id", "merch_id"), ("merch_id", "caty_id")):
            side = _first_pairs(slim, [key], k, different=other)
            single = side if single is None else single.unionByName(side)
        best = double.unionByName(single.withColumn("common_neighbours", F.lit(1).cast("bigint")))
    return best.orderBy(F.desc("common_neighbours"), "good1", "good2").limit(k)


def _first_pairs(goods: DataFrame, keys: list[str], k: int, different: str | None = None) -> DataFrame:
    """First ``k`` pairs by (good1, good2) among goods equal in ``keys`` and,
    if asked, different in one more column."""
    last = goods.groupBy(*keys).agg(F.max("good_id").alias("_last"))
    if different is not None:
        last = goods.groupBy(*keys).agg(
            F.max("good_id").alias("_last"), F.max_by(different, "good_id").alias("_last_other")
        )
        # Next to the largest good, the largest one unlike it: a good has a
        # later unlike partner iff one of these two is one.
        unlike = (
            goods.join(last, keys)
            .where(F.col(different) != F.col("_last_other"))
            .groupBy(*keys)
            .agg(F.max("good_id").alias("_last_unlike"))
        )
        last = last.join(unlike, keys, "left")
    first = goods.join(last, keys).where(F.col("good_id") < F.col("_last"))
    if different is not None:
        first = first.where(
            (F.col(different) != F.col("_last_other")) | (F.col("good_id") < F.col("_last_unlike"))
        )
    first = first.orderBy("good_id").limit(k)
    left = first.select(
        *keys,
        F.col("good_id").alias("good1"),
        F.col("name").alias("product1"),
        *([F.col(different).alias("_other1")] if different else []),
    )
    right = goods.select(
        *keys,
        F.col("good_id").alias("good2"),
        F.col("name").alias("product2"),
        *([F.col(different).alias("_other2")] if different else []),
    )
    # At most k rows: the limit above is the proof of the broadcast's size.
    pairs = right.join(F.broadcast(left), keys).where(F.col("good2") > F.col("good1"))
    if different is not None:
        pairs = pairs.where(F.col("_other1") != F.col("_other2"))
    near = top_per_group(pairs, ["good1"], ["good2"], k)
    return near.select("good1", "good2", "product1", "product2")


def common_purchases(bought: DataFrame, user1: int, user2: int) -> DataFrame:
    """Goods both users bought, with the units together."""
    a = bought.where(F.col("user_id") == user1).select("good_id", F.col("cnt").alias("c1"))
    b = bought.where(F.col("user_id") == user2).select("good_id", F.col("cnt").alias("c2"))
    return a.join(b, "good_id").select("good_id", (F.col("c1") + F.col("c2")).alias("total_bought"))


# -- similarity ---------------------------------------------------------------------

# The similarity that is looked for first, and the step to the next if it does not give ``k`` pairs.
_FIRST_LEVEL, _NEXT_LEVEL = 0.9, 0.6


def similar_merchants(goods: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` ordered pairs of merchants with the most similar category sets.

    Merchants with the same set are folded into one class, so a thousand
    merchants that sell everything are one row.  Pairs inside a class score 1
    and come first; of each class only its first ``k + 1`` merchants can show.
    If they do not fill ``k``, classes are matched by prefix filtering: sets
    with similarity of at least t share one of their rarest categories.  t goes
    down until ``k`` pairs reach it, so prefixes grow only as far as the k-th
    pair asks; at its lowest, what two of the largest sets with one category in
    common have, all pairs with a common category would show.  A category that
    is the last of a set's prefix order brings only ``k + 1`` classes of a size
    together, see ``_met_classes``.  Pairs without a common category have
    similarity 0 and fill what is left of ``k``.
    """
    pairs = goods.select(F.col("merch_id").alias("user_id"), "caty_id").distinct()
    pairs = pairs.join(merchants(users).select("user_id"), "user_id", "left_semi")
    # One entry per category: bounded by the number of categories.
    sets = pairs.groupBy("user_id").agg(F.sort_array(F.collect_list("caty_id")).alias("cats"))
    members = top_per_group(sets, ["cats"], ["user_id"], k + 1)
    members = stage(members.withColumn("n", F.size("cats").cast("bigint")), "classes")

    a = members.select("cats", "n", F.col("user_id").alias("user1"))
    b = members.select("cats", F.col("user_id").alias("user2"))
    best = a.join(b, "cats").where(F.col("user1") != F.col("user2")).select(
        "user1", "user2", F.col("n").alias("common_categories"), F.col("n").alias("total_categories")
    )
    if best.limit(k).count() < k:
        largest = members.agg(F.max("n")).first()[0] or 1
        level, lowest = _FIRST_LEVEL, (1 - 1e-9) / (2 * largest - 1)
        while True:
            best_here = best.unionByName(_class_pairs(members, level, k))
            if best_here.limit(k).count() >= k:
                best = best_here
                break
            if level <= lowest:
                best = best_here.unionByName(_unlike_pairs(sets, best_here, k))
                break
            level = max(lowest, level * _NEXT_LEVEL)
    names1 = users.select(F.col("user_id").alias("user1"), F.col("name").alias("seller1"))
    names2 = users.select(F.col("user_id").alias("user2"), F.col("name").alias("seller2"))
    scored = best.withColumn("similarity", ratio("common_categories", "total_categories"))
    top = scored.orderBy(F.desc("similarity"), F.desc("common_categories"), "user1", "user2").limit(k)
    return top.join(names1, "user1").join(names2, "user2")


def _unlike_pairs(sets: DataFrame, alike: DataFrame, k: int) -> DataFrame:
    """The first ``k`` ordered pairs of merchants that are not in ``alike``.

    ``alike`` holds all pairs with a common category and fewer than ``k`` of
    them, so among the first ``2k + 1`` merchants there are enough others:
    either these are all merchants, or the first of them has ``k`` partners.
    """
    first = sets.select("user_id", F.size("cats").cast("bigint").alias("n")).orderBy("user_id").limit(2 * k + 1)
    partners = first.agg(F.collect_list(F.struct(F.col("user_id").alias("user2"), F.col("n").alias("n2"))))
    pairs = first.select(F.col("user_id").alias("user1"), F.col("n").alias("n1"), F.explode(partners.scalar()).alias("p")).select("user1", "n1", "p.*")
    unlike = pairs.where("user1 <> user2").join(alike.select("user1", "user2"), ["user1", "user2"], "left_anti")
    return (
        unlike.orderBy("user1", "user2")
        .limit(k)
        .select("user1", "user2", F.lit(0).cast("bigint").alias("common_categories"), (F.col("n1") + F.col("n2")).alias("total_categories"))
    )


def _met_classes(members: DataFrame, level: float, k: int) -> DataFrame:
    """Ordered pairs of classes that share a category of their prefixes and may have similarity >= level.

    ``rest`` is how many categories a set has behind the shared one, so one
    more than the lesser rest bounds what two sets have in common.  A set that
    meets others at its last category has nothing behind it: with any set of
    size m it has at least 1 / (n + m - 1), and more only if they also meet
    earlier.  Of the sets of one size that end in a category, those with the
    ``k + 1`` smallest merchants give ``k`` pairs that come before all pairs of
    the others, so the others stay out: a category that everyone sells joins
    at most ``k + 1`` classes per size.
    """
    sets = members.groupBy("cats", "n").agg(F.min("user_id").alias("first"))
    tokens = sets.select("cats", "n", "first", F.explode("cats").alias("c"))
    frequency = tokens.groupBy("c").agg(F.count(F.lit(1)).alias("f"))
    # Rarest categories first; a set keeps n - ceil(level * n) + 1 of them.
    by_rarity = W.partitionBy("cats").orderBy("f", "c")
    kept = F.col("n") - F.ceil(F.col("n") * F.lit(level)) + 1
    prefix = (
        tokens.join(frequency, "c")
        .withColumn("_at", F.row_number().over(by_rarity))
        .where(F.col("_at") <= F.least(kept, F.col("n")))
        .select("c", "cats", "n", "first", (F.col("n") - F.col("_at")).alias("rest"))
    )
    ends = top_per_group(prefix.where("rest = 0"), ["c", "n"], ["first"], k + 1)
    prefix = prefix.where("rest > 0").unionByName(ends)
    left = prefix.select("c", F.col("cats").alias("cats1"), F.col("n").alias("n1"), F.col("rest").alias("rest1"))
    right = prefix.select("c", F.col("cats").alias("cats2"), F.col("n").alias("n2"), F.col("rest").alias("rest2"))
    most = F.least("rest1", "rest2") + 1
    return (
        left.join(right, "c")
        .where(F.col("cats1") != F.col("cats2"))
        .where((F.col("n1") >= F.col("n2") * F.lit(level)) & (F.col("n2") >= F.col("n1") * F.lit(level)))
        # Only the first category two sets share counts, and there the bound holds.
        .groupBy("cats1", "cats2", "n1", "n2")
        .agg(F.max(most).alias("most"))
        .where(F.col("most") >= (F.col("n1") + F.col("n2") - F.col("most")) * F.lit(level))
    )


def _class_pairs(members: DataFrame, level: float, k: int) -> DataFrame:
    """Ordered pairs of merchants of different classes with similarity >= level, all that can be among the first ``k``."""
    matched = (
        _met_classes(members, level, k)
        .withColumn("common_categories", F.size(F.array_intersect("cats1", "cats2")).cast("bigint"))
        .withColumn("total_categories", F.col("n1") + F.col("n2") - F.col("common_categories"))
        .where(F.col("common_categories") >= F.col("total_categories") * F.lit(level))
    )
    # Only the best class pairs can reach k merchant pairs.
    best = matched.orderBy(
        F.desc(ratio("common_categories", "total_categories")), F.desc("common_categories"), "cats1", "cats2"
    )
    edge = best.limit(k).agg(
        F.min(F.struct(ratio("common_categories", "total_categories").alias("s"), F.col("common_categories").alias("c"))).alias("e")
    )
    floor = edge.select("e").scalar()
    strong = matched.where(
        F.struct(ratio("common_categories", "total_categories").alias("s"), F.col("common_categories").alias("c")) >= floor
    )
    m1 = members.select(F.col("cats").alias("cats1"), F.col("user_id").alias("user1"))
    m2 = members.select(F.col("cats").alias("cats2"), F.col("user_id").alias("user2"))
    return strong.join(m1, "cats1").join(m2, "cats2").select("user1", "user2", "common_categories", "total_categories")


# -- recommendations -------------------------------------------------------------------

def also_bought(bought: DataFrame, user_id: int, k: int | None = 5) -> DataFrame:
    """Goods bought by users who share a good with ``user_id`` and new to them."""
    mine = bought.where(F.col("user_id") == user_id).select("good_id")
    others = (
        bought.join(mine, "good_id", "left_semi").where(F.col("user_id") != user_id).select("user_id").distinct()
    )
    counts = (
        bought.join(others, "user_id", "left_semi")
        .join(mine, "good_id", "left_anti")
        .groupBy("good_id")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return counts if k is None else counts.orderBy(nulls_first("times"), "good_id").limit(k)


def bought_together(bought: DataFrame, good_id: int, k: int | None = 5) -> DataFrame:
    """Other goods of the buyers of ``good_id``, by units bought."""
    buyers = bought.where(F.col("good_id") == good_id).select("user_id").distinct()
    counts = (
        bought.where(F.col("good_id") != good_id)
        .join(buyers, "user_id", "left_semi")
        .groupBy("good_id")
        .agg(F.sum("cnt").alias("co_purchase_count"))
    )
    return counts if k is None else counts.orderBy(nulls_first("co_purchase_count"), "good_id").limit(k)


def cross_sell(graph: Graph, category: str, k: int | None = 10) -> DataFrame:
    """Other categories bought by the buyers of a category, by different buyers."""
    named = graph.categories.select("caty_id", (F.col("name") == category).alias("_inside"))
    placed = graph.bought.join(graph.in_category, "good_id").join(named, "caty_id")
    # One list per user, with one entry per category at most.
    buyers = placed.groupBy("user_id").agg(F.collect_set("caty_id").alias("_cats"), F.max("_inside").alias("_inside")).where("_inside")
    other = graph.categories.where(F.col("name") != category).select("caty_id", F.col("name").alias("category"))
    counts = buyers.select(F.explode("_cats").alias("caty_id")).groupBy("caty_id").agg(F.count(F.lit(1)).alias("co_purchases"))
    report = other.join(counts, "caty_id").select("caty_id", "category", "co_purchases")
    return report if k is None else report.orderBy(nulls_first("co_purchases"), "caty_id").limit(k)


# -- paths ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Edges:
    """An edge table as it lies: its two key columns, each with the label letter of its nodes.

    A node's name is its label and key, ``u1``.  Edges are walked both ways.
    """

    rows: DataFrame
    src: str
    src_label: str
    dst: str
    dst_label: str


def _node(name: str) -> tuple[str, int]:
    key = name.lstrip("abcdefghijklmnopqrstuvwxyz")
    return name[: len(name) - len(key)], int(key)


def _named() -> Column:
    return F.concat("label", F.col("key").cast("string"))


def _steps(frontier: DataFrame, edges: list[Edges]) -> DataFrame:
    """Frontier rows once per edge that leaves their node, with the ``label`` and ``key`` at its other end.

    The frontier meets each table on the table's own key column; nothing is
    copied or turned round.
    """
    out = None
    for e in edges:
        for here, here_label, there, there_label in ((e.src, e.src_label, e.dst, e.dst_label), (e.dst, e.dst_label, e.src, e.src_label)):
            own = frontier.where(F.col("label") == here_label).withColumnRenamed("key", "_here").drop("label")
            links = e.rows.select(F.col(here).alias("_here"), F.col(there).cast("bigint").alias("key")).where(F.col("key").isNotNull())
            part = own.join(links, "_here").drop("_here").withColumn("label", F.lit(there_label))
            out = part if out is None else out.unionByName(part)
    return out


@dataclass
class _Side:
    """What a search has reached from one end: the newest nodes with their best path, all nodes, and how many are newest."""

    edges: list[Edges]
    newest: DataFrame
    visited: DataFrame
    size: int
    forward: bool

    @classmethod
    def at(cls, spark: SparkSession, edges: list[Edges], name: str, forward: bool) -> "_Side":
        label, key = _node(name)
        row = spark.range(1).select(F.lit(label).alias("label"), F.lit(key).cast("bigint").alias("key"), F.array(F.lit(name)).alias("path"))
        row = stage(row, "frontier")
        return cls(edges, row, row.select("label", "key"), 1, forward)

    def grow(self) -> None:
        ahead = F.array(_named())
        longer = F.concat("path", ahead) if self.forward else F.concat(ahead, F.col("path"))
        reached = _steps(self.newest, self.edges).groupBy("label", "key").agg(F.min("path").alias("path"))
        fresh = reached.join(self.visited, ["label", "key"], "left_anti").withColumn("path", longer)
        self.newest = stage(fresh, "frontier")
        self.visited = self.visited.unionByName(self.newest.select("label", "key"))
        self.size = self.newest.count()


def shortest_path(edges: list[Edges], start: str, goal: str, max_hops: int) -> DataFrame:
    """One shortest path (the smallest by node names) of at most ``max_hops``.

    Searches grow from both ends, a hop at a time and the smaller newest layer
    first, until they have a node in common; so a hub next to one end is opened
    from that end only if nothing smaller is left.  Every node carries the
    smallest path of its length to its end, and the smallest join of two of
    them is the path.  Layers are written down, so a hop never repeats the ones
    before it, and lost executors do not either.
    """
    spark = edges[0].rows.sparkSession
    near, far = _Side.at(spark, edges, start, True), _Side.at(spark, edges, goal, False)

    def joined() -> DataFrame:
        other = far.newest.select("label", "key", F.slice("path", 2, max_hops + 1).alias("_rest"))
        return near.newest.join(other, ["label", "key"]).agg(F.min(F.concat("path", "_rest")).alias("path")).where(F.col("path").isNotNull())

    hit = joined()
    for _ in range(max_hops):
        if not near.size or not far.size or not hit.isEmpty():
            break
        (near if near.size <= far.size else far).grow()
        hit = joined()
    return hit.select((F.size("path") - 1).cast("bigint").alias("hops"), "path")


def reachable(edges: list[Edges], start: str, max_hops: int) -> DataFrame:
    """Every node within ``max_hops`` and its distance."""
    spark = edges[0].rows.sparkSession
    label, key = _node(start)
    frontier = spark.range(1).select(F.lit(label).alias("label"), F.lit(key).cast("bigint").alias("key"))
    seen = frontier.withColumn("hops", F.lit(0).cast("bigint"))
    for hop in range(1, max_hops + 1):
        step = _steps(frontier, edges).select("label", "key").distinct()
        frontier = stage(step.join(seen, ["label", "key"], "left_anti"), "frontier")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier.withColumn("hops", F.lit(hop).cast("bigint")))
    return seen.select(_named().alias("node"), "hops")


def paths_up_to_two(bought: DataFrame, user_id: int) -> DataFrame:
    """All BOUGHT paths of length 1 and 2 from a user; no edge used twice."""
    mine = bought.where(F.col("user_id") == user_id).select("good_id")
    one = mine.select(F.lit(1).cast("bigint").alias("hops"), "good_id", F.lit(None).cast("bigint").alias("other"))
    back = bought.where(F.col("user_id") != user_id).select("good_id", F.col("user_id").alias("other"))
    two = mine.join(back, "good_id").select(F.lit(2).cast("bigint").alias("hops"), "good_id", "other")
    return one.unionByName(two)


def user_to_user(graph: Graph) -> DataFrame:
    """Directed reach between users: (User)-[BOUGHT|REVIEWED]->()-[SOLD_BY]->(User),
    the only directed paths between users, with their number per pair."""
    first = graph.bought.select("user_id", "good_id").unionAll(graph.reviewed.select("user_id", "good_id"))
    steps = first.groupBy("user_id", "good_id").agg(F.count(F.lit(1)).alias("_n"))
    ends = graph.sold_by.select("good_id", F.col("user_id").alias("merchant_id"))
    return steps.join(ends, "good_id").groupBy("user_id", "merchant_id").agg(F.sum("_n").alias("paths"))
