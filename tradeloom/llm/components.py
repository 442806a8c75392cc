"""Connected components of a link table, by stars that grow together.

Alternates two steps until nothing moves: every node sends its larger
neighbours to its smallest one, then its smaller ones.  Rows never pair up, and
each round is two aggregations and joins.  A node that half of all others hang
on is not gathered anywhere: its links are joined to its smallest neighbour,
and Spark splits that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.plans.staging import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # Here every row has b < a.
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()


def _mark(links: DataFrame) -> tuple:
    """Changes whenever the links do; two sums over all rows."""
    row = links.select(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``: the smallest node reachable.

    Loops, repeated and reversed links are fine; no links give no rows.  Each
    round is written to the shared folder, so a lost executor costs one round.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stage(pairs, "links")
    mark = _mark(now)
    while mark[0]:
        after = stage(_small_star(_large_star(now)), "stars")
        new = _mark(after)
        now, mark, settled = after, new, new == mark
        if settled:
            break
    # A settled table is a set of stars: every node but a root has one link, to its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
