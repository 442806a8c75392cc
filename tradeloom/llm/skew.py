"""Joins with a table of one row per key, some of whose keys hold a great part of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than this share of all rows is hot; there are at most 1,000 of them.
HOT_SHARE = 1 / 1000


def join_by_key(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row a key and in ``weight`` how many of ``rows`` have it.

    Keys that weigh more than a thousandth of the whole are sent to every task,
    at most a thousand of them; the rows of the others are shuffled, and no key
    fills a task.  Keys are not null; ``weight`` is not in the result.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = table.where(F.col(weight) > HOT_SHARE * total).drop(weight)
    cold = table.where(F.col(weight) <= HOT_SHARE * total).drop(weight)
    named = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.struct(*[c for c in hot.columns if c not in keys], F.lit(1).alias("_is")).alias("_hot"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_hot_{k}") for k in keys])
    marked = rows.join(F.broadcast(named), same, "left").drop(*[f"_hot_{k}" for k in keys])
    at_once = marked.where(F.col("_hot").isNotNull()).select(*rows.columns, *[F.col(f"_hot.{c}") for c in hot.columns if c not in keys])
    shuffled = marked.where(F.col("_hot").isNull()).drop("_hot").join(cold, keys).select(*at_once.columns)
    return at_once.unionByName(shuffled)
