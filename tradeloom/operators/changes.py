"""Applying changes: a table in, the changed table out.

Tables are immutable; inserts, updates, deletes and merges are joins.  To keep
the result, write it with ``plans.snapshots``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.quality import keep_first
from tradeloom.plans.ordered import row_index
from tradeloom.plans.staging import stage


def insert(df: DataFrame, rows: DataFrame, **stamps: Column) -> DataFrame:
    """Append rows; ``stamps`` (created/updated times) are set on the new ones."""
    return df.unionByName(rows.withColumns(stamps) if stamps else rows, allowMissingColumns=True)


def insert_new(df: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Append rows whose key is new (ON CONFLICT DO NOTHING); among equal new
    keys the first by ``order`` wins."""
    fresh = keep_first(rows, keys, order).join(df.select(*keys), keys, "left_anti")
    return df.unionByName(fresh)


def update_where(df: DataFrame, where: Column, **values: Column) -> DataFrame:
    """Set columns on the rows that match; a NULL condition does not match."""
    return df.withColumns(
        {n: F.when(where, v).otherwise(F.col(n)) if n in df.columns else F.when(where, v) for n, v in values.items()}
    )


def update_from(df: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Overwrite the columns of ``changes`` for its keys.

    ``changes`` has one row per key.  A marker tells "set to NULL" from "no
    change".
    """
    names = [c for c in changes.columns if c not in keys]
    fresh = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_hit"))
    joined = df.join(fresh, keys, "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns]
    )


def update_joined(df: DataFrame, other: DataFrame, on: list[str], **values: Column) -> DataFrame:
    """UPDATE ... FROM: set columns on rows with a partner in ``other``."""
    marked = df.join(other.select(*on).distinct().withColumn("_hit", F.lit(True)), on, "left")
    return update_where(marked, F.col("_hit"), **values).select(*df.columns)


def unset(df: DataFrame, *names: str) -> DataFrame:
    """Remove properties."""
    return df.drop(*names)


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """Delete matching rows; a NULL condition does not match."""
    return df.where(~F.coalesce(where, F.lit(False)))


def delete_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Delete rows whose key is listed (also DELETE ... IN (subquery))."""
    return df.join(keys.select(*on), on, "left_anti")


# (child table, foreign key, parent table, parent key, rule)
FOREIGN_KEYS = [
    ("goods", "merch_id", "users", "user_id", "cascade"),
    ("goods", "caty_id", "categories", "caty_id", "restrict"),
    ("orders", "user_id", "users", "user_id", "cascade"),
    ("orders", "good_id", "goods", "good_id", "restrict"),
    ("reviews", "user_id", "users", "user_id", "cascade"),
    ("reviews", "good_id", "goods", "good_id", "cascade"),
    ("purchase_history", "user_id", "users", "user_id", "cascade"),
    ("purchase_history", "order_id", "orders", "id", "cascade"),
    ("pickup_points", "addr_id", "addresses", "addr_id", "cascade"),
    ("warehouses", "addr_id", "addresses", "addr_id", "cascade"),
]


def cascade_delete(tables: dict[str, DataFrame], table: str, keys: DataFrame) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Delete rows by key and all rows that depend on them.

    Returns the tables after the delete and, per ``child.foreign_key``, the
    surviving rows that a RESTRICT rule says must not lose their parent.  The
    delete is allowed only when all of those are empty.  The keys that go are
    written down table by table, so a child meets its parents' lost keys in one
    scan of its own and no parent is worked out again.
    """
    primary = {t: k for _, _, t, k, _ in FOREIGN_KEYS} | {"reviews": "id", "purchase_history": "id", "orders": "id"}
    gone = {table: stage(tables[table].join(keys.select(primary[table]), primary[table], "left_semi").select(primary[table]).distinct(), "gone")}
    # Parents before children, so each table is visited once.
    for child in ("users", "categories", "addresses", "goods", "orders", "reviews", "purchase_history", "pickup_points", "warehouses"):
        if child == table or child not in tables:
            continue
        hits, rows = [], tables[child]
        for c, fk, parent, pk, rule in FOREIGN_KEYS:
            if c == child and parent in gone and rule == "cascade":
                hits.append(f"_gone_{fk}")
                rows = rows.join(gone[parent].select(F.col(pk).alias(fk), F.lit(True).alias(hits[-1])), fk, "left")
        if hits:
            gone[child] = stage(rows.where(F.coalesce(*hits, F.lit(False))).select(primary.get(child, "id")).distinct(), "gone")
    after = {
        t: df.join(gone[t].select(primary.get(t, "id")), primary.get(t, "id"), "left_anti") if t in gone else df
        for t, df in tables.items()
    }
    blocked = {
        f"{c}.{fk}": after[c].join(gone[parent].select(F.col(pk).alias(fk)), fk, "left_semi")
        for c, fk, parent, pk, rule in FOREIGN_KEYS
        if rule == "restrict" and parent in gone and c in after
    }
    return after, blocked


def detach_delete(nodes: DataFrame, key: str, where: Column, **edges: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delete nodes and every edge touching them."""
    lost = nodes.where(where).select(key)
    return nodes.join(lost, key, "left_anti"), {n: e.join(lost, key, "left_anti") for n, e in edges.items()}


def merge(
    df: DataFrame,
    changes: DataFrame,
    keys: list[str],
    on_create: dict[str, Column] | None = None,
    on_match: dict[str, Column] | None = None,
) -> DataFrame:
    """Upsert with separate settings for created and matched rows.

    Changes carry one row per key; columns they lack keep their old value.
    """
    names = [c for c in changes.columns if c not in keys]
    old = df.withColumn("_old", F.lit(True))
    new = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_new"))
    joined = old.join(new, keys, "full")
    created, matched = F.col("_old").isNull(), F.col("_old") & F.col("_new")
    touched = F.coalesce(F.col("_new"), F.lit(False))

    def value(c: str) -> Column:
        out = F.when(touched, F.col(f"_new_{c}")).otherwise(F.col(c)) if c in names else F.col(c)
        if on_create and c in on_create:
            out = F.when(created, on_create[c]).otherwise(out)
        if on_match and c in on_match:
            out = F.when(matched, on_match[c]).otherwise(out)
        return out.alias(c)

    return joined.select(*[F.col(c) if c in keys else value(c) for c in df.columns])


def with_new_keys(df: DataFrame, key: str, rows: DataFrame, order: list[str]) -> DataFrame:
    """New rows with keys going on after the largest one used (SERIAL)."""
    last = df.select(F.coalesce(F.max(key), F.lit(0))).scalar()
    numbered = row_index(rows, [], order, number="_pos")
    return numbered.withColumn(key, F.col("_pos") + last).drop("_pos")


def range_bucket(key: Column | str, width: int = 100_000, buckets: int = 10) -> Column:
    """Range partition of a 1-based key; -1 is the default partition."""
    key = F.col(key) if isinstance(key, str) else key
    number = F.floor((key - 1) / width)
    return F.when((number >= 0) & (number < buckets), number).otherwise(F.lit(-1).cast("bigint"))


def list_bucket(value: Column | str, **lists: list[str]) -> Column:
    """List partition: the name of the list holding the value, else 'default'."""
    value = F.col(value) if isinstance(value, str) else value
    out = F.lit("default")
    for name, members in lists.items():
        out = F.when(value.isin(*members), name).otherwise(out)
    return out


def write_partitioned(df: DataFrame, bucket: Column, path: str) -> tuple[int, int]:
    """Write a copy partitioned by ``bucket``; returns old and new row counts.

    Rebalancing gives each bucket few files, and a bucket holding most rows
    several writers.
    """
    df.withColumn("bucket", bucket).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    return df.count(), df.sparkSession.read.parquet(path).count()


def read_range(spark, path: str, key: str, low: int, high: int, width: int = 100_000, buckets: int = 10) -> DataFrame:
    """Rows with ``low <= key <= high``; the bucket filter prunes folders.

    A filter on the key alone cannot skip the folders of a derived bucket.
    """
    df = spark.read.parquet(path)
    first, last = (low - 1) // width, (high - 1) // width
    inside = F.col("bucket").between(first, last)
    if first < 0 or last >= buckets:
        inside = inside | (F.col("bucket") == -1)
    return df.where(inside & F.col(key).between(low, high))
