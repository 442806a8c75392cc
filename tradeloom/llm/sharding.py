"""Shards by a weighted hash tree: region, rack and shard are drawn one below the other.

At every node a row draws one number per child from a hash of its key and the
child's name; the child with the smallest ``-ln(draw) / weight`` wins, so a
child gets rows in proportion to its weight, and a change of weights moves rows
only into the children that grew and out of those that shrank.  Below a node
whose weights stayed as they were nothing moves.  A shard added where all
regions are full opens a region of its own and takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.plans.staging import stage

SHARDS = 16
RACK_SHARDS = 4
REGION_RACKS = 2
# First hex digits of the hash that cut a shard for numbering its rows.
BUCKET_DIGITS = 2
# A draw uses 13 hex digits: whole numbers below 2^52 are exact as doubles.
_DIGITS = 13

Tree = dict[int, dict[int, dict[int, float]]]


def tree(weights: Sequence[float]) -> Tree:
    """``{region: {rack: {shard: weight}}}``, filled shard by shard."""
    out: Tree = {}
    for shard, weight in enumerate(weights):
        if not weight > 0:
            raise ValueError("shard weights must be above 0")
        rack = shard // RACK_SHARDS
        out.setdefault(rack // REGION_RACKS, {}).setdefault(rack, {})[shard] = float(weight)
    return out


def grown(old: Tree) -> Tree:
    """The tree with one more shard of weight 1, in a region of its own: no other weight changes, so rows only move into it."""
    racks = {n: rack for region in old.values() for n, rack in region.items()}
    shard = 1 + max(n for rack in racks.values() for n in rack)
    return {**old, max(old) + 1: {max(racks) + 1: {shard: 1.0}}}


def _draw(key: Column, node: str, weight: float) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(f"{node}:"), key)), 1, _DIGITS)
    u = (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(16**_DIGITS))
    return -F.log(u) / F.lit(weight)


def _pick(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    drawn = [F.struct(_draw(key, f"{level}{n}", w).alias("draw"), F.lit(n).alias("child")) for n, w in weights.items()]
    return F.least(*drawn)["child"]


def _below(chosen: str, picks: dict[int, Column]) -> Column:
    return F.coalesce(*[F.when(F.col(chosen) == n, pick) for n, pick in picks.items()])


def _total(node) -> float:
    return sum(_total(x) for x in node.values()) if isinstance(node, dict) else node


def _descended(rows: DataFrame, key: str, regions: Tree, name: str) -> DataFrame:
    racks = {n: rack for region in regions.values() for n, rack in region.items()}
    k = F.col(key)
    return (
        rows.withColumn("_region", _pick(k, "region", {n: _total(x) for n, x in regions.items()}))
        .withColumn("_rack", _below("_region", {r: _pick(k, "rack", {n: _total(x) for n, x in region.items()}) for r, region in regions.items()}))
        .withColumn(name, _below("_rack", {n: _pick(k, "shard", rack) for n, rack in racks.items()}))
        .drop("_region", "_rack")
    )


def _weights(shards: int, weights: Sequence[float] | None) -> list[float]:
    out = [1.0] * shards if weights is None else list(weights)
    if len(out) != shards or not out:
        raise ValueError("one weight per shard, and one shard at least")
    return out


def with_shard(rows: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None, name: str = "shard") -> DataFrame:
    """Add the shard of every row by its ``doc_id``; no shuffle.

    Rows without an id share one key; a column of the same name is replaced.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = _descended(rows.select(F.struct("*").alias("row"), key.alias("_key")), "_key", tree(_weights(shards, weights)), "_shard")
    others = [F.col("row").getField(c).alias(c) for c in rows.columns if c.lower() != name.lower()]
    return placed.select(*others, F.col("_shard").cast("int").alias(name))


def shard_plan(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row of ``docs``.

    The law is ``key``: doc_id and the shard weights decide.  ``size`` is the
    text's UTF-8 bytes plus 1 (null text: 1, and a null checksum).  Slots count
    from 0 in every shard; repeated rows get neighbouring slots.
    ``grown_shard`` is the shard if one of weight 1 is added, in a region of
    its own, so that rows move into it alone at any number of shards.  Rows are
    numbered in buckets of a shard and moved up by the buckets before, so no
    task holds a shard.
    """
    own = tree(_weights(shards, weights))
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = rows.withColumn("_key", key)
    placed = _descended(_descended(rows, "_key", own, "shard"), "_key", grown(own), "grown_shard")
    spread = F.substring(F.md5(F.concat_ws(":", "_key", F.col("size").cast("string"))), 1, BUCKET_DIGITS)
    placed = stage(placed.withColumn("_bucket", spread).drop("_key"), "shards")

    # At most shards * 16^BUCKET_DIGITS rows.
    counts = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = W.partitionBy("shard", "_bucket").orderBy("doc_id", "size", "text_crc32")
    numbered = placed.withColumn("_here", F.row_number().over(order) - 1).join(F.broadcast(offsets), ["shard", "_bucket"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("_before") + F.col("_here")).cast("bigint").alias("slot"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )
