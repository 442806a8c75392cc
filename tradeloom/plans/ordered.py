"""Ordered computations that do not put one group into one task.

A window ``PARTITION BY key`` sends every row of a key to the same task, so a
key holding a third of the rows would stop the job.  Each function here splits
the ordered rows into ranges, numbers the ranges apart, and adds what came
before each range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.plans.sizing import chunk_count
from tradeloom.plans.staging import stage

CHUNK = "_chunk"
# Columns that only exist inside the functions here.
_INNER = "_row_index_"


def row_index(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    number: str = "rn",
    total: str | None = None,
    split: bool = True,
) -> DataFrame:
    """Add the 1-based position inside each key, and the key's row count.

    ``order`` must end in something unique.  With no ``keys`` the position is
    global.  ``split=False`` is a plain window, for callers who know that no
    key holds more rows than one task can sort; the data never decide.
    """
    clash = [c for c in df.columns if c.startswith(_INNER)]
    if clash:
        raise ValueError(f"column names beginning with {_INNER} are taken: {clash}")
    if not split:
        part = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
        out = df.withColumn(number, F.row_number().over(part.orderBy(*order)).cast("bigint"))
        return out.withColumn(total, F.count(F.lit(1)).over(part)) if total else out

    # Stored before use: range bounds are sampled, so the chunk of a row must
    # be decided once and then only read.
    chunk, count, before, everything = (f"{_INNER}{n}" for n in ("chunk", "n", "before", "total"))
    ranged = stage(
        df.repartitionByRange(chunk_count(df), *keys, *order).withColumn(chunk, F.spark_partition_id()),
        "ranged",
    )
    sizes = ranged.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias(count))
    # At most one row per chunk and key; a key spans few chunks unless it is hot.
    per_key = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    earlier = per_key.orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(k).alias(f"{_INNER}k{i}") for i, k in enumerate(keys)],
        F.col(chunk).alias(f"{_INNER}c"),
        F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(before),
        F.sum(count).over(per_key).alias(everything),
    )
    same = [F.col(k).eqNullSafe(F.col(f"{_INNER}k{i}")) for i, k in enumerate(keys)]
    joined = ranged.join(offsets, reduce(lambda a, b: a & b, same, F.col(chunk) == F.col(f"{_INNER}c")))
    local = F.row_number().over(W.partitionBy(chunk, *keys).orderBy(*order))
    out = joined.withColumn(number, local + F.col(before))
    if total:
        out = out.withColumn(total, F.col(everything))
    return out.drop(*[c for c in out.columns if c.startswith(_INNER)])


def sliding_frame(
    df: DataFrame,
    keys: list[str],
    position: str,
    preceding: int,
    aggregates: dict[str, Column],
    block: int = 100_000,
) -> DataFrame:
    """Aggregate over the last ``preceding`` rows and the current one.

    ``position`` is the row's 1-based index in its key.  Rows are cut into
    blocks of ``block`` positions; the last rows of a block are also handed to
    the next one, so no window partition exceeds ``block + preceding`` rows.
    """
    home = F.floor((F.col(position) - 1) / block)
    at_edge = F.pmod(F.col(position) - 1, F.lit(block)) >= block - preceding
    placed = df.withColumn(
        "_block", F.explode(F.when(at_edge, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    frame = W.partitionBy(*keys, "_block").orderBy(position).rowsBetween(-preceding, 0)
    out = placed.select("*", *[agg.over(frame).alias(name) for name, agg in aggregates.items()])
    return out.where(F.col("_block") == home).drop("_block")


def running_max(
    df: DataFrame, key: str, position: str, value: str, name: str, chunk_rows: int = 1_000_000
) -> DataFrame:
    """Largest ``value`` up to and including each row, by dense ``position``.

    Positions are cut into fixed ranges; the maximum of the earlier ranges is
    joined in, so a hot key is spread over as many tasks as it has ranges.
    """
    placed = df.withColumn(CHUNK, F.floor(F.col(position) / chunk_rows))
    peaks = placed.groupBy(key, CHUNK).agg(F.max(value).alias("_peak"))
    earlier = peaks.select(
        F.col(key).alias("_k"),
        F.col(CHUNK).alias("_c"),
        F.max("_peak")
        .over(W.partitionBy(key).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1))
        .alias("_earlier"),
    )
    joined = placed.join(earlier, F.col(key).eqNullSafe(F.col("_k")) & (F.col(CHUNK) == F.col("_c")))
    here = F.max(value).over(
        W.partitionBy(key, CHUNK).orderBy(position).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return joined.withColumn(name, F.greatest(here, F.col("_earlier"))).drop(CHUNK, "_k", "_c", "_earlier")


def rank_by_value(
    df: DataFrame, keys: list[str], value: str, rank: str = "rank", dense: str | None = None
) -> DataFrame:
    """RANK (and DENSE_RANK) by descending count ``value`` within ``keys``.

    Rows are first folded to one per distinct value: ``V`` distinct counts need
    at least ``V^2/2`` underlying rows, so this histogram stays small where the
    ranked rows do not.  Ranks are read off it and joined back.
    """
    histogram = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_rows"))
    part = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    higher = part.orderBy(F.col(value).desc_nulls_first())
    ranks = histogram.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(value).alias("_v"),
        (F.coalesce(F.sum("_rows").over(higher.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + 1).alias(rank),
        *([F.row_number().over(higher).cast("bigint").alias(dense)] if dense else []),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    cond = reduce(lambda a, b: a & b, same, F.col(value).eqNullSafe(F.col("_v")))
    return df.join(ranks, cond).drop("_v", *[f"_k{i}" for i in range(len(keys))])


def top_per_group(
    df: DataFrame, keys: list[str], order: list[str | Column], k: int, position: str | None = None
) -> DataFrame:
    """First ``k`` rows of each key.

    ``row_number() <= k`` lets Spark drop all but ``k`` rows per key before the
    shuffle, so a hot key never reaches one task whole.
    """
    rn = position or "_rn"
    out = df.withColumn(rn, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rn) <= k)
    return out if position else out.drop(rn)
