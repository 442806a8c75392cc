"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted ``target / source size`` times.  The whole
part is taken as it is; the fractional parts are settled in pairs: words move
from one document of the pair to the other, in a random direction that keeps
both expectations, until one of them is all in or all out.  The other goes on
to the next pair.  The words of a pair stay the same, so a source's total does.
Pairs are settled in buckets of a source first; what remains, one document per
bucket, is settled in fewer buckets, and so on to one per source.  That last
document closes the budget: it is taken up to the words still owed.

Randomness is a hash of the rows, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.llm.rows import packed, text_hash, unpacked
from tradeloom.llm.words import mix
from tradeloom.plans.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
# Documents settled in one task before the tree, and residuals per node of the tree.
BUCKET_ROWS = 10_000
FAN_IN = 256
WORD = r"[^\x20\x09-\x0D]+"
_CLOSE = 1e-9
_COPIES = 10_000


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, docs, target)`` from rows ``(source, size)``.

    Sources in code point order, null last, weigh ``weights`` over and over.
    They share ``share`` times all words; a target stops at ``cap`` times its
    source, and the excess goes to the others by weight.  Sorted by the level
    at which each source fills up, the common level is that of the first source
    that does not.  One row per source is ordered here, never documents.
    """
    if not 0 <= share <= cap:
        raise ValueError("the share must lie between 0 and the cap")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    one = W.partitionBy(F.lit(0))
    rank = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("_weight", weight).withColumn("_full", F.col("source_size") * cap / F.col("_weight"))
    by_level = one.orderBy("_full", F.col("source").asc_nulls_last())
    before, onward = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    left = F.sum("source_size").over(one) * share - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0.0))
    levels = ranked.withColumn("_level", left / F.sum("_weight").over(onward))
    common = F.min(F.when(F.col("_level") <= F.col("_full"), F.struct("_full", "_level"))).over(one)["_level"]
    target = F.least(F.col("source_size") * cap, F.coalesce(common * F.col("_weight"), F.col("source_size") * cap))
    return levels.withColumn("target", target).select("source", "source_size", "docs", "target")


def settle(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Settle fractions in a chain; returns the new fractions and the row left over (-1: none).

    ``size * p`` keeps its sum.  ``draw`` gives a number in [0, 1) per step.
    """
    p = p.tolist()
    size, draw = size.tolist(), draw.tolist()
    held = -1
    for i, here in enumerate(p):
        if here <= _CLOSE or here >= 1 - _CLOSE:
            p[i] = float(round(here))
            continue
        if held < 0:
            held = i
            continue
        a, b = size[held] * p[held], size[i] * here
        out = min(a, size[i] - b)  # words that may move from the held row to this one
        back = min(b, size[held] - a)
        move = out if draw[i] * (out + back) < back else -back
        p[held], p[i] = (a - move) / size[held], (b + move) / size[i]
        still = [j for j in (held, i) if _CLOSE < p[j] < 1 - _CLOSE]
        for j in (held, i):
            if j not in still:
                p[j] = float(round(p[j]))
        held = still[0] if still else -1
    return np.array(p), held


def _settled(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["key", "doc_id", "size"], kind="stable", ignore_index=True)
    keys = rows["key"].to_numpy(dtype=np.int64).view(np.uint64)
    level = np.uint64(int(rows["level"].iloc[0]) + 1)
    draw = (mix(keys + level * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    p, held = settle(rows["size"].to_numpy(dtype=np.float64), rows["p"].to_numpy(dtype=np.float64), draw)
    rows["p"] = p
    rows["open"] = np.arange(len(rows)) == held
    return rows


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with a number ``nth`` that tells equal ones apart, the same in every run.

    Equal rows are counted before they are shuffled and made again from the
    count, in two steps so that no list is long.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / _COPIES)))
    chunked = counted.withColumn("_chunk", chunk).withColumn("_first", F.col("_chunk") * _COPIES)
    last = F.least(F.col("_first") + _COPIES, F.col("_n")) - 1
    return chunked.select(*rows.columns, F.explode(F.sequence("_first", last)).alias("nth"))


def copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """``(doc_id, copy, size, source_size, target, copies, part)``: one row per row of ``docs``.

    ``copy`` is the text's xxhash64.  ``copies`` are whole takes; ``part`` is
    the number of first words taken besides, above 0 for one document of a
    source at most.  Null and empty texts have size 0 and are never taken;
    repeated rows are drawn one by one; an empty table gives no rows.
    """
    text = F.col("text").cast("string")
    sized = docs.select(
        "doc_id",
        F.col("source"),
        text_hash().alias("copy"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    rows = stage(_numbered(sized), "sizes")
    targets = stage(source_targets(rows, weights, share, cap), "targets")
    named = targets.withColumnRenamed("source", "_source")
    joined = rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(F.col("rate") + _CLOSE)
    key = F.xxhash64("doc_id", "copy", "size", "nth")
    wanted = (
        joined.withColumn("rate", rate)
        .withColumn("base", base.cast("bigint"))
        .withColumn("p", F.greatest(F.col("rate") - F.col("base"), F.lit(0.0)))
        .withColumn("key", key)
        .withColumn("level", F.lit(0))
        .withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(1)), F.ceil(F.col("docs") / bucket_rows)))
        .drop("rate", "docs", "nth")
    )
    settled_at_once = (F.col("size") == 0) | (F.col("p") <= _CLOSE)
    done = wanted.where(settled_at_once).withColumn("p", F.lit(0.0)).withColumn("open", F.lit(False))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema) + ", open boolean"
    most = targets.agg(F.max("docs")).first()[0] or 0
    nodes = -(-most // bucket_rows)
    level = 0
    current = wanted.where(~settled_at_once)
    while True:
        current = stage(current.groupBy("source", "bucket").applyInPandas(_settled, schema), f"settled{level}")
        if nodes <= 1:
            done = done.unionByName(current)
            break
        done = done.unionByName(current.where("not open"))
        level += 1
        nodes = -(-nodes // fan_in)
        current = current.where("open").drop("open").withColumn("level", F.lit(level)).withColumn("bucket", F.floor(F.col("bucket") / fan_in))
    owed = F.col("p") * F.col("size")
    whole = F.when(F.col("open"), F.lit(0)).otherwise(F.round("p").cast("bigint"))
    return done.select(
        "doc_id",
        "copy",
        "size",
        "source_size",
        "target",
        (F.when(F.col("size") > 0, F.col("base") + whole).otherwise(F.lit(0))).cast("bigint").alias("copies"),
        F.when(F.col("open"), F.round(owed)).otherwise(F.lit(0)).cast("bigint").alias("part"),
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it.

    A document that closes a source's budget is taken whole if at least half
    of it is owed.  Repeated rows (same id and text) pool their copies.
    """
    plan = copies(docs, weights, share, cap)
    close = F.when(F.col("part") * 2 >= F.greatest("size", F.lit(1)), F.lit(1)).otherwise(F.lit(0))
    takes = (
        plan.groupBy(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"))
        .agg(F.sum(F.col("copies") + close).alias("_takes"))
        .where("_takes > 0")
    )
    rows = packed(docs).dropDuplicates(["doc_id", "copy"])
    joined = rows.join(takes, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")))
    return unpacked(joined.select("row", F.explode(F.sequence(F.lit(1), F.col("_takes").cast("int")))))
