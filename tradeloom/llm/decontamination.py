"""Benchmark items found inside documents of any length.

Containment is the share of an item's distinct five-word shingles that a
document has; an item of one to four words is one shingle, its whole word
sequence, and is looked for as that wherever it stands.  Items are split into
partitions by size.  An item's sketch is its smallest shingle hashes (bottom-k
MinHash), with k set by its size: an item of ``q`` shingles needs ``n =
ceil(0.8 q)`` of them, so whatever document contains it has at least one of any
``q - n + 1``.  Documents are searched whole: a shingle is looked up if some
partition of its length accepts it, having a sketch hash as high and an item
that needs no more shingles than the document has.  This loses no document;
candidates are verified by counting the item's shingles themselves.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradeloom.llm.rows import kept, packed, text_hash, unpacked
from tradeloom.plans.staging import stage

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# A sketch or shingle table up to so many rows (under 20 MB) is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 300_000


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null and empty texts give an empty array."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _shingles(rows: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """One row per word position and length that fits: ``keep`` columns, ``length``, the hash ``h``, words and position ``i``."""
    n, many = F.size("words"), len(lengths)
    # One generator for both, so that the words are never copied from row to row.
    last = (n - min(lengths) + 1) * many - 1
    at = rows.where(n >= min(lengths)).select(*keep, "words", F.explode(F.sequence(F.lit(0), last)).alias("_at"))
    i, which = F.floor(F.col("_at") / many).cast("int"), F.pmod("_at", F.lit(many))
    length = F.get(F.array(*map(F.lit, lengths)), which) if many > 1 else F.lit(lengths[0])
    at = at.withColumn("i", i).withColumn("length", length).drop("_at").where(F.col("i") + F.col("length") <= n)
    hashes = [F.xxhash64(*[F.get("words", F.col("i") + j) for j in range(k)]) for k in lengths]
    if many == 1:
        return at.withColumn("h", hashes[0])
    return at.withColumn("h", F.coalesce(*[F.when(F.col("length") == k, h) for k, h in zip(lengths, hashes)]))


def _text_of() -> Column:
    return F.array_join(F.slice("words", F.col("i") + 1, F.col("length")), " ")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame, k: int = SHINGLE_WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """Distinct shingles of every item with the item's size partition, need, and sketch membership.

    An item of fewer than ``k`` words has one shingle of their number.
    """
    plain = items.select("item_id", F.xxhash64(F.col("item_id"), F.col("text").cast("string")).alias("item"), _words(F.col("text")).alias("words"))
    own = F.least(F.size("words"), F.lit(k))
    sized = _shingles(plain, ["item_id", "item"], list(range(1, k + 1))).where(F.col("length") == own)
    each = sized.select("item_id", "item", "length", "h", _text_of().alias("shingle")).distinct()
    own = W.partitionBy("item")
    counted = each.withColumn("q", F.count(F.lit(1)).over(own))
    need = F.ceil(F.col("q") * F.lit(containment) - F.lit(1e-9)).cast("bigint")
    return (
        counted.withColumn("need", need)
        .withColumn("partition", F.floor(F.log2("q")).cast("int"))
        .withColumn("sketch", F.row_number().over(own.orderBy("h", "shingle")) <= F.col("q") - F.col("need") + 1)
    )


def contained_items(docs: DataFrame, items: DataFrame, k: int = SHINGLE_WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, item_id, item_shingles, found, containment)`` for every document that has at least that share of an item.

    Words are compared in lower case without punctuation.  An item of one to
    four words is contained where its words follow each other.  Null and empty
    texts on either side match nothing.  Repeated rows give one result; texts
    under one doc_id are judged apart, and the better one counts.
    """
    best = _found(docs, items, k, containment).groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("found") / F.col("q"), "q", "found")).alias("b"))
    return best.select(
        "doc_id", "item_id", F.col("b.q").alias("item_shingles"), F.col("b.found").alias("found"), (F.col("b.found") / F.col("b.q")).alias("containment")
    )


def _found(docs: DataFrame, items: DataFrame, k: int, containment: float) -> DataFrame:
    """``(doc_id, copy, item, item_id, q, need, found)`` per text and item contained."""
    shingles = stage(item_shingles(items, k, containment), "items")
    shingle_rows = shingles.count()
    sketch = shingles.where("sketch")
    # What each partition accepts, a row a length and power of two of the size: no sketch hash above its highest,
    # no document with fewer shingles than its least need.
    accepts = sketch.groupBy("length", "partition").agg(F.max("h").alias("highest"), F.min("need").alias("need")).collect()
    lengths = sorted({r.length for r in accepts}) or [k]
    accepted = F.lit(False)
    for r in accepts:
        accepted |= (F.col("length") == r.length) & (F.col("h") <= r.highest) & (F.col("shingles") >= r.need)
    texts = docs.select("doc_id", text_hash().alias("copy"), _words(F.col("text")).alias("words"))

    probes = _shingles(texts, ["doc_id", "copy"], lengths).withColumn("shingles", F.size("words") - F.col("length") + 1)
    hits = (
        probes.where(accepted)
        .select("doc_id", "copy", "h", "shingles")
        .join(_small(sketch.select("h", "item", "need"), shingle_rows), "h")
        .where("shingles >= need")
    )
    candidates = stage(hits.select("doc_id", "copy", "item").distinct(), "candidates")

    searched = candidates.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).distinct()
    suspects = texts.join(searched, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")), "left_semi")
    seen = _shingles(suspects, ["doc_id", "copy"], lengths).join(_small(shingles, shingle_rows), ["h", "length"]).where(_text_of() == F.col("shingle"))
    found = (
        seen.select("doc_id", "copy", "item", "item_id", "q", "need", "h", "shingle")
        .distinct()
        .groupBy("doc_id", "copy", "item", "item_id", "q", "need")
        .agg(F.count(F.lit(1)).alias("found"))
        .where("found >= need")
    )
    sought = candidates.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), F.col("item").alias("_item"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")) & (F.col("item") == F.col("_item"))
    return found.join(sought, same, "left_semi")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that contain no benchmark item; of texts under one doc_id only those that do go."""
    return unpacked(kept(packed(docs), _found(docs, items, SHINGLE_WORDS, CONTAINMENT), "left_anti"))
