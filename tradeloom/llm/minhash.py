"""MinHash fingerprints of texts; ``near_links`` finds near-duplicates with them.

A text is the set of its five-word shingles.  Each of 128 hash functions of a
universal family (multiply, add, keep the high half) gives its smallest value
over the set; two texts agree in a function with the probability of their
Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.llm.words import Words, find_words, mix, run_hashes, shingle_ranges, slices
from tradeloom.plans.staging import stage

SHINGLE_WORDS = 5
PERMUTATIONS = 128
# Bits of each smallest value that a fingerprint keeps.
KEPT_BITS = 16
_U = np.uint64
_A = mix(np.arange(1, PERMUTATIONS + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
_B = mix(np.arange(1, PERMUTATIONS + 1, dtype=_U) * _U(0xA5A3564E27F88693))
_NONE = np.uint32(2**32 - 1)
_CHUNK = 1 << 14


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Smallest value under every function, per set ``hashes[bounds[i]:bounds[i+1]]``; empty sets have the largest value.

    Works on stretches of 16,384 hashes, which stay in the processor's cache
    for all functions.
    """
    n = len(bounds) - 1
    out = np.full((PERMUTATIONS, n), _NONE, dtype=np.uint32)
    x = hashes >> _U(32)
    for low in range(0, len(x), _CHUNK):
        part = x[low : low + _CHUNK]
        i, j = np.searchsorted(bounds, low, side="right") - 1, np.searchsorted(bounds, low + len(part), side="left")
        rows = np.flatnonzero(np.diff(bounds[i : j + 1])) + i
        at = np.maximum(bounds[rows] - low, 0)
        work = np.empty(len(part), dtype=_U)
        for f in range(PERMUTATIONS):
            np.multiply(part, _A[f], out=work)
            np.add(work, _B[f], out=work)
            least = np.minimum.reduceat(work, at) >> _U(32)
            out[f, rows] = np.minimum(out[f, rows], least.astype(np.uint32))
    return out


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    start, end, bounds = shingle_ranges(words.first, k)
    return run_hashes(words.hashes(), start, end), bounds


def text_signatures(texts: pa.Array, k: int = SHINGLE_WORDS) -> np.ndarray:
    return signatures(*shingle_hashes(find_words(texts), k))


def kept(signature: np.ndarray) -> np.ndarray:
    return (signature & np.uint32((1 << KEPT_BITS) - 1)).astype(">u2")


def as_text(values: np.ndarray) -> list[str]:
    """Hexadecimal fingerprints of the columns of ``kept``."""
    return [row.tobytes().hex() for row in np.ascontiguousarray(values.T)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of fingerprints, freed of agreements by chance."""
    chance = 2.0**-KEPT_BITS
    return np.clip(((a == b).mean(axis=0) - chance) / (1 - chance), 0.0, 1.0)


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, copy, fingerprint)`` per row; null and empty texts share one fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = as_text(kept(text_signatures(part.column("text"), k)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("copy"), pa.array(values, pa.string())], names=["doc_id", "copy", "fingerprint"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, copy bigint, fingerprint string")


def _edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by bucket and id; each is compared with its edited text and with the next row of its bucket."""
    held: pa.RecordBatch | None = None
    names = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for part in slices(batches):
        rows = part if held is None else pa.concat_batches([held, part])
        held = rows.slice(rows.num_rows - 1)
        bucket = rows.column("bucket").to_numpy()
        own = rows.column("own").to_numpy(zero_copy_only=False)
        pairs = np.flatnonzero((bucket[1:] == bucket[:-1]) & own[:-1])
        if not len(pairs):
            continue
        texts = rows.column("text").to_pylist()
        edited = [_edited(texts[i], texts[i + 1]) for i in pairs.tolist()]
        values = kept(text_signatures(rows.column("text")))
        other = kept(text_signatures(pa.array(edited, pa.string())))
        at = pa.array(pairs)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").take(at),
                pa.array([len(texts[i]) for i in pairs.tolist()], pa.int64()),
                pa.array(edited, pa.string()),
                pa.array(as_text(values[:, pairs]), pa.string()),
                pa.array(as_text(other), pa.string()),
                pa.array(likeness(values[:, pairs], other)),
                pa.array(likeness(values[:, pairs], values[:, pairs + 1])),
            ],
            names=names,
        )


def compared_with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next)`` per row.

    The edited text has its last quarter replaced by the start of the next
    text in ascending doc_id, the first one's after the last.  Null texts are
    empty; rows without an id come first, repeated ids are ordered by text
    hash, and a table of one row is followed by itself.

    Rows are dealt to buckets by ranges of the id; each bucket also gets a copy
    of the row that follows it, so texts are shuffled once.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("order"), text.alias("text")
    )
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # Range limits: one number per bucket.
    limits = sorted(set(rows.stat.approxQuantile("order", [i / buckets for i in range(1, buckets)], 0.25 / buckets))) if buckets > 1 else []
    limits = [int(x) for x in limits]
    dealt = rows.withColumn("bucket", _bucket(F.col("order"), limits)).withColumn("copy", F.xxhash64("text"))

    # The first row of every bucket, told by id and text hash; one row per bucket.
    heads = dealt.groupBy("bucket").agg(F.min(F.struct("order", "copy")).alias("head"))
    one = W.partitionBy(F.lit(0)).orderBy("bucket")
    everything = W.partitionBy(F.lit(0))
    heads = heads.select(
        F.coalesce(F.lag("bucket").over(one), F.max("bucket").over(everything)).alias("bucket"),
        F.col("head.order").alias("order"),
        F.col("head.copy").alias("copy"),
    )
    heads = stage(heads, "heads")
    following = (
        dealt.select("doc_id", "order", "copy", "text")
        .join(F.broadcast(heads), ["order", "copy"])
        .dropDuplicates(["bucket"])
        .select("doc_id", "order", "bucket", "copy", "text", F.lit(False).alias("own"))
    )
    both = dealt.select("doc_id", "order", "bucket", "copy", "text", F.lit(True).alias("own")).unionByName(following)
    laid = both.repartition(max(1, len(limits) + 1), "bucket").sortWithinPartitions("bucket", F.desc("own"), "order", "copy")
    return laid.select("doc_id", "bucket", "own", "text").mapInArrow(
        _compared,
        "doc_id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _bucket(value: Column, limits: list[int]) -> Column:
    """Number of limits at or below the value, by halving: a tree of comparisons."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < limits[middle], between(low, middle)).otherwise(between(middle + 1, high))

    return between(0, len(limits))
