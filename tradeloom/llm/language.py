"""Language of texts by the nearest of several centroids per language.

A text is a vector of hashed byte 2-grams and 3-grams of its lower-cased
letters, weighted by TF-IDF and scaled to length 1.  Document frequencies are
counted over all training texts.  The vectors of a bounded sample of each
language's training texts are clustered by spherical k-means; a text gets the
language of the centroid with the highest cosine.  A text further from it than
nearly all members of that cluster is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.words import mix, raw, slices

FEATURES = 4096
CENTROIDS = 4
# Training texts per language that are clustered, drawn by a hash of the id.
SAMPLE = 1000
ROUNDS = 10
# A text is rejected beyond this multiple of the distance that 99 % of a cluster's members keep.
SLACK = 1.25
UNKNOWN = "und"
_GAP = 32


def _letters() -> np.ndarray:
    """Bytes of ASCII letters and of all other scripts as they are, everything else a gap."""
    table = np.full(256, _GAP, dtype=np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_TABLE = _letters()


def count_vectors(texts: pa.Array) -> np.ndarray:
    """Counts of hashed byte n-grams, one row per text."""
    lowered = pa.array([t.lower() if t else "" for t in texts.to_pylist()], pa.string())
    data, at = raw(lowered)
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    if len(data) < 2:
        return out
    b = _TABLE[data].astype(np.uint64)
    pair = (b[:-1] << np.uint64(8)) | b[1:]
    triple = (pair[:-1] << np.uint64(8)) | b[2:] | np.uint64(1 << 24)
    slot2 = (mix(pair) >> np.uint64(52)).astype(np.int64)
    slot3 = (mix(triple) >> np.uint64(52)).astype(np.int64)
    two_gaps = (b[:-1] == _GAP) & (b[1:] == _GAP)
    slot2[two_gaps] = -1
    slot3[two_gaps[:-1] | two_gaps[1:]] = -1
    for i, (low, high) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        for slots, n in ((slot2, 2), (slot3, 3)):
            own = slots[low : max(low, high - n + 1)]
            out[i] += np.bincount(own[own >= 0], minlength=FEATURES)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length 1; TF grows with the logarithm of the count."""
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


@dataclass
class Model:
    """Centroids (rows of length 1), their languages and the distances they accept."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    radius: np.ndarray


def cluster(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart members: centroids and the distance that 99 % of each one's members keep."""
    k = min(k, len(vectors))
    start = [0]
    nearest = vectors @ vectors[0]
    while len(start) < k:
        start.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[start[-1]])
    centroids = vectors[start].copy()
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(axis=1)
        for c in range(k):
            total = vectors[own == c].sum(axis=0)
            norm = np.linalg.norm(total)
            if norm > 0:
                centroids[c] = total / norm
    cosine = vectors @ centroids.T
    own = cosine.argmax(axis=1)
    radius = np.array([np.quantile(1 - cosine[own == c, c], 0.99) if (own == c).any() else 0.0 for c in range(k)])
    return centroids, radius


def held_out() -> Column:
    """True where crc32 of the id as text leaves 0 modulo 5; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0


def train(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """Fit on rows with a language that are not held out.

    What reaches the driver is the model: one number per feature, and ``k``
    vectors per language.  Repeated rows count once in the clustered sample.
    """
    rows = docs.where(F.col("lang").isNotNull() & ~held_out()).select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES, dtype=np.int64), 0
        for part in slices(batches):
            seen += (count_vectors(part.column("text")) > 0).sum(axis=0)
            n += part.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, FEATURES)), pa.array(np.append(n, seen))], names=["slot", "n"])

    totals = rows.select("text").mapInArrow(frequencies, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    counted = {r.slot: r.n for r in totals.collect()}  # one row per feature
    n = counted.get(-1, 0)
    seen = np.array([counted.get(i, 0) for i in range(FEATURES)], dtype=np.float64)
    idf = (np.log((n + 1) / (seen + 1)) + 1).astype(np.float32)

    # A little more than the sample is drawn, by a hash of id and text; a language of few texts goes in whole.
    # One rate a language goes to the tasks, as k vectors a language do later; texts that are not drawn stay where they are.
    rates = rows.groupBy("lang").agg((F.lit(1.2 * sample) / F.count(F.lit(1))).alias("rate"))
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.withColumn("draw", draw).join(F.broadcast(rates), "lang").where("draw < rate")
    picked = drawn.select("doc_id", "lang", "text").dropDuplicates()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            v = weighted(count_vectors(part.column("text")), idf)
            good = np.flatnonzero(v.any(axis=1))
            packed = pa.array([v[i].tobytes() for i in good.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(good)), part.column("doc_id").take(pa.array(good)), packed], names=["lang", "doc_id", "v"])

    def clusters(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["doc_id", "v"], kind="stable").head(sample)
        c, radius = cluster(np.stack([np.frombuffer(x, dtype=np.float32) for x in own["v"]]), k)
        return pd.DataFrame({"lang": own["lang"].iloc[0], "v": [x.astype(np.float32).tobytes() for x in c], "radius": radius})

    id_type = rows.schema["doc_id"].dataType.simpleString()
    made = picked.mapInArrow(vectors, f"lang string, doc_id {id_type}, v binary").groupBy("lang").applyInPandas(clusters, "lang string, v binary, radius double")
    found = sorted(made.collect(), key=lambda r: (r.lang, bytes(r.v)))  # k rows per language
    centroids = np.stack([np.frombuffer(r.v, dtype=np.float32) for r in found]) if found else np.zeros((0, FEATURES), dtype=np.float32)
    return Model(idf, centroids, [r.lang for r in found], np.array([r.radius for r in found]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` per row, from the text alone.

    ``score`` is the cosine to the nearest centroid.  A text that is null or
    has no letter is ``und`` with score 0, as is every text when nothing was
    learned.  Ties go to the first language by name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n = part.num_rows
            known = part.column("lettered").to_numpy(zero_copy_only=False)
            names, score, rejected = np.full(n, UNKNOWN, dtype=object), np.zeros(n), ~known
            if len(model.centroids):
                cosine = weighted(count_vectors(part.column("text")), model.idf) @ model.centroids.T
                best = cosine.argmax(axis=1)
                names = np.where(known, np.array(model.languages, dtype=object)[best], names)
                top = np.clip(cosine[np.arange(n), best].astype(np.float64), 0.0, 1.0)
                score = np.where(known, top, 0.0)
                rejected = rejected | (1 - top > SLACK * model.radius[best] + 1e-9)
            else:
                rejected = np.ones(n, dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), text.rlike(r"\p{L}").alias("lettered"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame) -> DataFrame:
    """Predict every row of ``docs`` with a model learned from those of its rows that are not held out."""
    out = predict(docs, train(docs))
    return out.withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score", "rejected")
