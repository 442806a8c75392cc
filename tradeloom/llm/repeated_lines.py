"""Lines that several documents share, found with two Bloom filters.

The filters are bit arrays for hashes seen once and seen twice.  Every task
fills a pair of its own; pairs are merged segment by segment: what either has
seen twice, or both have seen once, has been seen twice.  A line whose bits are
all in the second filter is a suspect; every repeated line is one, and a few
others are.  Only suspects are shuffled.  Their keys themselves are compared,
so the filters decide how much moves and never what is dropped.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.skew import join_by_key
from tradeloom.llm.words import mix, raw, slices, span_hashes
from tradeloom.plans.staging import stage

MIN_POINTS = 10
# Bits of a segment, and bits a line: with 16 bits a line about 1 line in 300 is a suspect for nothing.
SEGMENT = 1 << 20
BITS_PER_LINE = 16
# The second filter is sent to every task, so its size has a bound: 2^29 bits, 64 MB.  Beyond 32 million
# lines it fills up, and more lines are shuffled to be compared; the result does not depend on it.
MOST_BITS = 1 << 29
# Distinct hashes a task gathers before it hands on its filters.
CHUNK = 1 << 20
_NO_ID = 2**63 - 1
_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Lines:
    """Lines of a few texts and their keys, as byte ranges of ``data`` (the letters A-Z in lower case)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    key_start: np.ndarray
    key_end: np.ndarray
    judged: np.ndarray

    def keys(self, which: np.ndarray) -> list[str]:
        plain = self.data.tobytes()
        return [plain[a:b].decode("utf-8") for a, b in zip(self.key_start[which].tolist(), self.key_end[which].tolist())]

    def hashes(self, which: np.ndarray) -> np.ndarray:
        return span_hashes(self.data, self.key_start[which], self.key_end[which])

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_lines(texts: pa.Array, least: int = MIN_POINTS) -> Lines:
    """Lines of every text; a null or empty text has one empty line.

    ``judged`` marks the lines whose key, the line without white space at its
    ends, has at least ``least`` code points.
    """
    data, at = raw(texts)
    breaks = np.flatnonzero(data == 10)
    of_break = np.searchsorted(at, breaks, side="right") - 1
    per = np.bincount(of_break, minlength=len(at) - 1) + 1
    first = np.concatenate([[0], np.cumsum(per)])
    start, end = np.empty(first[-1], dtype=np.int64), np.empty(first[-1], dtype=np.int64)
    inner = np.ones(first[-1], dtype=bool)
    inner[first[:-1]] = False
    start[first[:-1]], start[inner] = at[:-1], breaks + 1
    inner[:] = True
    inner[first[1:] - 1] = False
    end[first[1:] - 1], end[inner] = at[1:], breaks
    solid = np.flatnonzero(~_SPACE[data])
    low, high = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = high > low
    key_start, key_end = start.copy(), start.copy()
    key_start[some], key_end[some] = solid[low[some]], solid[high[some] - 1] + 1
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    lowered = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    return Lines(lowered, start, end, first, key_start, key_end, points[key_end] - points[key_start] >= least)


def probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of every hash, and its places in the segment: a row of three for each."""
    h = mix(hashes)
    segment = (h >> _U(32)) % _U(max(1, bits // SEGMENT))
    wide = mix(h + _U(0x9E3779B97F4A7C15))
    size = _U(min(bits, SEGMENT) - 1)
    return segment.astype(np.int64), np.stack([(wide >> _U(s)) & size for s in (0, 21, 42)], axis=1).astype(np.int64)


def _filters(hashes: np.ndarray, bits: int) -> pa.RecordBatch:
    """The two filters of these hashes (one a document and key), a row per segment: places seen once, seen twice."""
    distinct, count = np.unique(hashes, return_counts=True)
    segment, places = probes(distinct, bits)
    rows = []
    for twice in (False, True):
        chosen = count > 1 if twice else np.ones(len(count), dtype=bool)
        rows.append(np.unique((segment[chosen, None] * SEGMENT + places[chosen]).reshape(-1)))
    segments = np.unique(segment)
    out = [[], []]
    for k, whole in enumerate(rows):
        low, high = np.searchsorted(whole, segments * SEGMENT), np.searchsorted(whole, (segments + 1) * SEGMENT)
        out[k] = [(whole[a:b] - s * SEGMENT).astype(np.uint32).tobytes() for a, b, s in zip(low.tolist(), high.tolist(), segments.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(segments), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], names=["segment", "once", "twice"])


def _own_keys(part: pa.RecordBatch) -> tuple[Lines, np.ndarray, np.ndarray, np.ndarray]:
    """Lines, and of the judged ones number, text and hash."""
    lines = find_lines(part.column("text"))
    judged = np.flatnonzero(lines.judged)
    return lines, judged, lines.text_of()[judged], lines.hashes(judged)


def seen_twice(texts: DataFrame, bits: int) -> DataFrame:
    """``(segment, bits)``: the second filter over all ``(doc, copy, text)``, a packed bit array per segment."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in slices(batches):
            _, _, text, hashes = _own_keys(part)
            doc = part.column("doc").to_numpy()[text]
            # A key counts once a document, wherever its lines stand.
            order = np.lexsort((doc, hashes))
            h, d = hashes[order], doc[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            held.append(h[new])
            n += len(held[-1])
            if n >= CHUNK:
                yield _filters(np.concatenate(held), bits)
                held, n = [], 0
        if n:
            yield _filters(np.concatenate(held), bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["segment", "bits"])

        for batch in batches:
            for segment, a, b in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice"))):
                if segment != now:
                    if now is not None and twice.any():
                        yield done()
                    now, once, twice = segment, np.zeros(SEGMENT, dtype=bool), np.zeros(SEGMENT, dtype=bool)
                a, b = np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32)
                twice[a[once[a]]] = True
                twice[b] = True
                once[a] = True
        if now is not None and twice.any():
            yield done()

    own = texts.mapInArrow(fill, "segment bigint, once binary, twice binary")
    sorted_ = own.repartition(max(1, min(64, bits // SEGMENT)), "segment").sortWithinPartitions("segment")
    return sorted_.mapInArrow(merge, "segment bigint, bits binary")


class Suspects:
    """The second filter inside a task."""

    def __init__(self, segments: dict[int, bytes], bits: int):
        self.bits = bits
        self.by = {s: np.frombuffer(zlib.decompress(b), dtype=np.uint8) for s, b in segments.items()}

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        segment, places = probes(hashes, self.bits)
        out = np.zeros(len(hashes), dtype=bool)
        for s in np.unique(segment).tolist():
            if s in self.by:
                own = np.flatnonzero(segment == s)
                at = places[own]
                out[own] = (self.by[s][at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1)
        return out


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(text).alias("copy"), text.alias("text"))


def _filter_bits(texts: DataFrame, most: int) -> int:
    lines = texts.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    return min(most, 1 << max(10, math.ceil(math.log2(BITS_PER_LINE * lines + 1))))


def _share(spark, filled: DataFrame) -> Broadcast:
    """Send the second filter to the tasks; at most ``MOST_BITS`` bits, an eighth of that in bytes."""
    return spark.sparkContext.broadcast({r.segment: zlib.compress(bytes(r.bits), 1) for r in filled.toLocalIterator()})


def _kept_text(text: str, dropped: np.ndarray) -> str:
    return "\n".join(line for line, gone in zip(text.split("\n"), dropped.tolist()) if not gone)


def without_repeated_lines(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept)``: every text without the lines that a document with a smaller id has.

    Texts are split at line feeds.  A line's key is the line without white
    space at its ends, A-Z in lower case.  Keys of ten code points or more that
    at least two documents hold lose all their lines but those of the smallest
    doc_id.  Rows of one doc_id are one document; rows without an id are one
    too, after all others.  A null or empty text is one empty line and stays; a
    text that loses all its lines becomes empty.  Repeated rows are judged
    alike, other columns are not carried, an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = _identified(docs)
    bits = _filter_bits(texts, most_bits)
    shared = _share(spark, seen_twice(texts, bits))

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Suspects(shared.value, bits)
        for part in slices(batches):
            lines, judged, text, hashes = _own_keys(part)
            hit = test(hashes)
            of, keys = text[hit], lines.keys(judged[hit])
            low = np.searchsorted(of, np.arange(part.num_rows + 1)).tolist()
            own = [list(dict.fromkeys(keys[a:b])) for a, b in zip(low, low[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("copy"), pa.array(np.diff(lines.first)), part.column("text"), pa.array(own, pa.list_(pa.string()))],
                names=["doc", "copy", "n_lines", "text", "keys"],
            )

    marked = stage(texts.mapInArrow(suspect, "doc bigint, copy bigint, n_lines bigint, text string, keys array<string>"), "lines")
    rows = marked.select("doc", "copy", F.explode("keys").alias("key"))
    found = rows.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n"))
    repeated = stage(found.where("least < most").select("key", "least", "n"), "repeated-lines")
    gone = join_by_key(rows, repeated, ["key"], "n").where("least < doc")
    per_text = gone.groupBy("doc", "copy").agg(F.collect_set("key").alias("drop"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            lines = find_lines(part.column("text"))
            own = part.column("drop").to_pylist()
            out, n_dropped = part.column("text").to_pylist(), np.zeros(part.num_rows, dtype=np.int64)
            for i in [i for i, keys in enumerate(own) if keys]:
                at = np.arange(lines.first[i], lines.first[i + 1])
                drop, set_ = np.zeros(len(at), dtype=bool), set(own[i])
                judged = np.flatnonzero(lines.judged[at])
                drop[judged] = [k in set_ for k in lines.keys(at[judged])]
                out[i], n_dropped[i] = _kept_text(out[i], drop), int(drop.sum())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("n_lines"), pa.array(n_dropped), pa.array(out, pa.string())], names=["doc", "n_lines", "n_dropped", "kept"]
            )

    # Texts without a suspect line are done; the others meet what they lose.
    done = marked.where(F.size("keys") == 0).select("doc", "n_lines", F.lit(0).cast("bigint").alias("n_dropped"), F.col("text").alias("kept"))
    open_ = marked.where(F.size("keys") > 0).drop("keys").join(per_text, ["doc", "copy"], "left")
    changed = open_.select("doc", "n_lines", "text", "drop").mapInArrow(rewrite, "doc bigint, n_lines bigint, n_dropped bigint, kept string")
    return done.unionByName(changed).select(F.when(F.col("doc") < _NO_ID, F.col("doc")).alias("doc_id"), "n_lines", "n_dropped", "kept")
