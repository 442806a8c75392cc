"""SimHash near-duplicates with pivot distance tables.

Fingerprints of all texts are linked when they differ in few bits.  Distinct
fingerprints first meet in cells: of five blocks of bits, two fingerprints that
differ in at most three bits share two blocks whole.  In a cell every
fingerprint has a table of its distances to many reference fingerprints.
Distances are a metric, so a pair with some coordinate further apart than the
radius is discarded; the others are verified on all bits.  A cell gives the
links of its own components to their smallest member, never all pairs.  Cells
with many fingerprints are cut again on the bits they do not share.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.rows import kept, packed, unpacked
from tradeloom.llm.words import find_words, mix, shingle_ranges, slices
from tradeloom.plans.staging import stage

SHINGLE_WORDS = 3
RADIUS = 3
BLOCKS = 5
# Distinct fingerprints of a cell that are compared in one task.
CELL_ROWS = 4096
PIVOTS = 24
_SEED = 42
# Byte j of an entry is bit j of its index (little-endian, as the hashes' own bytes are read).
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1).view(np.uint64)


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per set ``hashes[bounds[i]:bounds[i+1]]`` the bits that over half of its hashes have; 0 for an empty set.

    Eight counters of eight bits are added at once, over at most 255 hashes.
    """
    n = np.diff(bounds)
    out = np.zeros(len(n), dtype=np.uint64)
    filled = np.flatnonzero(n)
    if not len(filled):
        return out
    blocks = -(-n[filled] // 255)
    first = np.cumsum(blocks) - blocks
    at = np.repeat(bounds[:-1][filled], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    octets = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums = np.add.reduceat(_SPREAD[octets[:, k]], at).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(sums.astype(np.int64), first, axis=0)
        bits = np.packbits(2 * ones > n[filled, None], axis=1, bitorder="little")[:, 0]
        out[filled] |= bits.astype(np.uint64) << np.uint64(8 * k)
    return out


def text_fingerprints(texts: pa.Array, words: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set when over half of the shingles' XXH64 have it."""
    found = find_words(texts, lower=True)
    start, end, bounds = shingle_ranges(found.first, words)
    n = np.diff(bounds)
    if not len(start):
        return np.zeros(len(n), dtype=np.uint64)
    # Words joined by one space: copy the bytes of all words, each with a space behind it.
    length = found.end - found.start + 1
    place = np.concatenate([[0], np.cumsum(length)])
    joined = np.full(place[-1], 32, dtype=np.uint8)
    move = np.arange(place[-1]) - np.repeat(place[:-1] - found.start, length)
    keep = np.ones(place[-1], dtype=bool)
    keep[place[1:] - 1] = False
    joined[keep] = found.data[move[keep]]
    view = memoryview(joined.tobytes())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(view[a:b], _SEED) for a, b in zip(place[start].tolist(), (place[end] - 1).tolist())),
        dtype=np.uint64,
        count=len(start),
    )
    return majority(hashes, bounds)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, copy, fp)`` for every row, ``copy`` the text's xxhash64; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fp = text_fingerprints(part.column("text"), words)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("copy"), pa.array(fp.view(np.int64))], names=["doc_id", "copy", "fp"]
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, copy bigint, fp bigint")


def references(count: int = PIVOTS, lanes: int = 1) -> np.ndarray:
    """Reference fingerprints, scattered over all bits by a fixed rule; a row each."""
    return mix(np.arange(1, count * lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(count, lanes)


def distance_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One row per pivot: differing bits of every fingerprint to it."""
    return np.stack([_apart(fps, p) for p in pivots]).astype(np.int16)


def near_within(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For distinct fingerprints of one cell, a row each: index of the first linked member of each.

    Sorted by the distance to the first pivot, partners lie in a band of that
    coordinate.  Blocks of rows are held against the band: pairs go by the
    largest coordinate difference, survivors by the bits themselves.
    """
    table = distance_table(fps, references(lanes=fps.shape[1]))
    by = np.argsort(table[0], kind="stable")
    table, values = table[:, by], fps[by]
    root = np.arange(len(values))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for low in range(0, len(values), 64):
        high = min(low + 64, len(values))
        while not np.array_equal(root, root[root]):
            root = root[root]
        stop = int(np.searchsorted(table[0], table[0, high - 1] + radius, side="right"))
        i, j = np.nonzero(np.abs(table[0, low:high, None] - table[0, None, low:stop]) <= radius)
        upper = i < j
        i, j = i[upper] + low, j[upper] + low
        for row in table[1:]:
            if not len(i):
                break
            near = np.abs(row[i] - row[j]) <= radius
            i, j = i[near], j[near]
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        close = _apart(values[i], values[j]) <= radius
        for a, b in zip(i[close].tolist(), j[close].tolist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    group = np.array([find(i) for i in range(len(values))], dtype=np.int64)
    # Back to positions in ``fps``; the first of them stands for a group.
    least = np.full(len(values), len(values))
    np.minimum.at(least, group, by)
    out = np.empty(len(values), dtype=np.int64)
    out[by] = least[group]
    return out


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _cut(bits: list[int]) -> list[list[int]]:
    return [bits[len(bits) * b // BLOCKS : len(bits) * (b + 1) // BLOCKS] for b in range(BLOCKS)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _cells(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Every fingerprint in the cells of the given masks of bits."""
    pairs = F.array(*[F.struct(F.lit(m).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("kept")) for m in masks])
    return rows.select("fp", F.explode(pairs).alias("c")).select("fp", "c.mask", "c.kept")


def _finer(mask: int) -> list[int]:
    free = [b for b in range(64) if not mask >> b & 1]
    blocks = _cut(free)
    return [_mask([b for b in range(64) if mask >> b & 1] + blocks[i] + blocks[j]) for i, j in combinations(range(BLOCKS), 2)]


def links(distinct: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``(a, b)`` with ``b < a`` that connect all fingerprints within ``radius`` bits.

    Pairs of fingerprints with at most ``BLOCKS - 2`` differing bits share two
    of the blocks, so ``radius`` may be 3 at most.
    """
    if radius > BLOCKS - 2:
        raise ValueError("a larger radius needs more blocks")

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = [], []
            for fps in batch.column("fps"):
                v = np.array(fps.as_py(), dtype=np.int64).view(np.uint64)
                least = near_within(v[:, None], radius)
                moved = np.flatnonzero(least != np.arange(len(v)))
                one.append(v[moved].view(np.int64))
                other.append(v[least[moved]].view(np.int64))
            if one:
                a, b = np.concatenate(one), np.concatenate(other)
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    blocks = _cut(list(range(64)))
    masks = [_mask(blocks[i] + blocks[j]) for i, j in combinations(range(BLOCKS), 2)]
    cells = _cells(distinct, masks)
    out = None
    while True:
        sizes = cells.groupBy("mask", "kept").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = stage(sizes, "cells")
        hot = sizes.where(F.col("n") > cell_rows)
        hot_masks = [r.mask for r in hot.select("mask").distinct().collect()]  # at most 10 to the depth
        # Bits left when two of five blocks are fixed three times: 14, so 16,384 fingerprints at most.
        last = all(sum(m >> b & 1 for b in range(64)) >= 48 for m in hot_masks)
        small = sizes if last else sizes.where(F.col("n") <= cell_rows)
        gathered = (
            cells.join(small.select("mask", "kept"), ["mask", "kept"], "left_semi")
            .groupBy("mask", "kept")
            .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
            .select("fps")
        )
        found = gathered.mapInArrow(inside, "a bigint, b bigint")
        out = found if out is None else out.unionByName(found)
        if last:
            return out.distinct()
        inner = cells.join(hot.select("mask", "kept"), ["mask", "kept"], "left_semi").select("fp", "mask").distinct()
        by_mask = {m: F.array(*[F.lit(x) for x in _finer(m)]) for m in hot_masks}
        choice = F.coalesce(*[F.when(F.col("mask") == m, arr) for m, arr in by_mask.items()])
        cells = stage(
            inner.select("fp", F.explode(choice).alias("mask"))
            .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("kept"))
            .distinct(),
            "finer",
        )


def _grouped(docs: DataFrame, words: int, cell_rows: int) -> DataFrame:
    """``(doc_id, copy, fp, first)``: ``first`` is the id and copy of the group's first row, rows without an id last."""
    marked = stage(fingerprints(docs, words), "simhash")
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("copy").alias("copy"))
    groups = stage(marked.groupBy("fp").agg(F.min(row).alias("least")), "fps")
    found = components(links(groups.select("fp"), cell_rows=cell_rows))
    rooted = groups.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = rooted.join(smallest, "root").select("fp", "first")
    return marked.join(named, "fp")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(doc_id, fp, component_id)``: one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    three differing bits.  Rows without a doc_id take part in linking; a
    component of such rows only has a null id.  An empty table gives no rows.
    """
    return _grouped(docs, words, cell_rows).select("doc_id", "fp", F.col("first.id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row of every group of near-duplicates: that with the smallest doc_id, of several such that with the smallest text hash.

    Groups are those of ``near_duplicates``.  Rows without an id come after all
    others; of repeated rows one stays; null and empty texts are one group;
    other columns are kept whatever their names.
    """
    first = _grouped(docs, words, cell_rows).select(F.col("first.id").alias("doc_id"), F.col("first.copy").alias("copy"))
    return unpacked(kept(packed(docs), first).dropDuplicates(["doc_id", "copy"]))
