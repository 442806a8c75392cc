"""Near-duplicate texts by MinHash bands, verified by the Jaccard similarity of their shingles.

1. The fingerprint of a text, 128 values of 16 bits, is cut into 32 bands of 4
   values.  Texts that agree in a band share a bucket.
2. The texts of a bucket are compared by the values they agree in, block by
   block, and those that may be similar are joined into groups.  A block sends
   on only the links that its groups need, never all pairs.
3. The texts of a group are shipped to blocks, where the exact similarity of
   all pairs of the group is computed.

A text is read once however many copies it has.  Blocks hold a bounded number
of texts and bytes, and every two blocks of a bucket or group meet, so a group
of any size is compared whole and no task holds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.minhash import PERMUTATIONS, SHINGLE_WORDS, kept, shingle_hashes, signatures
from tradeloom.llm.rows import text_hash
from tradeloom.llm.words import find_words, slices
from tradeloom.plans.staging import stage

BANDS = 32
SIMILARITY = 0.8
# A pair of similarity 0.8 agrees in under 0.6 of 128 values once in ten million.
MAYBE = 0.6
# Most texts in a block, and the text bytes that a block should hold (one longer text is a block).
BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20
# Groups of at most so many texts in all (32 MB of ids) are sent to every task that reads texts.
BROADCAST_ROWS = 2_000_000
_BYTES = 2 * PERMUTATIONS // BANDS
_CHUNK = 8192


def _signed(docs: DataFrame, k: int) -> DataFrame:
    """``(class, bytes, signature)`` of every different text that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = find_words(part.column("text"))
            some = np.flatnonzero(words.counts)
            values = np.ascontiguousarray(kept(signatures(*shingle_hashes(words, k))).T)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("class").take(pa.array(some)),
                    part.column("bytes").take(pa.array(some)),
                    pa.array([values[i].tobytes() for i in some.tolist()], pa.binary()),
                ],
                names=["class", "bytes", "signature"],
            )

    rows = docs.select(text_hash().alias("class"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    signed = rows.withColumn("bytes", F.octet_length("text").cast("bigint")).mapInArrow(run, "class bigint, bytes bigint, signature binary")
    return stage(signed.groupBy("class").agg(F.first("bytes").alias("bytes"), F.first("signature").alias("signature")), "signatures")


def _in_tiles(rows: DataFrame, blocks: Column) -> DataFrame:
    """Deals the rows of each ``unit`` to blocks, and each row to the tiles ``(i, j)`` of its block with every other."""
    dealt = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("class", F.lit(7)), F.col("blocks")).cast("int"))
    tiled = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    tiled = tiled.select("unit", i, j, "block", *[c for c in rows.columns if c != "unit"])
    return tiled.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j", "block", "class")


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole tiles with the first row of each; a tile is held until its last row is there."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        first = _starts(rows)
        held = rows.slice(int(first[-1]))
        if len(first) > 1:
            yield rows.slice(0, int(first[-1])), first
    if held is not None:
        yield held, np.array([0, held.num_rows])


def _starts(rows: pa.RecordBatch) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    new[0] = True
    for name in ("unit", "i", "j"):
        value = rows.column(name).to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(new)


def _second_side(rows: pa.RecordBatch, low: int, high: int) -> int | None:
    """Where the second block of a tile begins; 0 in a tile of one block, None if one of two is empty."""
    block = rows.column("block").to_numpy()[low:high]
    if rows.column("i")[low] == rows.column("j")[low]:
        return 0
    return int(np.searchsorted(block, block[-1])) or None


def _spanning(near: Iterator[tuple[int, np.ndarray]], n: int) -> list[tuple[int, int]]:
    """The links that join what ``near`` joins, one less than rows at most."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, partners in near:
        for b in partners.tolist():
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((a, b))
    return out


def _maybe_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the texts of a tile that agree in enough values."""
    for rows, first in _tiles(batches):
        values = np.frombuffer(b"".join(rows.column("signature").to_pylist()), dtype=">u2").reshape(rows.num_rows, PERMUTATIONS)
        classes = rows.column("class").to_numpy()
        sizes = np.diff(first)
        pairs = first[:-1][sizes == 2]
        a = pairs[(values[pairs] == values[pairs + 1]).mean(axis=1) >= MAYBE]
        left, right = [classes[a]], [classes[a + 1]]
        for low, high in zip(first[:-1][sizes > 2].tolist(), first[1:][sizes > 2].tolist()):
            part, cut = values[low:high], _second_side(rows, low, high)
            if cut is None:
                continue

            # Two blocks: the first against the second; one block: each against those behind it.
            def near(part: np.ndarray = part, cut: int = cut) -> Iterator[tuple[int, np.ndarray]]:
                for x in range(cut or len(part)):
                    behind = cut or x + 1
                    yield x, np.flatnonzero((part[behind:] == part[x]).mean(axis=1) >= MAYBE) + behind

            links = np.array(_spanning(near(), len(part)), dtype=np.int64).reshape(-1, 2) + low
            left.append(classes[links[:, 0]])
            right.append(classes[links[:, 1]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])


def _groups(signed: DataFrame) -> DataFrame:
    """``(class, unit)``: the texts that may be similar to another one, and the group each is in."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.struct(i.alias("band"), F.substring(F.col("signature"), i * _BYTES + 1, F.lit(_BYTES)).alias("value")),
    )
    banded = signed.select("class", F.explode(bands).alias("b")).select("class", "b.band", "b.value")
    buckets = banded.groupBy("band", "value").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("class").alias("x"), F.min("class").alias("low"), F.max("class").alias("high")
    )
    # The same texts often share several bands; one bucket of them is enough.
    once = buckets.where("n > 1").groupBy("n", "x", "low", "high").agg(F.min(F.struct("band", "value")).alias("b")).select("n", "b.band", "b.value")
    members = banded.join(once, ["band", "value"]).select(F.xxhash64("band", "value").alias("unit"), "n", "class")
    tiles = _in_tiles(members.join(signed.select("class", "signature"), "class"), F.ceil(F.col("n") / BLOCK_ROWS))
    links = tiles.mapInArrow(_maybe_links, "a bigint, b bigint")
    return stage(components(links).select(F.col("node").alias("class"), F.col("root").alias("unit")), "groups")


def _shared(one: list[np.ndarray], two: list[np.ndarray] | None) -> np.ndarray:
    """Number of common shingles of every set of ``one`` and every set of ``two`` (or of ``one`` again)."""
    sets = one if two is None else one + two
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    repeated = counts > 1
    name = np.cumsum(repeated) - 1
    use = repeated[number]
    row, number = row[use], name[number[use]]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    out = np.zeros((len(one), len(sets) - len(one) if two is not None else len(one)))
    for low in range(0, int(repeated.sum()), _CHUNK):
        a, b = np.searchsorted(number, [low, low + _CHUNK])
        there = np.zeros((len(sets), _CHUNK), dtype=np.float32)
        there[row[a:b], number[a:b] - low] = 1
        out += there[: len(one)] @ (there if two is None else there[len(one) :]).T
    return out


def _compared(batches: Iterator[pa.RecordBatch], k: int, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per tile the classes of both sides, the similarity of every two, and which are links."""
    for rows, first in _tiles(batches):
        classes = rows.column("class").to_numpy()
        for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
            cut = _second_side(rows, low, high)
            if cut is None:
                continue
            sets = []
            for part in slices(iter([rows.slice(low, high - low)])):
                hashes, bounds = shingle_hashes(find_words(part.column("text")), k)
                sets += [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            size = np.array([len(s) for s in sets])
            one, two = (sets[:cut], sets[cut:]) if cut else (sets, None)
            a_size, b_size = (size[:cut], size[cut:]) if cut else (size, size)
            common = _shared(one, two)
            likeness = common / (a_size[:, None] + b_size[None, :] - common)
            near = likeness >= similarity
            if not cut:
                near = np.triu(near, 1)
            yield classes[low : low + len(one)], classes[low + cut : high], likeness, near


def _pairs(k: int, similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two, likeness, near in _compared(batches, k, similarity):
            x, y = np.nonzero(near)
            ends = [np.minimum(one[x], two[y]), np.maximum(one[x], two[y]), likeness[x, y]]
            yield pa.RecordBatch.from_arrays([pa.array(e) for e in ends], names=["a", "b", "similarity"])

    return run


def _counts(k: int, similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of each text inside a tile: a row per text, however many links there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two, _, near in _compared(batches, k, similarity):
            classes, links = np.concatenate([one, two]), np.concatenate([near.sum(axis=1), near.sum(axis=0)])
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(classes[some]), pa.array(links[some].astype(np.int64))], names=["class", "links"])

    return run


def _text_tiles(docs: DataFrame, k: int) -> DataFrame:
    """The texts that may have a partner, once each, in the tiles of their group."""
    signed = _signed(docs, k)
    groups = _groups(signed)
    sizes = groups.join(signed.select("class", "bytes"), "class").groupBy("unit").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("most")
    )
    wanted = stage(groups.join(sizes, "unit"), "wanted")
    few = wanted.count() <= BROADCAST_ROWS
    texts = docs.select(text_hash().alias("class"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(wanted) if few else wanted, "class").dropDuplicates(["class"])
    return _in_tiles(found.select("unit", "class", "text", "most"), F.col("most")).select("unit", "i", "j", "block", "class", "text")


def near_pairs(docs: DataFrame, k: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate texts: ``(a, b, similarity)`` between classes, and ``(doc_id, class)`` of every row.

    A class is a text; its id is the text's xxhash64, so copies are one class
    and never pair up; null texts are empty.  The Jaccard similarity of the
    sets of ``k``-word shingles is that of the whole texts.  A pair of
    similarity 0.8 shares none of the 32 bands once in ten million.  Texts
    without words are a class without partners.  The number of rows is that of
    the links there are; ``near_links`` only counts them.
    """
    pairs = _text_tiles(docs, k).mapInArrow(_pairs(k, similarity), "a bigint, b bigint, similarity double")
    return pairs, docs.select("doc_id", text_hash().alias("class"))


def near_links(docs: DataFrame, k: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, class, links)`` per row: the class of its text and the number of other texts near it."""
    counted = _text_tiles(docs, k).mapInArrow(_counts(k, similarity), "class bigint, links bigint")
    counts = counted.groupBy("class").agg(F.sum("links").alias("links"))
    members = docs.select("doc_id", text_hash().alias("class"))
    return members.join(counts, "class", "left").select("doc_id", "class", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
