"""Tokens of two tokenizers aligned over the bytes of the same text.

Both tokenizers cut a text's bytes; where a token of each ends at the same
byte, a group ends.  The common ends are found by galloping: every end of the
shorter list looks for itself in the longer one, by steps that double until it
is passed, then by halving what lies between.  Ranks of the common ends slice
both token lists into groups, and inside a group the ranks of the other list's
ends give the tokens that a token overlaps, its links.

How often an id pair is linked is counted over all texts.  Texts lie in blocks
of a few megabytes; a block's distinct pairs, not its links, meet the counts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.words import slices
from tradeloom.plans.staging import stage

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Text bytes of a block, a row counting 64 at least; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
# A longer run of white space is left to the slower library, which the fast one's pattern cannot match.
BLANKS = 100_000
_LONG_BLANK = re.compile(r"\s{%d}" % BLANKS)


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable bytes as they are, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _sizes(names: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(names) + 1, dtype=np.int64)
    out[list(names)] = [len(b) for b in names.values()]
    return out


class ByteTokens:
    """A byte-level BPE file: ids of texts without special tokens, and every id's bytes."""

    def __init__(self, vocabulary: str = BYTE_VOCABULARY):
        self.path = vocabulary
        told = json.loads(Path(vocabulary).read_text(encoding="utf-8"))
        letters = _byte_letters()
        special = {t["id"] for t in told["added_tokens"]}
        names = {i: name for name, i in told["model"]["vocab"].items() if i not in special}
        self.bytes = {i: bytes(letters[c] for c in name) for i, name in names.items()}
        # In such a file ids rise with the merges, so an id is a token's rank.
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        ids = [told["model"]["vocab"]["".join(m)] for m in merges]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            raise ValueError("ids do not rise with the merges")
        # Fixed value: how the vocabulary's texts were cut before merging.
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens={})
        self.slow = None
        self.sizes = _sizes(self.bytes)

    def encode(self, text: str) -> list[int]:
        if not _LONG_BLANK.search(text):
            return self.fast.encode_ordinary(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """A sentencepiece model: ids of texts, and every id's bytes."""

    def __init__(self, vocabulary: str = PIECE_VOCABULARY):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode("utf-8")
        self.sizes = _sizes(self.bytes)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


def gallop(short: np.ndarray, long: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """First index of ``long[low:high]`` (rising) whose value is not below each of ``short``; ``high`` if there is none.

    Every search sets out from ``guess``, doubles its steps towards its value
    until it has passed it, and halves the bracket; searches go on together.
    """
    low, high = low.astype(np.int64).copy(), high.astype(np.int64).copy()
    at = np.clip(guess, low, np.maximum(high - 1, low))
    some = low < high
    below = np.zeros(len(short), dtype=bool)
    below[some] = long[at[some]] < short[some]
    # Invariant: all before ``low`` are below the value, all from ``high`` on are not.
    low = np.where(some & below, at + 1, low)
    high = np.where(some & ~below, at, high)
    for up in (True, False):
        going = np.flatnonzero(some & (below == up) & (low < high))
        step = 1
        while len(going):
            probe = np.minimum(low[going] + step - 1, high[going] - 1) if up else np.maximum(high[going] - step, low[going])
            less = long[probe] < short[going]
            passed = ~less if up else less
            low[going[less]] = probe[less] + 1
            high[going[~less]] = probe[~less]
            going = going[~passed]
            going = going[low[going] < high[going]]
            step *= 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        less = long[middle] < short[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
        going = going[low[going] < high[going]]
    return low


@dataclass
class Aligned:
    """Token lists of a few texts, one after the other.

    ``first_a`` and ``first_b`` are the first tokens of each text, ``cut_a``
    and ``cut_b`` the tokens one past each group, ``cuts`` the first group of
    each text.
    """

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    cuts: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, a, b)`` tokens of every link: a token meets all tokens between the ranks of its two ends."""
        n = len(self.first_a) - 1
        text = np.repeat(np.arange(n), np.diff(self.first_a))
        low, high = self.first_b[text], self.first_b[text + 1]
        rank = np.arange(len(self.a)) - self.first_a[text]
        guess = low + rank * np.maximum(high - low, 1) // np.maximum(np.diff(self.first_a)[text], 1)
        last = gallop(self.end_a, self.end_b, low, high, guess)
        # A token begins where the one before ends: if a token of the other list ends there too, that one is not met.
        begin = np.where(rank > 0, np.concatenate([[0], last[:-1]])[: len(last)], low)
        at_cut = np.zeros(len(self.a) + 1, dtype=bool)
        at_cut[self.cut_a] = True
        begin += at_cut[:-1] & (rank > 0)
        many = last - begin + 1
        one = np.repeat(np.arange(len(self.a)), many)
        other = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
        return text[one], one, other


def align(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    """Groups of the texts' tokens; ``sizes_*`` are byte lengths by id, and both lists of a text cover the same bytes."""
    end_a, end_b = np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b])
    n_a, n_b = np.diff(first_a), np.diff(first_b)
    fewer_a = n_a <= n_b
    cut_a, cut_b = [], []
    for from_a in (True, False):
        first, other = (first_a, first_b) if from_a else (first_b, first_a)
        ends, others = (end_a, end_b) if from_a else (end_b, end_a)
        n, m = np.diff(first), np.diff(other)
        text = np.repeat(np.arange(len(n)), np.where(fewer_a == from_a, n, 0))
        if not len(text):
            continue
        of = np.flatnonzero(np.repeat(fewer_a == from_a, n))
        low, high = other[text], other[text + 1]
        found = gallop(ends[of], others, low, high, low + (of - first[text]) * m[text] // np.maximum(n[text], 1))
        hit = found < high
        hit[hit] = others[found[hit]] == ends[of[hit]]
        mine, theirs = of[hit] + 1, found[hit] + 1
        cut_a.append(mine if from_a else theirs)
        cut_b.append(theirs if from_a else mine)
    cut_a, cut_b = (np.sort(np.concatenate(x)) if x else np.zeros(0, dtype=np.int64) for x in (cut_a, cut_b))
    return Aligned(a, b, first_a, first_b, end_a, end_b, cut_a, cut_b, np.searchsorted(cut_a, first_a, side="right"))


@lru_cache(maxsize=1)
def _names(a_ids: int, b_ids: int) -> list[str]:
    """Decimal ids with what follows them: inside a group, and at a group's end of their list."""
    return [f"{i}{s}" for i in range(a_ids) for s in ",|"] + [f"{i}{s}" for i in range(b_ids) for s in ",;"]


def group_texts(found: Aligned, a_ids: int, b_ids: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for every text; empty for texts without tokens."""
    last_a, last_b = np.zeros(len(found.a), dtype=np.int64), np.zeros(len(found.b), dtype=np.int64)
    last_a[found.cut_a - 1] = 1
    last_b[found.cut_b - 1] = 1
    # A token stands behind its own list's earlier tokens and the other list's tokens of earlier groups.
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    before_b, upto_a = np.concatenate([[0], found.cut_b]), np.concatenate([found.cut_a, [len(found.a)]])
    code = np.empty(len(found.a) + len(found.b), dtype=np.int64)
    code[np.arange(len(found.a)) + before_b[group_a]] = 2 * found.a + last_a
    code[np.arange(len(found.b)) + upto_a[group_b]] = 2 * (a_ids + found.b) + last_b
    table = _names(a_ids, b_ids)
    names = [table[c] for c in code.tolist()]
    bounds = (found.first_a + found.first_b).tolist()
    return ["".join(names[x:y])[:-1] for x, y in zip(bounds, bounds[1:])]


def _aligned(a: list[list[int]], b: list[list[int]], sizes: tuple[np.ndarray, np.ndarray]) -> Aligned:
    flat = [np.fromiter(chain.from_iterable(x), dtype=np.int64, count=sum(map(len, x))) for x in (a, b)]
    first = [np.concatenate([[0], np.cumsum([len(ids) for ids in x], dtype=np.int64)]) for x in (a, b)]
    return align(*flat, *first, *sizes)


def _packed(found: Aligned, b_ids: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Distinct pairs of a block in order, the links that hold each, and for every text the places of its own pairs among them.

    A pair is one number, ``a * b_ids + b``.  A text's places and how often it
    has each are packed: first the steps from place to place, then the numbers.
    """
    text, i, j = found.links()
    pair = found.a[i] * b_ids + found.b[j]
    n = len(found.first_a) - 1
    span = int(pair.max()) + 1 if len(pair) else 1
    own, many = np.unique(text * span + pair, return_counts=True)
    of, own = own // span, own % span
    distinct = np.unique(own)
    place = np.searchsorted(distinct, own)
    total = np.bincount(place, weights=many, minlength=len(distinct)).astype(np.int64)
    bounds = np.searchsorted(of, np.arange(n + 1)).tolist()
    step = np.diff(place, prepend=0)
    step[[x for x, y in zip(bounds, bounds[1:]) if x < y]] = place[[x for x, y in zip(bounds, bounds[1:]) if x < y]]
    press = zstandard.ZstdCompressor(level=1).compress
    both = [step.astype(np.uint32), many.astype(np.uint32)]
    return distinct, total, [press(b"".join(x[low:high].tobytes() for x in both)) for low, high in zip(bounds, bounds[1:])]


def _unpacked(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts the places of their pairs, how often they have them, and the first place of each text."""
    open_ = zstandard.ZstdDecompressor().decompress
    parts = [np.frombuffer(open_(x), dtype=np.uint32) for x in packed]
    half = [len(x) // 2 for x in parts]
    empty = [np.zeros(0, dtype=np.int64)]
    place = np.concatenate(empty + [np.cumsum(x[:h], dtype=np.int64) for x, h in zip(parts, half)])
    many = np.concatenate(empty + [x[h:].astype(np.int64) for x, h in zip(parts, half)])
    return place, many, np.concatenate([[0], np.cumsum(half, dtype=np.int64)])


def grouped(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """``(block, doc_id, n_a, n_b, n_groups, n_links, groups, links, pairs, counts)``: a row per text, and one per block with its pairs.

    Texts whose bytes either tokenizer does not give back have no tokens.  A
    block's row has no ``groups``, a text's row no ``pairs``.  Vocabularies are
    read where the tasks run: files that every machine has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = []
        held: list[tuple] = []
        number, size = 0, 0

        def flush() -> pa.RecordBatch:
            block = (TaskContext.get().partitionId() << 32) + number
            sizes = tuple(t.sizes for t in tools)
            found = _aligned([x[1] for x in held], [x[2] for x in held], sizes)
            distinct, total, links = _packed(found, len(sizes[1]))
            n = [np.diff(found.first_a), np.diff(found.first_b), np.diff(found.cuts)]
            n.append(n[0] + n[1] - n[2])
            none = [None] * len(held)
            columns = [
                [block] * (len(held) + 1),
                [x[0] for x in held] + [None],
                *[[*x.tolist(), None] for x in n],
                group_texts(found, *map(len, sizes)) + [None],
                links + [None],
                [*none, distinct],
                [*none, total],
            ]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _GROUPED.values())], names=list(_GROUPED))

        for part in slices(batches, limit=BLOCK_BYTES):
            tools = tools or [ByteTokens(byte_vocabulary), PieceTokens(piece_vocabulary)]
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                want = b" " + text.encode("utf-8")
                own = [tools[0].encode(" " + text), tools[1].encode(text)] if text else [[], []]
                if text and any(b"".join([t.bytes[i] for i in ids]) != want for t, ids in zip(tools, own)):
                    own = [[], []]
                if held and size + max(len(want), 64) > BLOCK_BYTES:
                    yield flush()
                    held, size, number = [], 0, number + 1
                held.append((doc_id, *own))
                size += max(len(want), 64)
        if held:
            yield flush()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    numbers = ", ".join(f"{n} bigint" for n in ("n_a", "n_b", "n_groups", "n_links"))
    return rows.mapInArrow(run, f"block bigint, doc_id bigint, {numbers}, groups string, links binary, pairs array<bigint>, counts array<bigint>")


_GROUPED = {n: pa.int64() for n in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")}
_GROUPED |= {"groups": pa.string(), "links": pa.binary(), "pairs": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())}


def aligned(
    docs: DataFrame,
    kept: Column | None = None,
    byte_vocabulary: str = BYTE_VOCABULARY,
    piece_vocabulary: str = PIECE_VOCABULARY,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` per row.

    ``groups`` lists the ids of each group, ``a1,a2|b1;a3|b2,b3``; with
    ``kept``, a column of text made from ``groups``, only that is stored and
    returned.  ``count_sum`` adds the corpus-wide counts of the id pairs of all
    links, ``n_best`` counts the links whose pair is the most frequent of its
    second id, ties included.  Null and empty texts, and texts that either
    tokenizer does not give back byte by byte, have no tokens.  Repeated rows
    each count.  Null ids are kept, other columns are not carried, an empty
    table gives no rows.
    """
    told = grouped(docs, byte_vocabulary, piece_vocabulary)
    told = stage(told.withColumn("groups", F.col("groups") if kept is None else F.when(F.col("groups").isNotNull(), kept)), "token-groups")
    texts = told.where(F.col("pairs").isNull()).drop("pairs", "counts")
    met = told.where(F.col("pairs").isNotNull()).select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    met = met.select("block", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    b_ids = len(PieceTokens(piece_vocabulary).sizes)
    counts = met.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.pmod("pair", F.lit(b_ids)))
    counts = stage(counts, "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    judged = counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    asked = met.select(F.col("block").alias("of"), "pair").join(judged, "pair")

    def finish(own: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("pair").to_numpy())
        place, many, first = _unpacked(own.column("links").to_pylist())
        sums = []
        for name in ("best", "count"):
            value = pairs.column(name).to_numpy().astype(np.int64)[order][place] * many
            sums.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(value)])[first])))
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*[own.column(c) for c in names], *sums, own.column("groups")], names=[*names, "n_best", "count_sum", "groups"])

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    return texts.groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(finish, schema)
