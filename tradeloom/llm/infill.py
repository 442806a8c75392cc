"""Fill-in-the-middle texts, cut at unit ranks through an indexable skip list.

A text's units are its words, each with the white space before it, and the
white space at its end.  Over the units of every text lies a skip list: lane 0
links unit to unit, each lane above keeps about a quarter of the nodes below.
A link carries two widths, how many units and how many code points it spans.
Descending from the top lane, a link is taken while its unit width still fits
in the rank that is left; the code-point widths of the links taken add up to
the place of the cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.words import find_words, mix, raw, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
# Shares out of 100: texts that are cut, and of these the ones that begin with their suffix.
CUT, SUFFIX_FIRST = 50, 80
_NO_LINK = np.iinfo(np.int64).max


@dataclass
class Lane:
    """Nodes of all texts in turn: a text's head, its promoted boundaries, its end.

    ``units`` and ``points`` are the widths of the link to the next node; an
    end has none that ever fits.  ``down`` is the same node one lane below,
    ``head`` the first node of each text.
    """

    units: np.ndarray
    points: np.ndarray
    down: np.ndarray
    head: np.ndarray


def _heights(ranks: np.ndarray) -> np.ndarray:
    """How many lanes a boundary rises: a coin of one in four a lane, thrown by its rank."""
    coins = mix(ranks.astype(np.uint64) + np.uint64(1))
    lowest = coins & (~coins + np.uint64(1))
    return np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) // 2


class SkipLists:
    """One skip list per text of an Arrow array; null texts have no units."""

    def __init__(self, texts: pa.Array):
        words = find_words(texts)
        data, at = raw(texts)
        points = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        size = np.diff(at)
        count = words.counts
        filled = count > 0
        last = np.where(filled, words.end[np.maximum(words.first[1:] - 1, 0)] if len(words) else 0, at[:-1])
        blank_end = (size > 0) & (last < at[1:])
        self.n = count + blank_end
        # Boundaries of all texts: the head, every unit's end.
        of = np.repeat(np.arange(len(size)), self.n + 1)
        first = np.concatenate([[0], np.cumsum(self.n + 1)])
        rank = np.arange(first[-1]) - first[of]
        place = np.repeat(at[:-1], self.n + 1)
        inner = (rank > 0) & ~((rank == self.n[of]) & blank_end[of])
        place[inner] = words.end
        place[(rank > 0) & ~inner] = at[1:][blank_end]
        self.lanes: list[Lane] = []
        height = np.where((rank == 0) | (rank == self.n[of]), _NO_LINK, _heights(rank))
        node = below = np.arange(first[-1])
        while True:
            text = of[node]
            units, width = np.full(len(node), _NO_LINK), np.zeros(len(node), dtype=np.int64)
            linked = np.flatnonzero(text[1:] == text[:-1])
            units[linked] = rank[node[linked + 1]] - rank[node[linked]]
            width[linked] = points[place[node[linked + 1]]] - points[place[node[linked]]]
            self.lanes.append(Lane(units, width, np.searchsorted(below, node), np.searchsorted(text, np.arange(len(size)))))
            below, node = node, node[height[node] >= len(self.lanes)]
            if len(node) == len(below):
                break

    def points(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Code points before the end of the first ``rank`` units of each ``text``; all are descended together."""
        left = rank.astype(np.int64)
        out = np.zeros(len(left), dtype=np.int64)
        node = self.lanes[-1].head[text]
        for lane in reversed(self.lanes):
            going = np.flatnonzero(lane.units[node] <= left)
            while len(going):
                here = node[going]
                left[going] -= lane.units[here]
                out[going] += lane.points[here]
                node[going] += 1
                going = going[lane.units[node[going]] <= left[going]]
            node = lane.down[node]
        return out


def _draws(seed: int) -> list[Column]:
    """Four numbers of 32 bits from the id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        texts = part.column("text")
        lists = SkipLists(texts)
        form = np.array(part.column("form").to_pylist(), dtype=object)
        cut = np.flatnonzero(form != "plain")
        h1, h2 = (part.column(h).to_numpy()[cut] % (lists.n[cut] + 1) for h in ("h1", "h2"))
        one, two = lists.points(cut, np.minimum(h1, h2)), lists.points(cut, np.maximum(h1, h2))
        out, before, inside = texts.to_pylist(), [None] * len(texts), [None] * len(texts)
        for i, a, b in zip(cut.tolist(), one.tolist(), two.tolist()):
            t = out[i]
            before[i], inside[i] = a, b - a
            if form[i] == "psm":
                out[i] = f"{PREFIX}{t[:a]}{SUFFIX}{t[b:]}{MIDDLE}{t[a:b]}"
            else:
                out[i] = f"{SUFFIX}{t[b:]}{PREFIX}{t[:a]}{MIDDLE}{t[a:b]}"
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(lists.n.astype(np.int64)),
                part.column("form"),
                pa.array(before, pa.int64()),
                pa.array(inside, pa.int64()),
                pa.array(out, pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def infilled(docs: DataFrame, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``: every text, about ``cut`` in 100 of them cut in three.

    ``form`` is ``plain``, ``psm`` (prefix, suffix, middle) or ``spm`` (suffix,
    prefix, middle); plain texts have null lengths and stay as they are.  The
    draw depends on ``seed`` and doc_id alone.  Null texts are empty and, as
    all empty texts and those that contain a mark, plain; a null doc_id counts
    as empty text; repeated rows are cut alike; an empty table gives no rows;
    other columns are not carried.  There is no shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = F.greatest(*[F.contains("text", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)])
    plain = (F.col("text") == "") | marked | (F.pmod("h3", F.lit(100)) >= cut)
    form = F.when(plain, "plain").when(F.pmod("h4", F.lit(100)) < suffix_first, "spm").otherwise("psm")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), *_draws(seed))
    return rows.select("doc_id", "text", "h1", "h2", form.alias("form")).mapInArrow(
        _cut, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from; a mark is never part of a text that was cut."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    parts = {
        "psm": (F.substring_index(head, SUFFIX, 1), F.substring_index(head, SUFFIX, -1)),
        "spm": (F.substring_index(head, PREFIX, -1), F.substring_index(head, PREFIX, 1)),
    }
    prefix, suffix = parts["psm"]
    psm = F.concat(F.substring(prefix, len(PREFIX) + 1, 2**31 - 1), middle, suffix)
    prefix, suffix = parts["spm"]
    spm = F.concat(prefix, middle, F.substring(suffix, len(SUFFIX) + 1, 2**31 - 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
