"""Long repeated word sequences, found by recompression.

Each text is rewritten in rounds: a run of two equal tokens, then pairs of
neighbouring tokens, become one new symbol.  A symbol's name is a hash of what
it stands for, so equal word sequences get equal names in every document and
task, and no table of names is needed.  Which tokens pair up depends on their
names alone; so two equal sequences are rewritten alike but for ``LOSS`` words
at either end.  Every window of 50 words therefore contains whole symbols that
all its occurrences share, and the one with the smallest scrambled name is its
anchor.

Anchors meet in Spark: first by the words around the symbol that every window
choosing it contains (``core``), then by the full stretch of all windows that
chose it (``reach``).  Equal reaches verify all their windows at once.  Where
reaches of one core differ, the windows themselves are hashed and compared,
once for each different reach.  Equal stretches and windows are told by two
hashes modulo a prime of 61 bits, with different bases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.skew import join_by_key
from tradeloom.llm.words import Words, find_words, mix, run_hashes, slices
from tradeloom.plans.staging import stage

WINDOW = 50
# Words at either end of a sequence that may be rewritten otherwise elsewhere:
# 2 by the run round (spans up to 2), 2 by the first pair round (up to 4), 4 by the second (up to 8).
LOSS = 8
_U = np.uint64
_NO_ID = 2**63 - 1


def _classes(symbols: np.ndarray, level: int) -> np.ndarray:
    return (mix(symbols + _U(level)) & _U(1)).astype(bool)


def _named(symbols: np.ndarray, left: np.ndarray, level: int) -> np.ndarray:
    """New names for the symbols at ``left`` together with their right neighbours."""
    return mix(symbols[left] * _U(0x9E3779B97F4A7C15) + mix(symbols[left + 1] + _U(level)))


def _replace(symbols: np.ndarray, at: np.ndarray, left: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    new = symbols.copy()
    new[left] = _named(symbols, left, level)
    keep = np.ones(len(symbols), dtype=bool)
    keep[left + 1] = False
    return new[keep], at[keep]


def recompress(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after one run round and two pair rounds, and the word each begins at."""
    at = np.arange(len(symbols))
    if len(symbols) < 2:
        return symbols, at
    # Runs of exactly two; a window could cut a longer one at any place, so its words stay.
    same = (symbols[1:] == symbols[:-1]) & (text[1:] == text[:-1])
    alone = same.copy()
    alone[1:] &= ~same[:-1]
    alone[:-1] &= ~same[1:]
    symbols, at = _replace(symbols, at, np.flatnonzero(alone), 1)
    for level in (2, 3):
        first = _classes(symbols, level)
        pairs = first[:-1] & ~first[1:] & (text[at[:-1]] == text[at[1:]])
        symbols, at = _replace(symbols, at, np.flatnonzero(pairs), level)
    return symbols, at


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest of ``values[low..high]`` for every range, from a table of powers of two."""
    rows = [values]
    widest = int((high - low).max()) + 1
    step = 1
    while 2 * step <= widest:
        last = rows[-1]
        rows.append(np.concatenate([np.minimum(last[:-step], last[step:]), last[len(last) - step :]]))
        step *= 2
    j = np.log2(high - low + 1).astype(np.int64)
    table = np.stack(rows)
    return np.minimum(table[j, low], table[j, high - (1 << j) + 1])


def anchors(words: Words, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Anchors of all windows of the given texts, one row per stretch of windows.

    ``text``: number of the text; ``core``: hash; ``reach``, ``reach2``: two
    independent hashes of the stretch, 122 bits together; ``first``, ``last``:
    words of the text where the stretch's first and last windows begin.
    """
    n = len(words)
    counts = words.counts
    text = np.repeat(np.arange(len(counts)), counts)
    hashes = words.hashes()
    starts_in = np.maximum(counts - window + 1, 0)
    if not starts_in.sum():
        return {k: np.zeros(0, dtype=np.int64) for k in ("text", "core", "reach", "reach2", "first", "last")}
    symbols, at = recompress(hashes, text)
    end = np.append(at[1:], n)
    begun = np.zeros(n + 1, dtype=np.int64)
    begun[at + 1] = 1
    begun = np.cumsum(begun)  # symbols that begin before a word
    ended = np.zeros(n + 1, dtype=np.int64)
    ended[end] = 1
    ended = np.cumsum(ended)  # symbols that end at a word or before
    p = np.repeat(words.first[:-1], starts_in) + np.arange(starts_in.sum()) - np.repeat(np.cumsum(starts_in) - starts_in, starts_in)
    low, high = begun[p + LOSS], ended[p + window - LOSS] - 1
    # The scrambled name decides; of equal names the later one, which all occurrences agree on.
    bits = max(1, int(len(symbols)).bit_length())
    rank = (mix(symbols ^ _U(0x5DEECE66D)) >> _U(bits)) << _U(bits)
    rank |= (np.arange(len(symbols), 0, -1)).astype(_U)
    least = _range_least(rank, low, high)
    chosen = len(symbols) - (least & _U((1 << bits) - 1)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1])]))
    first, last = p[edge], p[np.append(edge[1:], len(p)) - 1]
    q, e = at[chosen[edge]], end[chosen[edge]]
    core = run_hashes(hashes, q - LOSS, e + LOSS)
    inside = mix((q - first).astype(_U) + _U(1))
    reach = mix(run_hashes(hashes, first, last + window) ^ inside)
    reach2 = mix(run_hashes(words.hashes(1), first, last + window, 1) ^ inside)
    where = text[first]
    base = words.first[where]
    return {
        "text": where,
        "core": core.view(np.int64),
        "reach": reach.view(np.int64),
        "reach2": reach2.view(np.int64),
        "first": first - base,
        "last": last - base,
    }


def window_hashes(words: Words, lane: int, start: np.ndarray, window: int = WINDOW) -> np.ndarray:
    return run_hashes(words.hashes(lane), start, start + window, lane)


def _identified(docs: DataFrame) -> DataFrame:
    """Texts with what names a row: rows without an id come after all others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(text).alias("copy"), text.alias("text")
    )


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = anchors(find_words(part.column("text")))
        of = pa.array(found["text"])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc").take(of), part.column("copy").take(of), *[pa.array(found[k]) for k in ("core", "reach", "reach2")]]
            + [pa.array(found[k].astype(np.int32)) for k in ("first", "last")],
            names=["doc", "copy", "core", "reach", "reach2", "first", "last"],
        )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows of the asked stretches: two lanes, so 122 bits."""
    for part in slices(batches):
        words = find_words(part.column("text"))
        asked = part.column("asked")
        inner = asked.flatten()
        of = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(asked.offsets)))
        field = lambda k: inner.field(k).to_numpy(zero_copy_only=False)
        first, last = field("first").astype(np.int64), field("last").astype(np.int64)
        many = last - first + 1
        row = np.repeat(np.arange(len(of)), many)
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = first[row] + offset
        begin = words.first[of[row]] + start
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc").take(pa.array(of[row])),
                part.column("copy").take(pa.array(of[row])),
                pa.array(start.astype(np.int32)),
                pa.array(window_hashes(words, 0, begin).view(np.int64)),
                pa.array(window_hashes(words, 1, begin).view(np.int64)),
            ],
            names=["doc", "copy", "start", "one", "two"],
        )


def repeat_spans(docs: DataFrame) -> DataFrame:
    """``(doc, copy, spans)`` for every row some of whose windows begin in an earlier document.

    ``doc`` is the doc_id (the largest bigint where it is null), ``copy`` the
    text's xxhash64; together they name a row, and repeated rows share a
    result.  ``spans`` are the first and one-past-last words to remove, not
    merged.  Texts under 50 words have none.
    """
    texts = _identified(docs)
    found = stage(
        texts.mapInArrow(_anchor_rows, "doc bigint, copy bigint, core bigint, reach bigint, reach2 bigint, first int, last int"), "anchors"
    )
    # Most cores are in one document only and go before anything else is compared.
    rows = F.count(F.lit(1)).alias("n")
    cores = found.groupBy("core").agg(F.min("doc").alias("core_least"), F.max("doc").alias("core_most"), rows).where("core_least < core_most")
    met = stage(join_by_key(found, stage(cores.select("core", "n"), "cores"), ["core"], "n"), "met")
    key = ["core", "reach", "reach2"]
    reaches = stage(met.groupBy(*key).agg(F.min("doc").alias("least"), rows), "reaches")
    variants = reaches.groupBy("core").agg(F.count(F.lit(1)).alias("variants")).withColumn("weight", F.col("variants"))
    varied = stage(join_by_key(reaches, variants, ["core"], "weight"), "varied")
    placed = join_by_key(met, varied, key, "n").where("variants > 1 or least < doc")
    placed = stage(placed.select("doc", "copy", "first", "last", "least", "variants"), "shared")
    whole = placed.where("least < doc").select("doc", "copy", "first", "last")

    # Of each reach its first document is open: an earlier one may share some windows under another reach.
    open_ = placed.where("doc = least and variants > 1")
    asked = open_.groupBy("doc", "copy").agg(F.collect_list(F.struct("first", "last")).alias("asked"))
    hashed = stage(
        texts.join(asked, ["doc", "copy"]).mapInArrow(
            _window_rows, "doc bigint, copy bigint, start int, one bigint, two bigint"
        ),
        "windows",
    )
    pair = ["one", "two"]
    earlier = hashed.groupBy(*pair).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    parts = hashed.join(earlier, pair).where("least < doc").select("doc", "copy", F.col("start").alias("first"), F.col("start").alias("last"))
    return (
        whole.unionByName(parts)
        .distinct()
        .groupBy("doc", "copy")
        .agg(F.collect_list(F.struct(F.col("first").alias("start"), (F.col("last") + WINDOW).alias("end"))).alias("spans"))
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        words = find_words(part.column("text"))
        spans = part.column("spans").to_pylist()
        removed, texts = [], []
        for i, here in enumerate(spans):
            own = words.bytes_of(i)
            if here:
                change = np.zeros(len(own) + 1, dtype=np.int64)
                np.add.at(change, [s["start"] for s in here], 1)
                np.add.at(change, [s["end"] for s in here], -1)
                gone = np.cumsum(change[:-1]) > 0
                removed.append(int(gone.sum()))
                own = [own[k] for k in np.flatnonzero(~gone)]
            else:
                removed.append(0)
            texts.append(b" ".join(own).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc"),
                pa.array(words.counts.astype(np.int64)),
                pa.array(np.array(removed, dtype=np.int64)),
                pa.array(texts, pa.string()),
            ],
            names=["doc", "n_words", "n_removed", "kept"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: every text without the words that earlier documents already have.

    A word goes if a window of 50 consecutive words covers it whose sequence
    also begins in a document with a smaller doc_id.  Windows are judged on the
    texts as given.  Null texts have no words and give an empty text; rows
    without a doc_id come after all others; repeated rows are judged alike;
    other columns are not carried.
    """
    spans = repeat_spans(docs)
    joined = _identified(docs).join(spans, ["doc", "copy"], "left").select("doc", "text", "spans")
    out = joined.mapInArrow(_kept, "doc bigint, n_words bigint, n_removed bigint, kept string")
    return out.select(F.when(F.col("doc") < _NO_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept")
