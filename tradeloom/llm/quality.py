"""Weak-label quality classifier.

Heuristic labellers look at a text and vote reject, keep or nothing; they
overlap and disagree.  People's labels, where there are some, are one labeller
more, right or wrong like the others.  Expectation-maximisation over the counts
of all vote patterns estimates how often each labeller votes what for good and
for bad texts, and with that the posterior of every pattern.  Posterior labels
of a bounded sample train a linear scorer on hashed tokens, which judges all
texts.

There are two such questions: is a text junk, and is it toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.rows import kept, packed, unpacked
from tradeloom.llm.words import find_words, letter_runs, mix, slices, token_hashes
from tradeloom.plans.staging import stage

SLOTS = 1 << 16
# Texts the scorers are trained on: those with the smallest hashes of the ones people labelled, and of the others.
TRAIN_ROWS = 4_000
OTHER_ROWS = 1_500
# Weight of the others, which heuristics alone have labelled.
OTHER_WEIGHT = 0.3
THRESHOLD = 0.4
EM_ROUNDS = 100
EPOCHS = 200
# A feature has a weight if its shares among good and bad texts differ by so many standard errors.
LEAST_Z = 4.0
# Beginnings of tokens that are features of their own, in bytes.
PREFIXES = (4, 5, 6)

# Common English insults, in three lists so that labellers overlap.
INSULTS = (
    ("idiot", "moron", "stupid", "dumb", "fool", "imbecile"),
    ("trash", "worthless", "pathetic", "garbage", "useless", "disgusting"),
    ("loser", "scum", "clown", "filth", "vermin", "freak"),
)
# Frequent English words; the insult lists have nothing to say about a text with few of them.
ENGLISH = ("the", "of", "and", "to", "in", "is", "that", "it", "was", "for")
ENGLISH_SHARE = 0.04
JUNK = ("repeats", "variety", "shouting", "symbols", "marked", "bars")
TOXIC = ("minds", "worth", "people", "density", "kinds")
ABSTAIN, KEEP, REJECT = 0, 1, 2


def _insult_hashes() -> list[np.ndarray]:
    return [token_hashes(list(group)) for group in INSULTS]


def _vote(value: np.ndarray, keep_below: float, reject_from: float, able: np.ndarray) -> np.ndarray:
    out = np.full(len(value), ABSTAIN, dtype=np.int64)
    out[able & (value <= keep_below)] = KEEP
    out[able & (value >= reject_from)] = REJECT
    return out


def _share(flags: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)


def votes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns of both questions, each a number in base 3 with one digit per labeller."""
    words = find_words(texts)
    n = words.counts
    h = words.hashes()
    text = np.repeat(np.arange(len(n)), n)
    some, many = n >= 5, n >= 30
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    # Distinct words per text: new ones when sorted by text and hash.
    order = np.lexsort((h, text))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    data = words.data
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122))
    symbol = (data > 32) & (data < 127) & ~letter & ~((data >= 48) & (data <= 57))
    up, low, sym = (np.concatenate([[0], np.cumsum(x)]) for x in (upper, letter, symbol))
    per_word = lambda c: c[words.end] - c[words.start]
    sums = lambda x: np.bincount(text, weights=x, minlength=len(n))
    width = words.end - words.start
    shouted = sums(per_word(up)) / np.maximum(sums(per_word(low)), 1)
    symbols = sums(per_word(sym)) / np.maximum(sums(width), 1)
    ends = np.zeros(len(h), dtype=bool)
    long = width >= 3
    ends[long] = symbol[words.end[long] - 1] & symbol[words.end[long] - 2]
    bar = (width == 1) & (data[words.start] == ord("|")) if len(h) else ends
    junk = [
        _vote(_share(same, words.first, n), 0.03, 0.15, some),
        _vote(1 - _share(new, words.first, n), 0.45, 0.6, many),
        _vote(shouted, 0.15, 0.35, some),
        _vote(symbols, 0.06, 0.12, some),
        _vote(_share(ends, words.first, n), 0.02, 0.15, some),
        _vote(_share(bar, words.first, n), 0.02, 0.1, some),
    ]
    hashes, first, _ = letter_runs(texts)
    m = np.diff(first)
    hit = [np.isin(hashes, group) for group in _insult_hashes()]
    english = _share(np.isin(hashes, token_hashes(list(ENGLISH))), first, m) >= ENGLISH_SHARE
    counts = np.stack([_share(x, first, np.ones(len(m))) for x in hit])
    total = counts.sum(axis=0)
    able = english | (total > 0)
    toxic = [_vote(c, 0.5, 1.5, able) for c in counts]
    toxic.append(_vote(total / np.maximum(m, 1), 0.001, 0.01, able))
    toxic.append(_vote((counts > 0).sum(axis=0).astype(float), 0.5, 1.5, able))
    code = lambda rows: sum(v * 3**i for i, v in enumerate(rows))
    return code(junk), code(toxic)


def digits(pattern: np.ndarray, labellers: int) -> np.ndarray:
    return np.stack([pattern // 3**i % 3 for i in range(labellers)], axis=1)


def estimate(pattern: np.ndarray, count: np.ndarray, labellers: int) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: posterior of bad per pattern, each labeller's vote shares per class, share of bad.

    A labeller that says nothing leaves the odds as they are.  A start is
    needed that names the classes: a pattern with a vote to reject is more
    likely bad.  Vote shares are smoothed by one vote.
    """
    v = digits(pattern, labellers)
    bad = np.where((v == REJECT).any(axis=1), 0.9, 0.05)
    shares = np.ones((2, labellers, 3))
    prior = 0.5
    for _ in range(EM_ROUNDS):
        weight = np.stack([(1 - bad) * count, bad * count])
        for c in range(2):
            for i in range(labellers):
                seen = np.bincount(v[:, i], weights=weight[c], minlength=3)[1:] + 1.0
                shares[c, i, 1:] = seen / seen.sum()
        prior = float(np.clip(weight[1].sum() / max(count.sum(), 1), 1e-4, 1 - 1e-4))
        odds = np.log(prior / (1 - prior)) + sum(np.log(shares[1, i, v[:, i]] / shares[0, i, v[:, i]]) for i in range(labellers))
        bad = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return bad, shares, prior


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of every text: slots, values, and the first feature of each text.

    Every distinct token counts once, whatever the text's length; word shapes
    and repeats count by their share of the words.
    """
    words = find_words(texts)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    kind = np.full(256, 4, dtype=np.uint64)  # other scripts
    kind[:128] = 5
    kind[65:91], kind[97:123], kind[48:58] = 1, 2, 3
    kinds = kind[words.data]
    kinds[(kinds == 5)] = np.uint64(16) + words.data[kinds == 5].astype(np.uint64)
    size = words.end - words.start
    last = kinds[words.end - 1]
    before = np.where(size > 1, kinds[np.maximum(words.end - 2, 0)], 0)
    shape = (kinds[words.start] << np.uint64(20)) | (before << np.uint64(10)) | last
    h = words.hashes()
    again = np.zeros(len(h), dtype=np.uint64)
    again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    hashes, first, begins = letter_runs(texts, PREFIXES)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    slot = lambda x: (mix(x) >> np.uint64(64 - 16)).astype(np.int64)
    tokens = [owner * SLOTS + slot(hashes)]
    for n, begin in zip(PREFIXES, begins):
        tokens.append((owner * SLOTS + slot(begin ^ np.uint64(n << 56)))[begin != 0])
    one = np.unique(np.concatenate(tokens))
    two, n2 = np.unique(text * SLOTS + slot(shape ^ np.uint64(0xABCDEF0123456789)), return_counts=True)
    three, n3 = np.unique(text * SLOTS + slot(again + np.uint64(0x1234567)), return_counts=True)
    words_of = np.maximum(words.counts, 1)
    keys = np.concatenate([one, two, three])
    values = np.concatenate([np.ones(len(one)), 10 * n2 / words_of[two // SLOTS], 10 * n3 / words_of[three // SLOTS]])
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.searchsorted(keys, np.arange(len(words.counts) + 1) * SLOTS)
    return (keys % SLOTS).astype(np.int32), values.astype(np.float32), starts


def _dot(weights: np.ndarray, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[slots] * values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def telling(slots: np.ndarray, row: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """True for slots that good and bad texts have in clearly different shares."""
    bad, n = (target * weight).sum(), weight.sum()
    with_bad = np.bincount(slots, weights=(target * weight)[row], minlength=SLOTS)
    with_any = np.bincount(slots, weights=weight[row], minlength=SLOTS)
    p = np.minimum((with_any + 1) / (n + 2), 1 - 1e-6)
    gap = with_bad / max(bad, 1e-9) - (with_any - with_bad) / max(n - bad, 1e-9)
    error = np.sqrt(p * (1 - p) * (1 / max(bad, 1e-9) + 1 / max(n - bad, 1e-9)))
    return np.abs(gap) >= LEAST_Z * error


def fit_linear(
    slots: np.ndarray, values: np.ndarray, starts: np.ndarray, target: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS
) -> np.ndarray:
    """Logistic regression on weighted soft labels by full-batch AdaGrad; the last weight is the bias."""
    row = np.repeat(np.arange(len(target)), np.diff(starts))
    told = telling(slots, row, target, weight) | (np.bincount(slots[values != 1], minlength=SLOTS) >= len(target) // 100 + 1)
    use = told[slots]
    slots, values, row = slots[use], values[use], row[use]
    starts = np.searchsorted(row, np.arange(len(target) + 1))
    weights = np.zeros(SLOTS + 1)
    seen = np.full(SLOTS + 1, 1e-10)
    share = (weight * (target > 0.5)).sum() / max(weight.sum(), 1e-9)
    balance = weight * np.where(target > 0.5, min(0.5 / max(share, 1e-3), 4.0), 1.0)
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-np.clip(_dot(weights, slots, values, starts) + weights[-1], -30, 30)))
        error = (p - target) * balance / max(weight.sum(), 1e-9)
        slope = np.append(np.bincount(slots, weights=values * error[row], minlength=SLOTS), error.sum())
        slope[:-1] += 1e-4 * weights[:-1]
        seen += slope * slope
        weights -= 0.2 * slope / np.sqrt(seen)
    return weights


@dataclass
class Model:
    """Two linear scorers of ``SLOTS`` weights and a bias, and the labellers' estimated vote shares."""

    junk: np.ndarray
    toxic: np.ndarray
    shares: dict[str, np.ndarray]
    posterior: dict[str, dict[int, float]]


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))


def vote_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, copy, junk, toxic)``: the heuristics' vote patterns of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            junk, toxic = votes(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("copy"), pa.array(junk), pa.array(toxic)], names=["doc_id", "copy", "junk", "toxic"]
            )

    rows = _rows(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, copy bigint, junk bigint, toxic bigint")


def _with_people(cast: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the labels' votes as the last digit of both patterns; of repeated labels the stricter counts."""
    given = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"), F.max("toxic").alias("_toxic"))
    vote = lambda bad, known: F.when(bad, F.lit(REJECT)).when(known, F.lit(KEEP)).otherwise(F.lit(ABSTAIN))
    junk = vote(F.col("_quality") == 0, F.col("_quality").isNotNull())
    toxic = vote(F.col("_toxic") == 1, F.col("_toxic").isNotNull())
    return cast.join(given, F.col("doc_id") == F.col("_id"), "left").select(
        "copy",
        (F.col("junk") + junk * 3 ** len(JUNK)).alias("junk"),
        (F.col("toxic") + toxic * 3 ** len(TOXIC)).alias("toxic"),
        F.col("_id").isNotNull().alias("asked"),
    )


def train(docs: DataFrame, labels: DataFrame | None = None, train_rows: int = TRAIN_ROWS, other_rows: int = OTHER_ROWS) -> Model:
    """Fit both label models on the votes of all rows, and the scorers on a sample.

    ``labels (doc_id, quality, toxic)`` may cover any of the rows; most of the
    sample is drawn from those.  A text on which no labeller votes does not
    count.

    The driver gets the counts of vote patterns (at most 3 to the number of
    labellers) and the hashed features of ``train_rows + other_rows`` texts.
    """
    voted = vote_table(docs)
    cast = stage(voted.withColumn("asked", F.lit(True)).drop("doc_id") if labels is None else _with_people(voted, labels), "votes")
    posterior, shares = {}, {}
    for question, labellers in (("junk", JUNK), ("toxic", TOXIC)):
        counted = sorted((r[0], r[1]) for r in cast.groupBy(question).count().collect())
        pattern = np.array([p for p, _ in counted], dtype=np.int64)
        bad, share, _ = estimate(pattern, np.array([c for _, c in counted], dtype=np.float64), len(labellers) + 1)
        posterior[question] = dict(zip(pattern.tolist(), bad.tolist()))
        shares[question] = share

    # Texts with the smallest hashes: chosen on hashes alone, fetched after.
    each = stage(cast.groupBy("copy").agg(F.max(F.struct("asked", "junk", "toxic")).alias("v")).select("copy", "v.*"), "texts")
    draw = [F.xxhash64("copy", F.lit(5)), "copy"]
    sample = each.where("asked").orderBy(*draw).limit(train_rows).unionByName(each.where("not asked").orderBy(*draw).limit(other_rows))
    sample = stage(sample, "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            slots, values, starts = _features(part.column("text"))
            offsets = pa.array(starts.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("copy"), pa.ListArray.from_arrays(offsets, pa.array(slots)), pa.ListArray.from_arrays(offsets, pa.array(values))],
                names=["copy", "slots", "values"],
            )

    # A stated number of hashes at most.
    texts = _rows(docs).select("copy", "text").join(F.broadcast(sample.select("copy")), "copy", "left_semi").dropDuplicates(["copy"])
    featured = texts.mapInArrow(run, "copy bigint, slots array<int>, values array<float>")
    made = featured.join(sample, "copy").orderBy("copy").toArrow()
    made = made.combine_chunks()
    if not made.num_rows:
        zero = np.zeros(SLOTS + 1)
        return Model(zero, zero, shares, posterior)
    column = lambda k: made.column(k).chunk(0)
    slots, values = column("slots").flatten().to_numpy(), column("values").flatten().to_numpy().astype(np.float64)
    starts = np.asarray(column("slots").offsets).astype(np.int64)
    starts = starts - starts[0]
    weights = {}
    for question in ("junk", "toxic"):
        target = np.array([posterior[question][p] for p in column(question).to_pylist()])
        weight = np.where(np.asarray(column("asked").to_pylist()), 1.0, OTHER_WEIGHT) * (np.asarray(column(question)) > 0)
        weights[question] = fit_linear(slots, values, starts, target, weight)
    return Model(weights["junk"], weights["toxic"], shares, posterior)


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, copy, junk, toxic, junk_label, toxic_label, keep)`` per row.

    ``junk`` and ``toxic`` are the scorers' probabilities, the labels are the
    label models' posteriors.  A row is kept if both probabilities are below
    the threshold and the text has a word; null and empty texts are not kept.
    """

    def known(table: dict[int, float], patterns: np.ndarray) -> np.ndarray:
        return np.array([table.get(p, 0.5) for p in patterns.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text")
            slots, values, starts = _features(texts)
            junk, toxic = (1 / (1 + np.exp(-np.clip(_dot(w, slots, values, starts) + w[-1], -30, 30))) for w in (model.junk, model.toxic))
            votes_junk, votes_toxic = votes(texts)
            keep = (junk < THRESHOLD) & (toxic < THRESHOLD) & (find_words(texts).counts > 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("copy"), pa.array(junk), pa.array(toxic)]
                + [pa.array(known(model.posterior["junk"], votes_junk)), pa.array(known(model.posterior["toxic"], votes_toxic)), pa.array(keep)],
                names=["doc_id", "copy", "junk", "toxic", "junk_label", "toxic_label", "keep"],
            )

    rows = _rows(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {id_type}, copy bigint, junk double, toxic double, junk_label double, toxic_label double, keep boolean"
    )


def accepted(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    verdicts = judged(docs, train(docs, labels))
    return unpacked(kept(packed(docs), verdicts.where("not keep"), "left_anti"))
