"""Split plans give the rows of the plain ones, on skewed data too."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tradeloom.operators.rankings import counter_rate
from tradeloom.plans import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, the rest spread; one NULL key."""
    rng = random.Random(5)
    data = [(1 if i % 3 == 0 else rng.randrange(2, 200), i, rng.randrange(0, 6)) for i in range(6000)]
    data += [(None, 6000 + i, 1) for i in range(4)]
    return spark.createDataFrame(data, "k bigint, o bigint, v bigint").repartition(7).cache()


@pytest.mark.parametrize("keys", [["k"], []])
def test_row_index(skewed, keys):
    plain = ordered.row_index(skewed, keys, ["o"], "rn", "n", split=False)
    split = ordered.row_index(skewed, keys, ["o"], "rn", "n", split=True)
    assert rows(plain, "k", "o", "rn", "n") == rows(split, "k", "o", "rn", "n")


def test_row_index_descending(skewed):
    order = [F.col("v").desc(), F.col("o").desc()]
    assert rows(ordered.row_index(skewed, ["k"], order, split=False)) == rows(
        ordered.row_index(skewed, ["k"], order, split=True)
    )


def test_sliding_frame_across_blocks(skewed):
    placed = ordered.row_index(skewed.where("k is not null"), ["k"], ["o"], "p", split=False)
    small = ordered.sliding_frame(placed, ["k"], "p", 2, {"s": F.sum("v")}, block=5)
    large = ordered.sliding_frame(placed, ["k"], "p", 2, {"s": F.sum("v")})
    assert rows(small, "k", "o", "s") == rows(large, "k", "o", "s")
    by_key = {}
    for r in placed.collect():
        by_key.setdefault(r["k"], {})[r["p"]] = r["v"]
    want = {(k, p): sum(vs.get(q, 0) for q in (p - 2, p - 1, p)) for k, vs in by_key.items() for p in vs}
    assert {(r["k"], r["p"]): r["s"] for r in small.collect()} == want


def test_running_max(skewed):
    df = skewed.where("k is not null").withColumn("w", F.pmod(F.col("o") * 37, F.lit(1009)))
    got = ordered.running_max(df, "k", "o", "w", "m", chunk_rows=50)
    best, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: r["o"]):
        best[r["k"]] = max(best.get(r["k"], -1), r["w"])
        want[r["o"]] = best[r["k"]]
    assert {r["o"]: r["m"] for r in got.collect()} == want


def test_rank_by_value(skewed):
    from pyspark.sql import Window as W

    counts = skewed.groupBy("k", "v").count().withColumnRenamed("count", "c")
    w = W.partitionBy("v").orderBy(F.desc("c"))
    want = counts.withColumn("r", F.rank().over(w).cast("bigint")).withColumn("d", F.dense_rank().over(w).cast("bigint"))
    got = ordered.rank_by_value(counts, ["v"], "c", "r", "d")
    assert rows(got, "k", "v", "c", "r", "d") == rows(want, "k", "v", "c", "r", "d")


def test_top_per_group_is_cut_before_the_shuffle(skewed):
    top = ordered.top_per_group(skewed, ["k"], ["o"], 2)
    assert plan_text(top).count("WindowGroupLimit") == 2
    assert top.where("k = 1").count() == 2


def test_the_caller_decides_and_names_are_reserved(skewed):
    split, plain = ordered.row_index(skewed, ["k"], ["o"]), ordered.row_index(skewed, ["k"], ["o"], split=False)
    assert "_row_index_chunk" in plan_text(split) and "_row_index_" not in plan_text(plain)
    assert rows(split, "k", "o", "rn") == rows(plain, "k", "o", "rn")
    with pytest.raises(ValueError):
        ordered.row_index(skewed.withColumn("_row_index_c", F.lit(1)), ["k"], ["o"])
    # Names of this kind that the function used before belong to the caller.
    named = ordered.row_index(skewed.withColumn("_c", F.lit(1)), ["k"], ["o"], number="_n")
    assert {"_c", "_n"} <= set(named.columns)


def plain_rates(samples, range_ms):
    """Rates by a loop over each sample's range; samples are (series, ms, value)."""
    seconds, out = range_ms / 1000.0, []
    for i, (key, at, _) in enumerate(samples := sorted(samples)):
        held = [(t, v) for k, t, v in samples[: i + 1] if k == key and t > at - range_ms]
        n, sampled = len(held), (at - held[0][0]) / 1000.0
        if n == 1 or sampled == 0:
            out.append((key, at, None))
            continue
        increase = float(sum(v if v < u else v - u for (_, u), (_, v) in zip(held, held[1:])))
        lead, spacing = seconds - sampled, sampled / (n - 1)
        lead = spacing / 2 if lead >= spacing * 1.1 else lead
        if increase > 0 and held[0][1] >= 0:
            lead = min(lead, sampled * (held[0][1] / increase))
        out.append((key, at, round(increase * ((sampled + lead) / sampled) / seconds, 9)))
    return sorted(out, key=repr)


def test_counter_rate_folds_each_sample_once(spark):
    rng = random.Random(8)
    # A busy series with restarts and samples at one time, a sparse one with gaps of several ranges,
    # and one whose samples lie on the edges of slices and ranges.
    samples = [("busy", rng.randrange(-2000, 6000), rng.randrange(0, 90)) for _ in range(900)]
    samples += [("sparse", t, v) for v, t in enumerate(rng.sample(range(0, 60_000), 40))]
    samples += [("edges", t, t % 700) for t in (0, 1, 999, 1000, 1001, 1999, 2000, 2001, 3000, 4000, 4999, 6001)]
    want = plain_rates(samples, 1000)
    for given in (samples, samples[::-1]):
        df = spark.createDataFrame(given, "k string, at bigint, v bigint").repartition(5)
        rates = counter_rate(df, ["k"], "at", "v", 1000)
        # A frame that slides would be folded anew at each row: rows times the rows of a range.
        assert "RangeFrame" not in plan_text(rates)
        assert rows(rates.withColumn("rate", F.round("rate", 9))) == want
