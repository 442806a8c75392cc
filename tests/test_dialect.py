from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tradeloom.functions import dialect
from tradeloom.functions.hashing import chance, mix, pick_from


def test_half_up_and_half_even_follow_exact_decimals(spark):
    pairs = [(s, n) for n in (1, 2, 3, 7, 8, 200, 400) for s in range(0, 60)]
    df = spark.createDataFrame(pairs, "s bigint, n bigint").select(
        "s", "n", dialect.ratio_half_up("s", "n").alias("up"), dialect.ratio_half_even("s", "n").alias("even")
    )
    for r in df.collect():
        exact = Decimal(r["s"]) / Decimal(r["n"])
        assert r["up"] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert r["even"] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_EVEN))


def test_empty_groups_give_null_not_an_error(spark):
    df = spark.sql("select 0L s, 0L n union all select cast(null as bigint), 3L union all select 5L, cast(null as bigint)")
    out = df.select(dialect.ratio_half_up("s", "n"), dialect.ratio_half_even("s", "n"), dialect.ratio("s", "n"))
    assert rows(out) == [(None, None, None)] * 3


def test_null_order(spark):
    df = spark.sql("select * from values (1), (null), (3) t(x)")
    assert [r[0] for r in df.orderBy(dialect.nulls_first("x")).collect()] == [None, 3, 1]
    assert [r[0] for r in df.orderBy(dialect.nulls_last("x")).collect()] == [3, 1, None]


def test_to_integer(spark):
    df = spark.sql("select * from values ('7'), ('x'), (''), (null), ('7.9'), (' 8 ') t(v)")
    assert [r[0] for r in df.select(dialect.to_integer("v")).collect()] == [7, None, None, None, 7, 8]


@settings(max_examples=10, deadline=None)
@given(seed=st.integers(0, 500))
def test_mix_is_uniform_enough(spark, seed):
    counts = spark.range(4000).groupBy(F.pmod(mix("id", seed), F.lit(8)).alias("b")).count().collect()
    assert len(counts) == 8 and all(350 < r["count"] < 650 for r in counts)


def test_draws_do_not_depend_on_partitioning(spark):
    one = spark.range(0, 500, 1, 1).where(chance("id", 0.35, 4))
    many = spark.range(0, 500, 1, 7).where(chance("id", 0.35, 4))
    assert rows(one) == rows(many)
    assert 120 < one.count() < 230


def test_neighbouring_seeds_are_not_alike(spark):
    same = spark.range(5000).where(
        pick_from(list("abcdefghij"), "id", 3) == pick_from(list("abcdefghij"), "id", 4)
    ).count()
    assert 350 < same < 650
