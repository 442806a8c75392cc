"""Changes, constraints and stored copies on small fixtures."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_text, rows
from tradeloom.operators import changes, filters, quality
from tradeloom.operators.documents import lookup_nested, push, set_nested, unset_nested
from tradeloom.plans.report_cache import ReportCache
from tradeloom.sources import tables


def people(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, None, 30)], "id bigint, name string, n bigint")


def test_update_from_sets_null_and_leaves_others(spark):
    fresh = spark.createDataFrame([(1, None), (3, "c")], "id bigint, name string")
    assert rows(changes.update_from(people(spark), fresh, ["id"])) == [(1, None, 10), (2, "b", None), (3, "c", 30)]


def test_null_conditions_do_not_match(spark):
    df = people(spark)
    assert rows(changes.delete_where(df, F.col("n") > 15), "id") == [(1,), (2,)]
    assert rows(changes.update_where(df, F.col("n") > 15, name=F.lit("x")), "id", "name") == [(1, "a"), (2, "b"), (3, "x")]


def test_merge_marks_created_and_matched(spark):
    df = people(spark).withColumn("created", F.lit(None).cast("string")).withColumn("updated", F.lit(None).cast("string"))
    incoming = spark.createDataFrame([(2, "B"), (9, "new")], "id bigint, name string")
    merged = changes.merge(df, incoming, ["id"], {"created": F.lit("now")}, {"updated": F.lit("now")})
    assert rows(merged, "id", "name", "n", "created", "updated") == [
        (1, "a", 10, None, None), (2, "B", None, None, "now"), (3, None, 30, None, None), (9, "new", None, "now", None),
    ]


def test_insert_new_ignores_known_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, 1, "old")], "u bigint, g bigint, c string")
    more = spark.createDataFrame([(1, 1, "no"), (2, 2, "b"), (2, 2, "a")], "u bigint, g bigint, c string")
    assert rows(changes.insert_new(df, more, ["u", "g"], ["c"])) == [(1, 1, "old"), (2, 2, "a")]


def test_new_keys_go_on_after_the_largest(spark):
    df = spark.createDataFrame([(4, "x")], "id bigint, name string")
    fresh = spark.createDataFrame([("b",), ("a",)], "name string")
    assert rows(changes.with_new_keys(df, "id", fresh, ["name"]), "id", "name") == [(5, "a"), (6, "b")]


def test_cascade_and_restrict(seed):
    names = ("users", "categories", "goods", "orders", "reviews", "purchase_history", "addresses", "pickup_points", "warehouses")
    all_tables = {n: getattr(seed, n) for n in names}
    after, blocked = changes.cascade_delete(all_tables, "users", seed.users.where("user_id = 6"))
    assert {t: after[t].count() for t in ("users", "orders", "reviews", "purchase_history")} == {
        "users": 14, "orders": 23, "reviews": 9, "purchase_history": 23,
    }
    assert all(df.isEmpty() for df in blocked.values())
    # A merchant's goods would go, and orders of them forbid it.
    _, blocked = changes.cascade_delete(all_tables, "users", seed.users.where("user_id = 1"))
    assert blocked["orders.good_id"].count() == 6
    after, _ = changes.cascade_delete(all_tables, "addresses", seed.addresses.where("addr_id in (1, 6)"))
    assert (after["pickup_points"].count(), after["warehouses"].count()) == (4, 4)
    _, blocked = changes.cascade_delete(all_tables, "categories", seed.categories.where("caty_id = 2"))
    assert blocked["goods.caty_id"].count() == 5


def test_range_buckets_at_their_bounds(spark, tmp_path):
    ids = [1, 100000, 100001, 1000000, 1000001, 0]
    df = spark.createDataFrame([(i,) for i in ids], "user_id bigint")
    got = {r[0]: r[1] for r in df.select("user_id", changes.range_bucket("user_id")).collect()}
    assert got == {1: 0, 100000: 0, 100001: 1, 1000000: 9, 1000001: -1, 0: -1}
    path = str(tmp_path / "p")
    assert changes.write_partitioned(df, changes.range_bucket("user_id"), path) == (6, 6)
    found = changes.read_range(spark, path, "user_id", 100000, 1000001)
    assert sorted(r["user_id"] for r in found.collect()) == [100000, 100001, 1000000, 1000001]
    narrow = changes.read_range(spark, path, "user_id", 100001, 200000)
    assert rows(narrow, "user_id") == [(100001,)]
    assert "PartitionFilters: [isnotnull(bucket" in plan_text(narrow)


def test_document_rules(spark):
    schema = "name string, merchant_id bigint, category_id bigint, good_id bigint"
    docs = [("Phone", 1, 1, 1), ("", 1, 1, 1), ("", None, None, None), ("x" * 501, 1, 1, 1), ("x" * 500, 0, 1, None)]
    df = spark.createDataFrame(docs, schema)
    got = [r["broken"] for r in quality.broken_rules(df, quality.PRODUCT_RULES).collect()]
    assert got == [
        [], ["name.minLength"], ["name.minLength", "merchant_id.required", "category_id.required"],
        ["name.maxLength"], ["merchant_id.minimum"],
    ]
    reviews = spark.createDataFrame(
        [(1, 1, 0, ""), (1, 1, 6, "y" * 2001), (1, 1, None, None)], "product_id bigint, user_id bigint, rating bigint, comment string"
    )
    assert [r["broken"] for r in quality.broken_rules(reviews, quality.REVIEW_RULES).collect()] == [
        ["rating.minimum"], ["rating.maximum", "comment.maxLength"], ["rating.required"],
    ]
    missing = quality.broken_rules(spark.createDataFrame([("n",)], "name string"), quality.PRODUCT_RULES)
    assert missing.first()["broken"] == ["merchant_id.required", "category_id.required"]
    typed = quality.broken_rules(
        spark.createDataFrame([("x",), ("3",)], "merchant_id string"), [quality.Rule("merchant_id", kind="int", minimum=1)]
    )
    assert [r["broken"] for r in typed.collect()] == [["merchant_id.type"], []]
    listed = quality.broken_rules(
        spark.createDataFrame([(["a", "b"], "AB1"), ([], "ab")], "tags array<string>, code string"),
        [quality.Rule("tags", max_items=1), quality.Rule("code", pattern="^[A-Z]+$")],
    )
    assert [r["broken"] for r in listed.collect()] == [["tags.maxItems", "code.pattern"], ["code.pattern"]]


def test_checks_pass_null(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (6,)], "rating bigint")
    assert rows(quality.check_violations(df, F.col("rating").between(1, 5))) == [(0,), (6,)]


def test_copy_parity_sees_changed_values(spark):
    df = people(spark)
    changed = df.withColumn("n", F.coalesce("n", F.lit(0)))
    got = {r["table"]: r["same"] for r in quality.copy_parity(a=(df, df.repartition(3)), b=(df, changed)).collect()}
    assert got == {"a": True, "b": False}


def test_nested_fields(spark):
    df = spark.sql("select map('a','1','b','2') m, array('x') t union all select null, null")
    got = df.select(set_nested("m", a=9, c="z").alias("s"), unset_nested("m", "a").alias("u"), push("t", "y").alias("p")).collect()
    assert got[0]["s"] == {"a": "9", "b": "2", "c": "z"} and got[0]["u"] == {"b": "2"} and got[0]["p"] == ["x", "y"]
    assert got[1]["s"] == {"a": "9", "c": "z"} and got[1]["u"] is None and got[1]["p"] == ["y"]


def test_nested_pages_hold_every_match(spark):
    left = spark.createDataFrame([(1,), (2,)], "k bigint")
    right = spark.range(0, 25).selectExpr("1L as k", "id as r")
    for split in (False, True):
        pages = lookup_nested(left, right, "k", "r", ["r"], page_size=10, split=split)
        got = {(r["k"], r["page"]): [m["r"] for m in r["matches"]] for r in pages.collect()}
        assert got == {(1, 0): list(range(10)), (1, 1): list(range(10, 20)), (1, 2): list(range(20, 25)), (2, 0): []}


def test_csv_keeps_rows_with_bad_numbers(spark, tmp_path):
    path = str(tmp_path / "csv")
    raw = spark.createDataFrame([("1", "a, b"), ("x", 'say "hi"'), (None, None)], "id string, name string")
    tables.export_csv(raw, path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    assert rows(tables.read_csv_entities(spark, path, schema)) == [(1, "a, b"), (None, 'say "hi"'), (None, None)]


def test_document_array_file(spark, tmp_path):
    (tmp_path / "docs.json").write_text('[{"good_id": 1, "tags": ["a"]},\n {"good_id": 2, "attributes": {}}]')
    schema = "good_id bigint, tags array<string>, attributes map<string,string>"
    docs = tables.read_documents(spark, str(tmp_path / "docs.json"), schema)
    assert rows(docs) == [(1, ["a"], None), (2, None, {})]
    assert rows(docs.where(filters.has_attributes("attributes"))) == []


def test_report_cache(spark, tmp_path):
    cache, made = ReportCache(spark, str(tmp_path / "cache"), max_age_s=300), []

    def compute():
        made.append(1)
        return spark.range(len(made))

    assert [cache.get("top", {"products": "v1"}, now, compute)[1] for now in (0.0, 299.0)] == ["fresh", "cache"]
    assert cache.get("top", {"products": "v2"}, 299.0, compute)[1] == "fresh"
    assert cache.get("top", {"products": "v2"}, 700.0, compute)[1] == "fresh"
    report, source = cache.get("top", {"products": "v2"}, 710.0, compute)
    assert (source, report.count(), len(made)) == ("cache", 3, 3)
