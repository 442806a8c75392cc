"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.base import check_sql, half_even_sql, half_up_sql, query
from tradeloom.functions.dialect import ratio, ratio_half_even, ratio_half_up, round_to_int, to_integer, whole_div
from tradeloom.functions.hashing import bucket_of, mix_sql, pick_from
from tradeloom.sources.market import Market


@query(
    "text_basics",
    "F1",
    "SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, substr(c_name, 1, 4) AS head, length(c_name) AS len FROM customer",
)
def _(m: Market):
    return m.table("customer").select(
        "c_custkey",
        F.concat_ws("/", "c_name", "c_mktsegment").alias("joined"),
        F.substring("c_name", 1, 4).alias("head"),
        F.length("c_name").cast("bigint").alias("len"),
    )


@query(
    "text_functions",
    "F2",
    """SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, trim('  ' || p_name || ' ') AS trimmed,
              string_split(p_name, ' ')[1] AS first_word, replace(p_name, 'r', 'R') AS replaced,
              substr(p_name, 2, 3) AS from_one, length(p_name) AS len FROM part""",
)
def _(m: Market):
    """Positions are counted from 0 here: ``substring(name, 1, 3)``."""
    return m.table("part").select(
        "p_partkey",
        F.upper("p_name").alias("up"),
        F.lower("p_brand").alias("low"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.get(F.split("p_name", " "), F.lit(0)).alias("first_word"),
        F.replace("p_name", F.lit("r"), F.lit("R")).alias("replaced"),
        F.substring("p_name", 1 + 1, 3).alias("from_one"),
        F.length("p_name").cast("bigint").alias("len"),
    )


@query("upper_event_types", "F3", "SELECT event_id, upper(event_type) AS normalized_type FROM events")
def _(m: Market):
    return m.table("events").select("event_id", F.upper("event_type").alias("normalized_type"))


@query(
    "number_functions",
    "F4",
    """SELECT c_custkey, abs(c_acctbal) AS magnitude, round(sqrt(c_custkey), 9) AS root, round(ln(c_custkey + 1), 9) AS nat_log,
              CAST(floor(c_acctbal) AS BIGINT) AS low, c_custkey % 7 AS rest, c_custkey // 7 AS whole, round(c_acctbal / 3, 4) AS third
       FROM customer""",
)
def _(m: Market):
    return m.table("customer").select(
        "c_custkey",
        F.abs("c_acctbal").alias("magnitude"),
        F.round(F.sqrt("c_custkey"), 9).alias("root"),
        F.round(F.log(F.col("c_custkey") + 1), 9).alias("nat_log"),
        F.floor("c_acctbal").alias("low"),
        F.pmod("c_custkey", F.lit(7)).alias("rest"),
        whole_div(F.col("c_custkey"), F.lit(7).cast("bigint")).alias("whole"),
        F.round(F.col("c_acctbal") / 3, 4).alias("third"),
    )


@query(
    "rounding_rules",
    "F5",
    f"""SELECT s_suppkey, {half_up_sql("t", "n", 1)} AS half_up, {half_even_sql("t", "n", 1)} AS half_even,
               round(t / n, 6) AS plain
        FROM (SELECT s_suppkey, s_suppkey * 7 AS t, 20 AS n FROM supplier)""",
)
def _(m: Market):
    """Sevenths of twenty: every other value is an exact tie."""
    t, n = F.col("s_suppkey") * 7, F.lit(20).cast("bigint")
    return m.table("supplier").select(
        "s_suppkey",
        ratio_half_up(t, n, 1).alias("half_up"),
        ratio_half_even(t, n, 1).alias("half_even"),
        F.round(ratio(t, n), 6).alias("plain"),
    )


@query(
    "casts",
    "F6",
    """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS as_text,
              CAST(round(CAST(c_acctbal AS DECIMAL(12,2)), 0) AS BIGINT) AS rounded,
              CAST(CAST(round(CAST(c_acctbal AS DECIMAL(12,2)), 1) AS DECIMAL(12,1)) AS DOUBLE) AS one_place,
              TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE CAST(c_custkey AS VARCHAR) END AS BIGINT) AS parsed
       FROM customer""",
)
def _(m: Market):
    text = F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.col("c_mktsegment")).otherwise(F.col("c_custkey").cast("string"))
    exact = F.col("c_acctbal").cast("decimal(12,2)")
    return m.table("customer").select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("as_text"),
        round_to_int(exact).alias("rounded"),
        F.round(exact, 1).cast("double").alias("one_place"),
        to_integer(text).alias("parsed"),
    )


@query("hashed_names", "F7", "SELECT c_custkey, md5(c_name) AS digest FROM customer")
def _(m: Market):
    return m.table("customer").select("c_custkey", F.md5("c_name").alias("digest"))


@query(
    "hash_buckets_spread",
    "F8",
    "SELECT count(*) AS total, 0::BIGINT AS outside, true AS even FROM customer",
)
def _(m: Market):
    """All rows in buckets 0 to 15, and none of them far from its share (six standard deviations)."""
    buckets = m.table("customer").groupBy(bucket_of("c_name", 16).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    share = F.sum("n") / 16
    far = F.greatest(F.max("n") - share, share - F.min("n"))
    return buckets.agg(
        F.sum("n").alias("total"),
        F.count_if(~F.col("bucket").between(0, 15)).alias("outside"),
        (far <= 6 * F.sqrt(share) + 1).alias("even"),
    )


@query("hash_buckets", "F8")
def _(m: Market):
    return m.table("customer").groupBy(bucket_of("c_name", 16).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "time_functions",
    "F9",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso, epoch_us(ts) // 1000 AS ms,
              epoch_us(date_trunc('second', ts)) // 1000 AS ms_again FROM events""",
)
def _(m: Market):
    at = F.col("ts").cast("timestamp")
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return m.table("events").select(
        "event_id", iso.alias("iso"), F.unix_millis(at).alias("ms"), F.unix_millis(F.to_timestamp(iso)).alias("ms_again")
    )


@query(
    "date_functions",
    "F10",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS month,
              strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d') AS month_before FROM orders""",
)
def _(m: Market):
    return m.table("orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").cast("string").alias("day"),
        F.date_format("o_orderdate", "yyyyMM").cast("bigint").alias("month"),
        F.to_date(F.col("o_orderdate") - F.make_dt_interval(F.lit(30))).cast("string").alias("month_before"),
    )


@query(
    "interval_seconds",
    "F11",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) AS seconds
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(m: Market):
    joined = m.table("lineitem").join(m.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def seconds(c):
        return F.unix_timestamp(F.col(c).cast("timestamp"))

    return joined.select(
        "l_orderkey", F.col("l_linenumber"), "l_partkey", "l_suppkey",
        (seconds("l_shipdate") - seconds("o_orderdate")).alias("seconds"),
    )


@query(
    "list_functions",
    "F12 T6",
    """SELECT p_partkey, len(w) AS n, w[1] AS first, w[5] AS fifth, array_to_string(w[1:1], '|') AS sliced,
              len(list_distinct(list_concat(w, ['red', 'ring']))) AS union_size, len(list_intersect(w, ['red', 'ring'])) AS common
       FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
)
def _(m: Market):
    """Index and slice count from 0 and give NULL or less beyond the end."""
    some = F.array(F.lit("red"), F.lit("ring"))
    words = m.table("part").select("p_partkey", F.split("p_name", " ").alias("w"))
    return words.select(
        "p_partkey",
        F.size("w").cast("bigint").alias("n"),
        F.get("w", F.lit(0)).alias("first"),
        F.get("w", F.lit(4)).alias("fifth"),
        F.array_join(F.slice("w", 0 + 1, 1 - 0), "|").alias("sliced"),
        F.size(F.array_union("w", some)).cast("bigint").alias("union_size"),
        F.size(F.array_intersect("w", some)).cast("bigint").alias("common"),
    )


@query(
    "list_comprehensions",
    "F13",
    """SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda x: length(x) > 3),
              lambda x: upper(x)), '|') AS long_words FROM part""",
)
def _(m: Market):
    long_words = F.filter(F.split("p_name", " "), lambda w: F.length(w) > 3)
    return m.table("part").select(
        "p_partkey", F.array_join(F.transform(long_words, lambda w: F.upper(w)), "|").alias("long_words")
    )


@query(
    "number_series",
    "F15",
    "SELECT p_partkey, unnest(range(1, p_size + 1)) AS n FROM part",
)
def _(m: Market):
    series = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("p_size").cast("bigint"))).alias("n")
    return m.table("part").select("p_partkey", series)


_COLOURS = ["red", "green", "blue", "grey", "black"]


@query(
    "picked_values",
    "F16",
    f"SELECT c_custkey, [{', '.join(repr(c) for c in _COLOURS)}][CAST({mix_sql('c_custkey', 5)} % 5 + 1 AS INTEGER)] AS colour FROM customer",
)
def _(m: Market):
    return m.table("customer").select("c_custkey", pick_from(_COLOURS, "c_custkey", 5).alias("colour"))


@query(
    "built_objects",
    "F17",
    """SELECT s_suppkey, '{"merchant":"' || s_name || '","nation":' || s_nationkey || '}' AS object, s_name AS looked_up FROM supplier""",
)
def _(m: Market):
    made = F.create_map(F.lit("merchant"), F.col("s_name"), F.lit("other"), F.lit("-"))
    return m.table("supplier").select(
        "s_suppkey",
        F.to_json(F.struct(F.col("s_name").alias("merchant"), F.col("s_nationkey").alias("nation"))).alias("object"),
        made["merchant"].alias("looked_up"),
    )


@query(
    "json_paths",
    "F18",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              coalesce(json_extract_string(props, '$.absent'), 'none') AS absent FROM events""",
)
def _(m: Market):
    return m.table("events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.coalesce(F.get_json_object("props", "$.absent"), F.lit("none")).alias("absent"),
    )


@query(
    "edge_type_values",
    "F20",
    check_sql(
        "bought reviews",
        """SELECT 'BOUGHT' AS edge_type, count(*) AS n FROM bought UNION ALL SELECT 'REVIEWED', count(*) FROM reviews""",
    ),
)
def _(m: Market):
    from tradeloom.operators.graph import any_edge, build_graph

    edges = any_edge(build_graph(m.users, m.goods, m.categories, m.orders, m.reviews))
    return edges.where(F.col("edge_type") != "SOLD_BY").groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"))
