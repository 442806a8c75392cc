"""Envelopes, windows, late events and the streaming jobs."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tradeloom.functions.envelope import REQUIRED, group_key, normalised
from tradeloom.operators import quality, rollups
from tradeloom.plans.snapshots import SnapshotTable
from tradeloom.sources.events import RECORD, read_events
from tradeloom.sources.outbox import read_outbox_stream
from tradeloom.streaming import envelopes, jobs, windows

FULL = {f: "x" for f in REQUIRED} | {"eventType": "OrderCreated", "timestamp": "2024-01-01T00:00:10Z"}


def without(*names, **changed):
    return json.dumps({k: v for k, v in (FULL | changed).items() if k not in names})


CASES = [
    (without(), None, "OrderCreated"),
    (without(eventId=None), None, "OrderCreated"),
    (without("source"), "invalid envelope, missing: source", "OrderCreated"),
    ("", "invalid envelope, missing: " + ", ".join(REQUIRED), "UNKNOWN"),
    (None, "invalid envelope, missing: " + ", ".join(REQUIRED), "UNKNOWN"),
    ("   ", "not a JSON object", "UNKNOWN"),
    ("oops", "not a JSON object", "UNKNOWN"),
    ("[1]", "not a JSON object", "UNKNOWN"),
    ("5", "not a JSON object", "UNKNOWN"),
    ("null", "not a JSON object", "UNKNOWN"),
    ('{"eventType":"A"', "not a JSON object", "UNKNOWN"),
    (without(eventType=""), None, "UNKNOWN"),
    (without("eventType"), "invalid envelope, missing: eventType", "UNKNOWN"),
    (without(eventType=None), None, "UNKNOWN"),
    (without(eventType={"a": 1}), None, "UNKNOWN"),
    (without(eventType=[1]), None, "UNKNOWN"),
    (without(eventType="{a}"), None, "{a}"),
    (without(eventType=7), None, "7"),
    (without(eventType=True), None, "true"),
]


@pytest.fixture(scope="module")
def cases(spark):
    data = [(str(i), v, None, 0, i) for i, (v, _, _) in enumerate(CASES)]
    return spark.createDataFrame(data, RECORD).cache()


def test_validation(cases):
    got = {r["offset"]: r["error"] for r in envelopes.check_envelopes(cases).collect()}
    assert got == {i: error for i, (_, error, _) in enumerate(CASES)}


def test_split_is_complete(cases):
    valid, invalid = envelopes.split_envelopes(cases)
    assert valid.count() + invalid.count() == len(CASES)


def test_group_keys(cases):
    got = {r["offset"]: r["k"] for r in cases.select("offset", group_key(F.col("value")).alias("k")).collect()}
    assert got == {i: kind for i, (_, _, kind) in enumerate(CASES)}


def test_normalised(spark, cases):
    got = {r["offset"]: r["v"] for r in cases.select("offset", normalised(F.col("value")).alias("v")).collect()}
    for i, (value, _, kind) in enumerate(CASES):
        if value and value.startswith("{") and value.endswith("}"):
            want = json.loads(value) | {"normalizedType": "" if kind == "UNKNOWN" else kind.upper()}
            assert json.loads(got[i]) == want
        else:
            assert got[i] == value
    odd = spark.createDataFrame(
        [("{}",), (' { } ',), ('{"normalizedType":1,"eventType":"a\\"b","n":1.10}',)], "value string"
    ).select(normalised(F.col("value")))
    assert [json.loads(r[0]) for r in odd.collect()] == [
        {"normalizedType": ""}, {"normalizedType": ""}, {"normalizedType": 'A"B', "eventType": 'a"b', "n": 1.1},
    ]


LATE = ["00:00:10", "00:00:50", "00:01:25", "00:00:20", "00:01:31", "00:00:30"]


def test_late_rule(spark):
    day = 1_704_067_200_000
    data = [(0, i, day + 1000 * (60 * int(t[3:5]) + int(t[6:8]))) for i, t in enumerate(LATE)]
    df = spark.createDataFrame(data, "partition int, offset bigint, ms bigint")
    for chunk in (2, 1000):
        marked = windows.mark_late(df, "ms", chunk_rows=chunk)
        assert rows(marked.where("late"), "offset") == [(5,)]
        kept = marked.where("not late").groupBy(((F.col("ms") - day) / 60000).cast("int").alias("w")).count()
        assert rows(kept) == [(0, 3), (1, 2)]


def write_batch(spark, folder, records):
    """One topic file; files are read in the order they were written."""
    spark.createDataFrame(records, RECORD).coalesce(1).write.mode("append").json(folder)
    time.sleep(1.1)


def envelope(i, at, kind="A"):
    value = json.dumps(FULL | {"eventId": f"e{i}", "eventType": kind, "timestamp": f"2024-01-01T{at}Z"})
    return (str(i), value, None, 0, i)


def test_stream_drops_late_events(spark, tmp_path):
    """One row per batch; the default lets a row lag one batch, the strict
    setting drops it as the exact rule does."""
    folder = str(tmp_path / "topic")
    for i, at in enumerate(LATE[:3] + [LATE[4], LATE[5]]):
        write_batch(spark, folder, [envelope(i, at)])
    spark.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    try:
        stream = read_events(spark, folder, files_per_batch=1)
        query = jobs.count_events(stream, str(tmp_path / "t"), str(tmp_path / "c"), record_time=False)
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.statefulOperator.allowMultiple")
    day = 1_704_067_200_000
    counts = jobs.count_table(spark, str(tmp_path / "t")).read()
    assert rows(counts, "event_type", "window_start", "window_end", "event_count") == [
        ("A", day, day + 60000, 2), ("A", day + 60000, day + 120000, 2),
    ]
    dropped = sum(int(p["stateOperators"][0]["numRowsDroppedByWatermark"]) for p in query.recentProgress if p["stateOperators"])
    assert dropped == 1


def test_stream_equals_batch_over_many_batches(spark, tmp_path):
    folder = str(tmp_path / "topic")
    records = [envelope(i, f"00:{i // 20:02d}:{i % 60:02d}", "AB"[i % 2]) for i in range(120)]
    for n in range(3):
        write_batch(spark, folder, sorted(records[n * 40 : n * 40 + 40], key=lambda r: r[1]))
    batch = windows.windowed_count(envelopes.timed(envelopes.rekey(read_events(spark, folder, stream=False))))
    stream = read_events(spark, folder, files_per_batch=1)
    jobs.count_events(stream, str(tmp_path / "t"), str(tmp_path / "c"), grace="10 minutes").awaitTermination()
    got = jobs.count_table(spark, str(tmp_path / "t")).read().drop("ingested_at")
    assert rows(got) == rows(batch.select(*got.columns))


def test_two_readers_and_dead_letters(spark, tmp_path, cases):
    folder = str(tmp_path / "topic")
    cases.write.json(folder)
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    jobs.audit_events(read_events(spark, folder), out, dead, str(tmp_path / "c1")).awaitTermination()
    jobs.count_types(read_events(spark, folder), str(tmp_path / "types"), str(tmp_path / "c2")).awaitTermination()
    valid = [i for i, (_, error, _) in enumerate(CASES) if error is None]
    assert spark.read.parquet(out).count() == len(valid)
    assert spark.read.json(dead).count() == len(CASES) - len(valid)
    assert jobs.type_table(spark, str(tmp_path / "types")).read().agg(F.sum("n")).first()[0] == len(valid)


def deltas(spark, n, start=0):
    day = "date_add(date'2024-01-30', cast(id % 5 as int))"
    return spark.range(start, start + n).selectExpr(
        f"{day} as date", "id % 3 as category_id", "id % 7 as merchant_id", "id % 11 as good_id",
        "1L as orders_count", "0L as reviewed_count", "0L as rating_sum", "0L as review_count",
    )


def test_rollups_by_batch_equal_the_whole(spark, tmp_path):
    tables = jobs.rollup_tables(spark, str(tmp_path / "r"))
    for n in range(3):
        for kind, table in tables.items():
            keys = rollups.ROLLUP_KEYS[kind]
            assert table.add(rollups.fold(deltas(spark, 200, n * 200), keys), rollups.COUNTERS, n)
            # The same batch once more changes nothing.
            assert not table.add(rollups.fold(deltas(spark, 200, n * 200), keys), rollups.COUNTERS, n)
    for kind, table in tables.items():
        whole = rollups.fold(deltas(spark, 600), rollups.ROLLUP_KEYS[kind])
        assert rows(table.read()) == rows(whole.select(*table.read().columns))
        assert table.last_batch() == 2


def test_upsert_keeps_untouched_partitions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], F.pmod("k", F.lit(2)))
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, v string")
    table.upsert(first, 0)
    old = table.read()
    table.upsert(spark.createDataFrame([(1, "new"), (5, "five")], "k bigint, v string"), 1)
    table.upsert(spark.createDataFrame([], "k bigint, v string"), 2)
    assert rows(table.read()) == [(1, "new"), (2, "b"), (3, "c"), (5, "five")]
    # A reader that opened the table before still sees what it opened.
    assert rows(old) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_commit_that_stopped_before_its_log_is_invisible(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], F.pmod("k", F.lit(2)))
    rows_in = spark.createDataFrame([(1, "a")], "k bigint, v string")
    table.upsert(rows_in, 0)
    rows_in.withColumn("part", F.lit("1")).write.partitionBy("part").parquet(str(tmp_path / "u/data/000000000001-dead"))
    assert rows(table.read()) == [(1, "a")]


def test_prune_keeps_what_is_current(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], F.pmod("k", F.lit(2)))
    for n in range(4):
        table.upsert(spark.createDataFrame([(1, f"v{n}")] + [(2, "even")] * (n == 0), "k bigint, v string"), n)
    # Version 0 still holds the even partition; 1 and 2 are replaced.
    assert table.prune(keep=1) == 2
    assert rows(table.read()) == [(1, "v3"), (2, "even")]
    assert table.prune(keep=1) == 0


def test_many_batches_keep_a_short_log(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], F.lit("all"))
    empty = spark.createDataFrame([], "k bigint, v string")
    table.upsert(spark.createDataFrame([(1, "a")], "k bigint, v string"), 0)
    for n in range(1, 60):
        assert table.upsert(empty, n)
    assert len(list((tmp_path / "u/log").glob("*.json"))) <= 21
    assert table.last_batch() == 59 and rows(table.read()) == [(1, "a")]
    assert not table.upsert(empty, 58)


def test_of_two_writers_one_wins(spark, tmp_path):
    from tradeloom.plans.snapshots import ConcurrentCommit

    one = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], F.lit("all"))
    two = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], F.lit("all"))
    first = spark.createDataFrame([(1, "one")], "k bigint, v string")

    def during(old, new):
        two.upsert(spark.createDataFrame([(2, "two")], "k bigint, v string"), 5)
        return old.unionByName(new)

    with pytest.raises(ConcurrentCommit):
        one.commit(first, during, 6)
    assert rows(one.read()) == [(2, "two")]
    assert one.upsert(first, 6) and rows(two.read()) == [(1, "one"), (2, "two")]


def test_outbox_refuses_a_used_batch(spark, tmp_path):
    marks = jobs.outbox_marks(spark, str(tmp_path / "marks"))
    outbox = spark.range(1, 5).toDF("id")
    assert jobs.poll_outbox(outbox, marks, lambda df, n: df.count(), 3) == 4
    with pytest.raises(ValueError):
        jobs.poll_outbox(spark.range(1, 9).toDF("id"), marks, lambda df, n: df.count(), 3)


def test_wide_partition_gets_several_writers(spark, tmp_path, monkeypatch):
    from tradeloom.plans import snapshots

    monkeypatch.setattr(snapshots, "FILE_ROWS", 100)
    table = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], F.lit("one"))
    table.upsert(spark.range(1000).selectExpr("id as k", "'x' as v"), 0)
    files = list((tmp_path / "u" / "data").rglob("*.parquet"))
    assert len(files) > 3 and table.read().count() == 1000


def test_uneven_partitions_are_dealt_evenly(spark, tmp_path):
    size = F.when(F.col("k") < 40_000, "small").when(F.col("k") < 50_000, "tiny").otherwise("large")
    table = SnapshotTable(spark, str(tmp_path / "u"), "k bigint, v string", ["k"], size)
    new = spark.range(400_000).selectExpr("id as k", "'x' as v")
    table.upsert(new, 0)
    # A change of few rows rewrites what is stored, by as many writers.
    table.upsert(spark.createDataFrame([(7, "y"), (399_999, "y"), (400_000, "y")], "k bigint, v string"), 1)
    for version in (tmp_path / "u" / "data").iterdir():
        files = [spark.read.parquet(str(f)).count() for f in version.rglob("*.parquet")]
        assert max(files) < 110_000 and len(files) < 9
    assert rows(table.read().groupBy("v").count()) == [("x", 399_998), ("y", 3)]
    assert table.read().select("k").distinct().count() == 400_001


def test_outbox_resumes_after_the_stored_mark(spark, tmp_path):
    marks = jobs.outbox_marks(spark, str(tmp_path / "marks"))
    box = spark.createDataFrame([(i, f"t{i % 2}") for i in range(1, 6)], "id bigint, event_type string")
    got = []

    def sink(rows_, batch_id):
        got.append([r["id"] for r in rows_.orderBy("id").collect()])

    assert jobs.poll_outbox(box.where("id <= 2"), marks, sink, 0) == 2
    assert jobs.poll_outbox(box, marks, sink, 1) == 5
    assert jobs.poll_outbox(box, marks, sink, 2) == 5

    def broken(rows_, batch_id):
        raise RuntimeError("sink down")

    more = box.unionByName(spark.createDataFrame([(6, "t0")], "id bigint, event_type string"))
    with pytest.raises(RuntimeError):
        jobs.poll_outbox(more, marks, broken, 3)
    assert jobs.poll_outbox(more, marks, sink, 3) == 6
    assert got == [[1, 2], [3, 4, 5], [6]]


def test_stream_time_goes_on_after_a_restart(spark, tmp_path):
    """Two partitions in shuffled batches, some records without a time; each run starts from the checkpoint of the one before."""
    rng = random.Random(4)
    records = []
    for offset in range(300):
        ms = offset * 20_000 - rng.choice([0, 0, 0, 400_000, 90_000]) + 10**9
        records.append((offset % 2, offset, None if offset % 37 == 5 else ms, f"v{offset}"))
    schema = "partition int, offset bigint, ms bigint, value string"
    top, want = {}, []
    for p, offset, ms, value in records:
        if ms is not None:
            top[p] = max(top.get(p, ms), ms)
        late = None if ms is None else ms - ms % 60_000 + 60_000 <= top[p] - 30_000
        want.append((p, offset, ms, value, top.get(p), late))
    source, out, progress = (str(tmp_path / n) for n in ("topic", "out", "progress"))
    for run in range(4):
        part = records[run * 75 : run * 75 + 75]
        rng.shuffle(part)
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.mark_late_events(stream, "ms", out, progress).awaitTermination()
    got = spark.read.schema(schema + ", stream_time bigint, late boolean").parquet(out)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == want
    assert {w[5] for w in want} == {True, False, None}


def test_outbox_stream_resumes_behind_the_last_id(spark, tmp_path):
    table, out, progress = (str(tmp_path / n) for n in ("outbox", "out", "progress"))
    schema = "id bigint, event_type string, entity_id string, payload string, created_at timestamp_ntz"
    row = lambda i: (i, "type", f"u-{i}", None if i % 5 == 0 else "{}", None)
    for low, high in ((1, 40), (40, 41), (41, 41), (41, 95)):
        spark.createDataFrame([row(i) for i in range(low, high)], schema).repartition(2).write.mode("append").parquet(table)
        stream = read_outbox_stream(spark, table, starting_id=3, task_ids=7)
        stream.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.schema(schema).parquet(out)
    assert sorted(tuple(r) for r in got.select("id", "event_type", "entity_id").collect()) == [row(i)[:3] for i in range(4, 95)]
    assert got.where("payload is null").count() == 18


def test_document_checks_look_at_the_type_a_value_came_with(spark):
    rules = [
        quality.Rule("name", required=True, kind="string", min_length=2, max_length=4, pattern="^[a-z]*$"),
        quality.Rule("n", kind="int", minimum=1, maximum=9),
        quality.Rule("tags", max_items=2),
    ]
    cases = {
        '{"name": "abc", "n": 3, "tags": [1, 2]}': [],
        '{"name": 5}': ["name.type"],
        '{"name": "5"}': ["name.minLength", "name.pattern"],
        '{"n": 2.0}': ["name.required"],
        '{"name": null, "n": "3"}': ["name.type", "n.type"],
        '{"name": {"a": 1}, "n": 0, "tags": []}': ["name.type", "n.minimum"],
        '{"name": "abcde", "n": 10.5, "tags": [1, 2, 3]}': ["name.maxLength", "n.type", "n.maximum", "tags.maxItems"],
        '{"name": "ab", "n": true, "tags": "abc"}': ["n.type"],
        "[1]": ["document.type"],
        '{"name": ': ["document.type"],
        "null": ["document.type"],
        "": ["document.type"],
    }
    df = spark.createDataFrame([(b,) for b in cases] + [(None,)], "body string")
    got = {r.body: r.broken for r in quality.broken_json_rules(df, "body", rules).collect()}
    assert got == {**cases, None: ["document.type"]}
