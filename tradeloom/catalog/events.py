"""The event pipeline on the ``events`` table.

Each event becomes a topic record with a JSON envelope.  Some records are
spoiled by their number, so that every way an envelope can be wrong is there.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.base import check_sql, query
from tradeloom.functions.hashing import mix_sql
from tradeloom.operators import generate
from tradeloom.plans.staging import new_folder
from tradeloom.sources.events import read_events
from tradeloom.sources.market import Market
from tradeloom.sources.outbox import read_outbox_stream
from tradeloom.sources.tables import read_outbox_increment, trim_outbox, write_dead_letters
from tradeloom.streaming import envelopes, jobs, market, windows

# ---------------------------------------------------------------- the records

_BODY = """'{"eventId":"e-' || event_id || '","eventType":' || kind || ',"entityId":"u-' || user_id || '","timestamp":"' ||
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z","source":"test","payload":' || props"""
RECORDS_SQL = f"""
  SELECT event_id, user_id, ts, event_type, kind,
         CASE event_id % 50 WHEN 1 THEN {_BODY} || '}}'
                            WHEN 2 THEN '' WHEN 3 THEN 'not json' WHEN 4 THEN '[1,2]'
              ELSE {_BODY} || ',"version":"1.0","metadata":{{"correlationId":"c-' || event_id || '"}}}}' END AS value,
         CASE WHEN event_id % 50 IN (2, 3, 4, 5, 6, 7) THEN 'UNKNOWN' ELSE event_type END AS key_type,
         CASE event_id % 50 WHEN 1 THEN 'invalid envelope, missing: version, metadata'
              WHEN 2 THEN 'invalid envelope, missing: eventId, eventType, entityId, timestamp, source, payload, version, metadata'
              WHEN 3 THEN 'not a JSON object' WHEN 4 THEN 'not a JSON object' END AS error
  FROM (SELECT *, CASE event_id % 50 WHEN 5 THEN '""' WHEN 6 THEN 'null' WHEN 7 THEN '{{"x":1}}'
                       ELSE '"' || event_type || '"' END AS kind FROM events)"""


def records(m: Market):
    """Topic records of the events: key, value, timestamp, partition, offset."""
    case = F.pmod("event_id", F.lit(50))
    kind = (
        F.when(case == 5, '""').when(case == 6, "null").when(case == 7, '{"x":1}')
        .otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    )
    head = F.concat(
        F.lit('{"eventId":"e-'), F.col("event_id").cast("string"),
        F.lit('","eventType":'), kind,
        F.lit(',"entityId":"u-'), F.col("user_id").cast("string"),
        F.lit('","timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('Z","source":"test","payload":'), F.col("props"),
    )
    tail = F.concat(F.lit(',"version":"1.0","metadata":{"correlationId":"c-'), F.col("event_id").cast("string"), F.lit('"}}'))
    value = (
        F.when(case == 1, F.concat(head, F.lit("}"))).when(case == 2, "").when(case == 3, "not json").when(case == 4, "[1,2]")
        .otherwise(F.concat(head, tail))
    )
    return m.table("events").select(
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def topic(m: Market, rows=None) -> str:
    """The records as a topic folder."""
    path = new_folder(m.spark, "topic")
    (records(m) if rows is None else rows).write.json(path)
    return path


def _sql(body: str, **ctes: str) -> str:
    return check_sql("", body, r=RECORDS_SQL, **ctes)


@query("topic_records", "SRC4", _sql("SELECT event_id AS \"offset\", CAST(user_id AS VARCHAR) AS key, value FROM r"))
def _(m: Market):
    return read_events(m.spark, topic(m), stream=False).select("offset", "key", "value")


@query("valid_envelopes", "S1", _sql("SELECT event_id AS \"offset\", value FROM r WHERE error IS NULL"))
def _(m: Market):
    return envelopes.split_envelopes(records(m))[0].select("offset", "value")


@query("invalid_envelopes", "S1 S3", _sql("SELECT event_id AS \"offset\", value, error FROM r WHERE error IS NOT NULL"))
def _(m: Market):
    return envelopes.split_envelopes(records(m))[1].select("offset", "value", "error")


_AUDIT = _sql(
    """SELECT 'e-' || event_id AS "eventId", CASE event_id % 50 WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN '{"x":1}' ELSE event_type END AS "eventType",
              'u-' || user_id AS "entityId" FROM r WHERE error IS NULL"""
)


@query("audit_projection", "S2", _AUDIT)
def _(m: Market):
    return envelopes.audit(envelopes.split_envelopes(records(m))[0])


def _audit_run(m: Market):
    out, dead = new_folder(m.spark, "audit"), new_folder(m.spark, "dead")
    stream = read_events(m.spark, topic(m))
    jobs.audit_events(stream, out, dead, new_folder(m.spark, "progress")).awaitTermination()
    return out, dead


@query("audited_events", "S2 S11", _AUDIT)
def _(m: Market):
    """The audit trail as the streaming job leaves it."""
    return m.spark.read.parquet(_audit_run(m)[0]).select("eventId", "eventType", "entityId")


_DEAD_SCHEMA = "key string, value string, headers array<struct<key:string,value:string>>"


@query(
    "dead_letters",
    "S3 SNK5",
    _sql(
        """SELECT CAST(user_id AS VARCHAR) AS key, value, error, 'audit-consumers' AS consumer FROM r WHERE error IS NOT NULL"""
    ),
)
def _(m: Market):
    """The dead letters as the streaming job leaves them."""
    dead = m.spark.read.schema(_DEAD_SCHEMA).json(_audit_run(m)[1])
    return dead.select(
        "key", "value", F.col("headers")[0]["value"].alias("error"), F.col("headers")[1]["value"].alias("consumer")
    )


@query(
    "normalised_records",
    "S4 F3",
    _sql(
        """SELECT event_id AS "offset", CASE WHEN event_id % 50 IN (2, 3, 4) THEN value
                  ELSE left(value, length(value) - 1) || ',"normalizedType":"' ||
                       CASE WHEN key_type = 'UNKNOWN' THEN '' ELSE upper(event_type) END || '"}' END AS value FROM r"""
    ),
)
def _(m: Market):
    return envelopes.normalise(records(m)).select("offset", "value")


@query("rekeyed_records", "S5", _sql("SELECT event_id AS \"offset\", key_type AS key FROM r"))
def _(m: Market):
    return envelopes.rekey(records(m)).select("offset", "key")


_COUNTS = _sql(
    """SELECT key_type AS event_type, w AS window_start, w + 60000 AS window_end, count(*) AS event_count
       FROM (SELECT key_type, epoch_us(date_trunc('minute', ts)) // 1000 AS w FROM r) GROUP BY 1, 2"""
)


@query("windowed_counts", "S6", _COUNTS)
def _(m: Market):
    return windows.windowed_count(envelopes.timed(envelopes.rekey(records(m))))


def _later(m: Market):
    """The same records, received 90 seconds after what their envelopes say."""
    return envelopes.rekey(records(m).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 90 SECONDS")))


@query(
    "windowed_counts_by_record_time",
    "S6",
    _sql(
        """SELECT key_type AS event_type, w AS window_start, w + 60000 AS window_end, count(*) AS event_count
           FROM (SELECT key_type, epoch_us(date_trunc('minute', ts + INTERVAL 90 SECOND)) // 1000 AS w FROM r) GROUP BY 1, 2"""
    ),
)
def _(m: Market):
    return windows.windowed_count(envelopes.timed(_later(m)))


@query(
    "windowed_counts_by_envelope_time",
    "S6",
    _sql(
        """SELECT key_type AS event_type, w AS window_start, w + 60000 AS window_end, count(*) AS event_count
           FROM (SELECT key_type, epoch_us(date_trunc('minute', CASE WHEN event_id % 50 IN (2, 3, 4) THEN ts + INTERVAL 90 SECOND
                                                                     ELSE ts END)) // 1000 AS w FROM r) GROUP BY 1, 2"""
    ),
)
def _(m: Market):
    return windows.windowed_count(envelopes.timed(_later(m), record_time=False))


@query("streamed_windowed_counts", "S6 SNK3", _COUNTS)
def _(m: Market):
    """The counts as the streaming job leaves them in its keyed table."""
    target = new_folder(m.spark, "counts")
    stream = read_events(m.spark, topic(m))
    jobs.count_events(stream, target, new_folder(m.spark, "progress")).awaitTermination()
    return jobs.count_table(m.spark, target).read().drop("ingested_at")


_LATE = """
  SELECT event_id AS "offset", t AS ts_ms, s AS stream_time, (t - t % 60000 + 60000) <= s - 30000 AS late
  FROM (SELECT event_id, t, max(t) OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS s FROM (
          SELECT event_id, user_id, epoch_us(ts) // 1000 - (event_id * 7919 % 11) * 600000 AS t FROM events))"""


@query("late_events", "S7", _LATE)
def _(m: Market):
    """Events whose time is set back by up to 100 minutes, replayed in order."""
    back = F.pmod(F.col("event_id") * 7919, F.lit(11)) * 600000
    replay = m.table("events").select(
        F.pmod("user_id", F.lit(4)).alias("partition"),
        F.col("event_id").alias("offset"),
        (F.unix_millis(F.col("ts").cast("timestamp")) - back).alias("ts_ms"),
    )
    return windows.mark_late(replay, "ts_ms").select("offset", "ts_ms", "stream_time", "late")


@query("streamed_late_events", "S7", _LATE)
def _(m: Market):
    """The same rule on the stream: four runs from one checkpoint, each with the next quarter of the topic, shuffled."""
    events = m.table("events")
    back = F.pmod(F.col("event_id") * 7919, F.lit(11)) * 600000
    replay = events.select(
        F.pmod("user_id", F.lit(4)).alias("partition"),
        F.col("event_id").alias("offset"),
        (F.unix_millis(F.col("ts").cast("timestamp")) - back).alias("ts_ms"),
    )
    last = events.agg(F.max("event_id")).first()[0] or 0
    source, target, progress = (new_folder(m.spark, label) for label in ("replay", "late", "progress"))
    for quarter in range(4):
        own = F.floor(F.col("offset") * 4 / (last + 1)) == quarter
        replay.where(own).orderBy(F.xxhash64("offset")).write.mode("append").parquet(source)
        stream = m.spark.readStream.schema(replay.schema).parquet(source)
        jobs.mark_late_events(stream, "ts_ms", target, progress).awaitTermination()
    out = "offset bigint, ts_ms bigint, stream_time bigint, late boolean"
    return m.spark.read.schema(out).parquet(target)


def _twice(m: Market):
    once = records(m)
    return once.unionByName(once.where(F.pmod("offset", F.lit(3)) == 0))


_ONCE = _sql("SELECT 'e-' || event_id AS \"eventId\" FROM r WHERE event_id % 50 NOT IN (2, 3, 4)")


def _identified(df):
    keyed = envelopes.timed(df).withColumn("eventId", F.get_json_object("value", "$.eventId"))
    return keyed.where(F.col("eventId").isNotNull())


@query("deduplicated_events", "S9", _ONCE)
def _(m: Market):
    return envelopes.dedup(_identified(_twice(m))).select("eventId")


@query("streamed_deduplicated_events", "S9", _ONCE)
def _(m: Market):
    """A third of the records arrive twice; the stream keeps each event once."""
    target = new_folder(m.spark, "once")
    stream = _identified(read_events(m.spark, topic(m, _twice(m))))
    (
        envelopes.dedup(stream, "1 hour").select("eventId").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", new_folder(m.spark, "progress")).trigger(availableNow=True).start(target)
        .awaitTermination()
    )
    return m.spark.read.schema("eventId string").parquet(target)


@query(
    "running_type_counts",
    "A31 S11",
    _sql("SELECT key_type AS event_type, count(*) AS n FROM r WHERE error IS NULL GROUP BY 1"),
)
def _(m: Market):
    """Second reader of the topic: running counters per type."""
    target = new_folder(m.spark, "type-counts")
    jobs.count_types(read_events(m.spark, topic(m)), target, new_folder(m.spark, "progress")).awaitTermination()
    return jobs.type_table(m.spark, target).read()


# ---------------------------------------------------------------- outbox


def outbox(m: Market):
    return m.table("events").select(
        (F.col("event_id") + 1).alias("id"),
        "event_type",
        F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("entity_id"),
        F.col("props").alias("payload"),
        F.col("ts").alias("created_at"),
    )


@query(
    "outbox_increment",
    "SRC5",
    "SELECT event_id + 1 AS id, event_type, props AS payload FROM events WHERE event_id + 1 > 700",
)
def _(m: Market):
    return read_outbox_increment(outbox(m), 700).select("id", "event_type", "payload")


@query(
    "trimmed_outbox",
    "SNK7",
    "SELECT event_id + 1 AS id, event_type FROM events WHERE event_id + 1 >= (SELECT max(event_id) + 1 - 100 FROM events)",
)
def _(m: Market):
    return trim_outbox(outbox(m)).select("id", "event_type")


@query(
    "polled_outbox",
    "S10",
    "SELECT event_id + 1 AS id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END::BIGINT AS poll FROM events",
)
def _(m: Market):
    """Three polls: the rows of the first half of the month, then everything,
    then everything again with nothing new in it."""
    target, marks = new_folder(m.spark, "delivered"), jobs.outbox_marks(m.spark, new_folder(m.spark, "marks"))

    def sink(rows, batch_id):
        rows.select("id", F.lit(batch_id).cast("bigint").alias("poll")).write.mode("overwrite").parquet(
            f"{target}/batch={batch_id}"
        )

    everything = outbox(m)
    early = everything.where(F.col("created_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    for number, seen in enumerate((early, everything, everything)):
        jobs.poll_outbox(seen, marks, sink, number)
    return m.spark.read.schema("id bigint, poll bigint").parquet(target).select("id", "poll")


@query(
    "streamed_outbox",
    "S10 SRC5",
    """SELECT event_id + 1 AS id, event_type, 'u-' || user_id AS entity_id, props AS payload, ts AS created_at,
              CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END::BIGINT AS run FROM events""",
)
def _(m: Market):
    """The outbox as a stream, stopped and resumed: the first half of the month, then everything, then nothing new."""
    table, target, progress = (new_folder(m.spark, label) for label in ("outbox", "delivered", "progress"))
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    for number, own in enumerate((F.col("created_at") < half, F.col("created_at") >= half, F.lit(False))):
        rows = outbox(m).where(own)
        rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz")).write.mode("append").parquet(table)
        stream = read_outbox_stream(m.spark, table).withColumn("run", F.lit(number).cast("bigint"))
        writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start(target).awaitTermination()
    schema = "id bigint, event_type string, entity_id string, payload string, created_at timestamp_ntz, run bigint"
    return m.spark.read.schema(schema).parquet(target)


@query(
    "routed_events",
    "S12",
    """SELECT CASE WHEN event_type IN ('click', 'view') THEN 'browsing' WHEN event_type = 'purchase' THEN 'sales' ELSE 'other' END AS route,
              event_id FROM events""",
)
def _(m: Market):
    routes = envelopes.route(m.table("events"), {"browsing": ["click", "view"], "sales": ["purchase"]})
    parts = [df.select(F.lit(name).alias("route"), "event_id") for name, df in routes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- feed

_FEED_ORDERS = f"""
  SELECT o.order_id, c.user_id, g.good_id, ({mix_sql('o.order_id', 83)} % 49001 + 1000) / 100.0::DOUBLE AS price
  FROM (SELECT order_id, {mix_sql('order_id', 81)} % (SELECT count(*) FROM customer) + 1 AS cn,
               {mix_sql('order_id', 82)} % (SELECT count(*) FROM part) + 1 AS gn
        FROM (SELECT event_id * 3 + i + 1 AS order_id FROM events, (SELECT unnest([0, 1, 2]) AS i))) o
  JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) AS n FROM users WHERE user_type = 'customer') c ON c.n = cn
  JOIN (SELECT good_id, row_number() OVER (ORDER BY good_id) AS n FROM goods) g ON g.n = gn"""


def _feed(m: Market):
    return generate.event_feed(m.table("events").select(F.col("event_id").alias("tick")), m.users, m.goods, "2024-01-01")


@query("feed_orders", "S13", check_sql("users goods", "SELECT * FROM f", f=_FEED_ORDERS))
def _(m: Market):
    """Three orders per tick, one tick per row of the events table."""
    return _feed(m)[0].select("order_id", "user_id", "good_id", "price")


_FEED_SAID = f"""
  SELECT review_id, order_id, user_id, good_id, {mix_sql('review_id', 85)} % 5 + 1 AS rating, event_id AS tick, pick FROM (
    SELECT r.review_id, r.event_id, f.*, row_number() OVER (PARTITION BY user_id, good_id ORDER BY review_id) AS pick
    FROM (SELECT review_id, event_id, {mix_sql('review_id', 84)} % ((event_id + 1) * 3) + 1 AS order_id
          FROM (SELECT event_id, event_id * 2 + i + 1 AS review_id FROM events, (SELECT unnest([0, 1]) AS i))) r
    JOIN f USING (order_id))"""
_FEED_KEPT = check_sql(
    "users goods", "SELECT review_id, order_id, user_id, good_id, rating FROM said WHERE pick = 1", f=_FEED_ORDERS, said=_FEED_SAID
)


@query("feed_reviews", "S13 M2", _FEED_KEPT)
def _(m: Market):
    return _feed(m)[1].select("review_id", "order_id", "user_id", "good_id", "rating")


def _endless_feed(m: Market) -> market.EndlessFeed:
    """As many ticks as there are events, in three batches of one checkpoint."""
    ticks = m.table("events").count()
    feed, progress = market.EndlessFeed(m.spark, new_folder(m.spark, "feed")), new_folder(m.spark, "progress")
    for _ in range(3):
        feed.run(m.users, m.goods, progress, "2024-01-01", -(-ticks // 3), ticks).awaitTermination()
    return feed


@query("streamed_feed_reviews", "S13 M2", _FEED_KEPT)
def _(m: Market):
    return _endless_feed(m).reviews.read().drop("review_ts")


@query(
    "streamed_feed_runs",
    "S13 M2",
    check_sql(
        "users goods",
        """SELECT tick // ((n + 2) // 3) AS batch, count(*) // 2 AS ticks, count(*) AS said, count(*) FILTER (pick = 1) AS kept,
                  count(*) FILTER (pick > 1) AS skipped
           FROM said, (SELECT count(*) AS n FROM events) GROUP BY 1""",
        f=_FEED_ORDERS,
        said=_FEED_SAID,
    ),
)
def _(m: Market):
    """What each batch of the endless feed said, kept and skipped as a second review of the same good."""
    return _endless_feed(m).runs.read()


@query(
    "parked_records",
    "SNK5",
    _sql("SELECT CAST(user_id AS VARCHAR) AS key, value, 'analytics-consumers' AS consumer FROM r WHERE error IS NOT NULL"),
)
def _(m: Market):
    """Dead letters of the second consumer, written in batch."""
    path = new_folder(m.spark, "parked")
    write_dead_letters(envelopes.dead_letters(envelopes.split_envelopes(records(m))[1], "analytics-consumers"), path)
    back = m.spark.read.schema(_DEAD_SCHEMA).json(path)
    return back.select("key", "value", F.col("headers")[1]["value"].alias("consumer"))
