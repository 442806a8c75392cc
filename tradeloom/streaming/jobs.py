"""Streaming queries.  Sinks are idempotent, so a replayed batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.rollups import COUNTERS, ROLLUP_KEYS, fold
from tradeloom.plans.snapshots import SnapshotTable
from tradeloom.sources.tables import read_outbox_increment, write_dead_letters
from tradeloom.streaming.envelopes import dead_letters, rekey, split_envelopes, timed
from tradeloom.streaming.windows import COUNT_KEYS, COUNT_SCHEMA, mark_late_stream, windowed_count

ROLLUP_SCHEMAS = {
    "category": "date date, category_id bigint, orders_count bigint, reviewed_count bigint, rating_sum bigint, review_count bigint",
    "merchant": "date date, merchant_id bigint, orders_count bigint, reviewed_count bigint, rating_sum bigint, review_count bigint",
    "product": "good_id bigint, category_id bigint, merchant_id bigint, orders_count bigint, reviewed_count bigint, rating_sum bigint, review_count bigint",
}


def start(
    df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Run ``each`` on every batch; without ``every`` take what is there and stop."""
    writer = df.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def held(each: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Keep a batch for the several actions of its sink, then let it go."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            each(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def count_table(spark: SparkSession, path: str) -> SnapshotTable:
    """Table of window counts, in partitions of one day."""
    day = F.date_format(F.timestamp_millis("window_start"), "yyyy-MM-dd")
    return SnapshotTable(spark, path, COUNT_SCHEMA + ", ingested_at timestamp", COUNT_KEYS, day)


def count_events(
    records: DataFrame, path: str, checkpoint: str, every: str | None = None, record_time: bool = True, **window: str
) -> StreamingQuery:
    """Topic -> one-minute counts per type -> keyed table, newest count wins."""
    table = count_table(records.sparkSession, path)

    def each(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.withColumn("ingested_at", F.current_timestamp()), batch_id)

    counts = windowed_count(timed(rekey(records), record_time), **window)
    return start(counts, held(each), checkpoint, "update", every)


def audit_events(
    records: DataFrame, path: str, dead_path: str, checkpoint: str, consumer: str = "audit-consumers", every: str | None = None
) -> StreamingQuery:
    """Valid events to the audit trail, the others to the dead letters.

    Both are folders named by batch and overwritten on replay, so a batch that
    failed between the two writes leaves nothing twice.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        valid, invalid = split_envelopes(batch)
        kept = valid.select(
            *[F.get_json_object("value", f"$.{f}").alias(f) for f in ("eventId", "eventType", "entityId")]
        )
        kept.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        bad = dead_letters(invalid, consumer)
        write_dead_letters(bad, f"{dead_path}/batch={batch_id}", mode="overwrite")

    return start(records, held(each), checkpoint, "append", every)


def mark_late_events(records: DataFrame, ts_ms: str, path: str, checkpoint: str, every: str | None = None, **rule: int) -> StreamingQuery:
    """Every record with its stream time and whether it came too late, to a folder that a replayed batch does not change."""
    marked = mark_late_stream(records, ts_ms, **rule)
    writer = marked.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start(path)


def type_table(spark: SparkSession, path: str) -> SnapshotTable:
    """Table of running counts per event type, in hash buckets: the types are free text."""
    bucket = F.pmod(F.xxhash64("event_type"), F.lit(16))
    return SnapshotTable(spark, path, "event_type string, n bigint", ["event_type"], bucket)


def count_types(records: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Running counter per event type of the valid events -> keyed table, newest count wins."""
    table = type_table(records.sparkSession, path)
    counts = rekey(split_envelopes(records)[0]).groupBy(F.col("key").alias("event_type")).agg(F.count(F.lit(1)).alias("n"))
    return start(counts, held(lambda batch, batch_id: table.upsert(batch, batch_id)), checkpoint, "update", every)


def rollup_tables(spark: SparkSession, path: str) -> dict[str, SnapshotTable]:
    """The three rollups: daily ones in months, the product one in hash buckets."""
    month = F.date_format("date", "yyyy-MM")
    bucket = F.pmod(F.xxhash64("good_id"), F.lit(16))
    parts = {"category": month, "merchant": month, "product": bucket}
    return {
        kind: SnapshotTable(spark, f"{path}/{kind}", ROLLUP_SCHEMAS[kind], keys, parts[kind])
        for kind, keys in ROLLUP_KEYS.items()
    }


def maintain_rollups(
    deltas: DataFrame, path: str, checkpoint: str, every: str | None = None, kinds: tuple[str, ...] = tuple(ROLLUP_KEYS)
) -> StreamingQuery:
    """Add each batch of order and review deltas to the rollups.

    A batch is folded per rollup key before it meets the table; only the months
    and buckets it touches are rewritten; a batch already in a table is skipped.
    """
    tables = rollup_tables(deltas.sparkSession, path)

    def each(batch: DataFrame, batch_id: int) -> None:
        for kind in kinds:
            tables[kind].add(fold(batch, ROLLUP_KEYS[kind]), COUNTERS, batch_id)

    return start(deltas, held(each), checkpoint, "append", every)


def poll_outbox(outbox: DataFrame, table: SnapshotTable, sink: Callable[[DataFrame, int], None], batch_id: int) -> int:
    """One poll of the outbox: rows after the stored id go to ``sink``.

    The new high-water mark is stored after the sink has written, so a crash in
    between delivers again and never skips.  Returns the mark.
    """
    marks = table.read().agg(F.max("last_id").alias("m")).first()["m"]
    last = -1 if marks is None else marks
    fresh = read_outbox_increment(outbox, last)
    newest = fresh.agg(F.max("id").alias("m")).first()["m"]
    if newest is None:
        return last
    # Bounded above, so rows arriving during the poll wait for the next one.
    sink(fresh.where(F.col("id") <= newest), batch_id)
    mark = outbox.sparkSession.createDataFrame([("outbox", newest)], "name string, last_id bigint")
    if not table.upsert(mark, batch_id):
        raise ValueError(f"batch {batch_id} was used before; its rows were delivered again and the mark stays at {last}")
    return newest


def outbox_marks(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, "name string, last_id bigint", ["name"], F.lit("all"))
