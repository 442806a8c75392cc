"""Windowed counts, and the exact rule for late events."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tradeloom.plans.ordered import running_max

COUNT_SCHEMA = "event_type string, window_start bigint, window_end bigint, event_count bigint"
COUNT_KEYS = ["event_type", "window_start"]


def windowed_count(
    df: DataFrame, kind: str = "key", ts: str = "event_ts", size: str = "1 minute", grace: str = "30 seconds"
) -> DataFrame:
    """Events per type and tumbling window, window bounds in epoch milliseconds.

    Map-side partial counts make one row per type and window before the only
    shuffle, so a type with most events is not a hot spot.
    """
    source = df.withWatermark(ts, grace) if df.isStreaming else df
    counts = source.groupBy(F.col(kind).alias("event_type"), F.window(ts, size).alias("w")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return counts.select(
        "event_type",
        F.unix_millis("w.start").alias("window_start"),
        F.unix_millis("w.end").alias("window_end"),
        "event_count",
    )


def mark_late(
    records: DataFrame,
    ts_ms: str,
    partition: str = "partition",
    offset: str = "offset",
    size_ms: int = 60_000,
    grace_ms: int = 30_000,
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Batch replay of a topic: which records come after their window closed.

    Stream time is the largest time seen so far in the partition; a record is
    late when its window's end plus the grace is not above it.
    """
    timed = running_max(records, partition, offset, ts_ms, "stream_time", chunk_rows)
    window_end = F.col(ts_ms) - F.pmod(F.col(ts_ms), F.lit(size_ms)) + size_ms
    return timed.withColumn("late", window_end <= F.col("stream_time") - grace_ms)


def mark_late_stream(
    records: DataFrame,
    ts_ms: str,
    partition: str = "partition",
    offset: str = "offset",
    size_ms: int = 60_000,
    grace_ms: int = 30_000,
) -> DataFrame:
    """``mark_late`` on a stream: the state of a topic partition is its largest time so far.

    A batch may bring its records in any order; they are taken by offset, and
    batches follow each other in offset order, as a topic's do.  A record
    without a time neither moves the stream time nor is it late.  One task
    sorts a partition's share of a batch, so the source's limit on a batch
    (``files_per_batch``, ``maxOffsetsPerTrigger``) bounds its memory.
    """
    out = T.StructType([*records.schema.fields, T.StructField("stream_time", T.LongType()), T.StructField("late", T.BooleanType())])
    none = np.iinfo(np.int64).min

    def run(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(offset, kind="stable")
        timed = rows[ts_ms].notna().to_numpy()
        own = rows[ts_ms].where(timed, 0).to_numpy().astype(np.int64)
        top = state.get[0] if state.exists else none
        seen = np.maximum(np.maximum.accumulate(np.where(timed, own, none)), top)
        state.update((int(seen[-1]),))
        end = own - own % size_ms + size_ms
        late = pd.Series(timed & (seen > none) & (end <= np.where(seen > none, seen, 0) - grace_ms), index=rows.index)
        yield rows.assign(stream_time=pd.array(seen, dtype="Int64").astype(object), late=late.astype(object)).assign(
            stream_time=lambda r: r["stream_time"].where(seen > none, None), late=lambda r: r["late"].where(timed, None)
        )

    return records.groupBy(partition).applyInPandasWithState(run, out, "top bigint", "append", GroupStateTimeout.NoTimeout)
