"""Stateless steps over topic records: the same functions on batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.envelope import ENVELOPE, event_time, group_key, missing_fields, normalised


def check_envelopes(records: DataFrame) -> DataFrame:
    """Add ``missing`` (required fields not there) and ``error`` (NULL if valid)."""
    missing = missing_fields(F.col("value"))
    checked = records.withColumn("missing", missing)
    error = F.when(F.col("missing").isNull(), F.lit("not a JSON object")).when(
        F.size("missing") > 0, F.concat(F.lit("invalid envelope, missing: "), F.array_join("missing", ", "))
    )
    return checked.withColumn("error", error)


def split_envelopes(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid records; together they are the input.

    The test is one JSON pass per record; only what fails it is looked at again
    for the error text.
    """
    valid = F.coalesce(F.size(missing_fields(F.col("value"))) == 0, F.lit(False))
    return records.where(valid), check_envelopes(records.where(~valid))


def parse(valid: DataFrame) -> DataFrame:
    """Envelope fields as columns; the payload stays JSON text."""
    return valid.select(F.from_json("value", ENVELOPE).alias("e")).select("e.*")


def audit(valid: DataFrame) -> DataFrame:
    """What the audit trail keeps of each event."""
    return parse(valid).select("eventId", "eventType", "entityId")


def dead_letters(invalid: DataFrame, consumer: str) -> DataFrame:
    """Records to park, with the error and the consumer that met it.

    A parse result never changes, so there is nothing to try again: these go to
    the dead letters at once, and task failures are retried by Spark.
    """
    return invalid.select("key", "value", "error", F.lit(consumer).alias("consumer"))


def normalise(records: DataFrame) -> DataFrame:
    return records.withColumn("value", normalised(F.col("value")))


def rekey(records: DataFrame) -> DataFrame:
    """Key by event type; no shuffle here, the window count does the only one."""
    return records.withColumn("key", group_key(F.col("value")))


def timed(records: DataFrame, record_time: bool = True) -> DataFrame:
    """Add ``event_ts``: the record's time; without ``record_time`` the
    envelope's, and the record's only for bodies without one."""
    own = F.col("timestamp") if record_time else F.coalesce(event_time(F.col("value")), F.col("timestamp"))
    return records.withColumn("event_ts", own)


def dedup(records: DataFrame, delay: str = "10 minutes", ts: str = "event_ts", key: str = "eventId") -> DataFrame:
    """Drop repeated deliveries of an event within ``delay``."""
    if records.isStreaming:
        return records.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    return records.dropDuplicates([key])


def route(records: DataFrame, routes: dict[str, list[str]], kind: str = "event_type") -> dict[str, DataFrame]:
    """Split events by type; types without a route go to ``other``."""
    known = [t for types in routes.values() for t in types]
    out = {name: records.where(F.col(kind).isin(types)) for name, types in routes.items()}
    out["other"] = records.where(~F.coalesce(F.col(kind).isin(known), F.lit(False)))
    return out
