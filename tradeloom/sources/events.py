"""Event topics: as a Kafka topic where its connector is installed, and as a
folder of JSON lines with the same columns everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "key string, value string, timestamp timestamp, partition int, offset bigint"


def read_events(
    spark: SparkSession, source: str, stream: bool = True, files_per_batch: int | None = None, **options: str
) -> DataFrame:
    """Records of a topic from its beginning.

    ``source`` is ``kafka:<topic>`` (give ``kafka.bootstrap.servers`` among the
    options) or a folder.
    """
    reader = spark.readStream if stream else spark.read
    if source.startswith("kafka:"):
        raw = reader.format("kafka").options(subscribe=source[6:], startingOffsets="earliest", **options).load()
        return raw.select(
            F.col("key").cast("string"), F.col("value").cast("string"), "timestamp", "partition", "offset"
        )
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(RECORD).json(source)


def to_records(envelopes: DataFrame, at: str = "timestamp", partitions: int = 8) -> DataFrame:
    """Envelope columns as topic records keyed by entity."""
    return envelopes.select(
        F.col("entityId").alias("key"),
        F.to_json(F.struct(*envelopes.columns)).alias("value"),
        F.to_timestamp(at).alias("timestamp"),
        F.pmod(F.xxhash64("entityId"), F.lit(partitions)).cast("int").alias("partition"),
    )
