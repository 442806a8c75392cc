"""Reading and writing tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.functions.dialect import to_integer


def read_table(
    spark: SparkSession,
    uri: str,
    name: str,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int | None = None,
    **options: str,
) -> DataFrame:
    """One relational table: a Parquet folder, or over JDBC for ``jdbc:`` uris.

    Give a numeric ``column`` with its ``bounds`` to read over JDBC in parallel
    ranges; without them one task reads the whole table.
    """
    if not uri.startswith("jdbc:"):
        return spark.read.parquet(f"{uri.rstrip('/')}/{name}.parquet")
    reader = spark.read.format("jdbc").options(url=uri, dbtable=name, **options)
    if column and bounds:
        reader = reader.options(
            partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts or 32
        )
    return reader.load()


def read_csv_entities(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header; whole numbers that do not parse become NULL.

    Columns are read as text and cast, so a bad value costs the value and not
    the row.  Line breaks inside quotes need ``multi_line``, which gives up
    splitting large files.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    raw = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).csv(path)
    whole = (T.LongType, T.IntegerType)
    return raw.select(
        *[
            (to_integer(f.name).cast(f.dataType) if isinstance(f.dataType, whole) else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str, array: bool = True) -> DataFrame:
    """JSON documents: one array per file, or one document per line.

    An array file is parsed whole by one task; write lines for large sets.
    """
    return spark.read.option("multiLine", array).schema(schema).json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled."""
    df.write.options(header=True, escape='"').csv(path)


def export_documents(df: DataFrame, path: str) -> None:
    """One JSON document per line; NULL fields are written out."""
    df.write.option("ignoreNullFields", False).json(path)


def write_fact(df: DataFrame, path: str, ts: str, keys: list[str]) -> None:
    """Append events, one folder per month, sorted by time and ``keys``.

    Range partitioning spreads a heavy month over many tasks and leaves narrow
    value ranges in each file, which is what row-group skipping needs.
    """
    month = df.withColumn("month", F.date_format(ts, "yyyyMM"))
    day = F.to_date(ts)
    ranged = month.repartitionByRange("month", day, *keys, F.col(ts))
    ranged.sortWithinPartitions("month", day, *keys, ts).write.mode("append").partitionBy("month").parquet(path)


def write_dead_letters(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write dead letters: raw key and value, and headers naming the error and
    the consumer."""
    df.select(
        "key",
        "value",
        F.array(
            F.struct(F.lit("error").alias("key"), F.col("error").cast("string").alias("value")),
            F.struct(F.lit("consumer").alias("key"), F.col("consumer").cast("string").alias("value")),
        ).alias("headers"),
    ).write.mode(mode).json(path)


def read_outbox_increment(outbox: DataFrame, last_id: int) -> DataFrame:
    """Rows after the last id seen; the filter reaches the scan."""
    return outbox.where(F.col("id") > last_id)


def trim_outbox(outbox: DataFrame, keep: int = 100) -> DataFrame:
    """Drop rows with an id below the largest minus ``keep``."""
    last = outbox.select(F.max("id")).scalar()
    return outbox.where(F.col("id") >= last - keep)
