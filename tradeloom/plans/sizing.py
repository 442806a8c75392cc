"""Size checks made before a plan is chosen, from the optimizer's statistics.

No job is run: the file sizes are already known to the planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
# Input per task that split plans aim for.
CHUNK_BYTES = 256 * MIB
MAX_CHUNKS = 100_000
# What the planner reports for a leaf it knows nothing about is far above this.
UNKNOWN_BYTES = 2**60


def source_bytes(df: DataFrame) -> int:
    """Bytes of all leaf relations of ``df`` (an upper bound for what it scans)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def chunk_count(df: DataFrame) -> int:
    """Number of range partitions for a split plan over ``df``."""
    usual = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    size = source_bytes(df)
    if size >= UNKNOWN_BYTES:
        return usual * 4
    return max(usual, min(MAX_CHUNKS, size // CHUNK_BYTES))
