"""Whole rows beside the columns an operator works with.

Operators that return the rows they were given pack them into one column first,
so a table may have any other columns, also of names that the operator uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def packed(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, copy)``: the row, its id and the hash of its text (null as empty)."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id"), text_hash().alias("copy"))


def kept(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Packed rows whose ``(doc_id, copy)`` is in ``keys``, or is not with ``left_anti``."""
    named = keys.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).distinct()
    return rows.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")), how)


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")
