"""Seeded, engine-portable pseudo-randomness.

``rand()`` depends on the partitioning and on retries.  These are hashes of the
key: same key and seed, same value, on any number of partitions, after
any task is run again -- and any SQL engine can recompute them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.dialect import col

# Hex digits of the hash that make a draw: 60 bits.
_DIGITS = 15


def mix(key: Column | str, seed: int = 0) -> Column:
    """Value in ``[0, 2^60)`` scattered over keys of any type that has a text form."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string"))), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def pick(key: Column | str, n: Column | int, seed: int = 0) -> Column:
    """Whole number in ``[0, n)``."""
    return F.pmod(mix(key, seed), n if isinstance(n, Column) else F.lit(n))


def chance(key: Column | str, share: float, seed: int = 0) -> Column:
    """True for about ``share`` of the keys (resolution 1/10000)."""
    return pick(key, 10000, seed) < F.lit(round(share * 10000))


def pick_from(values: list[str], key: Column | str, seed: int = 0) -> Column:
    """One of ``values``, chosen by the key."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (pick(key, len(values), seed) + 1).cast("int"))


def bucket_of(key: Column | str, n: int) -> Column:
    """Bucket number in ``[0, n)`` for a key of any type."""
    return F.pmod(F.xxhash64(col(key)), F.lit(n))


def mix_sql(key: str, seed: int = 0) -> str:
    """The same value as SQL text, for checks in another engine."""
    return f"('0x' || substr(md5('{seed}:' || CAST(({key}) AS VARCHAR)), 1, {_DIGITS}))::BIGINT"
