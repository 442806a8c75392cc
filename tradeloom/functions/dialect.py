"""Null order, rounding and division rules, always written out explicitly.

The reports come from stores with different habits: some put NULL first on a
descending sort, some last; some round halves away from zero, some to the even
neighbour.  Every report names the rule it follows by calling one of these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_div(a: Column, b: Column) -> Column:
    """Integer division (``div``)."""
    return F.call_function("div", a, b)


def _nonzero(count: Column | str) -> Column:
    return F.nullif(col(count).cast("bigint"), F.lit(0))


def nulls_first(c: Column | str) -> Column:
    """Descending, NULL first (relational and graph reports)."""
    return col(c).desc_nulls_first()


def nulls_last(c: Column | str) -> Column:
    """Descending, NULL last (document and columnar reports)."""
    return col(c).desc_nulls_last()


def ratio_half_up(total: Column | str, count: Column | str, scale: int = 2) -> Column:
    """``total / count`` rounded half away from zero; NULL when count is 0.

    Works on whole numbers (``total >= 0``), so no binary fraction is ever
    rounded: the tie 2.345 is a real tie and not 2.34499999.
    """
    s, n, unit = col(total).cast("bigint"), _nonzero(count), 10**scale
    return whole_div(s * F.lit(2 * unit) + n, n * 2) / F.lit(unit)


def ratio_half_even(total: Column | str, count: Column | str, scale: int = 2) -> Column:
    """``total / count`` rounded half to even; NULL when count is 0."""
    s, n, unit = col(total).cast("bigint"), _nonzero(count), 10**scale
    whole, rest = whole_div(s * F.lit(unit), n), F.pmod(s * F.lit(unit), n)
    up = (rest * 2 > n) | ((rest * 2 == n) & (F.pmod(whole, F.lit(2)) == 1))
    return (whole + F.when(up, 1).otherwise(0)) / F.lit(unit)


def ratio(total: Column | str, count: Column | str) -> Column:
    """Plain double quotient; NULL instead of an error or NaN for count 0."""
    return F.try_divide(col(total).cast("double"), col(count).cast("double"))


def percent_half_up(part: Column | str, whole: Column | str) -> Column:
    """Share in percent with two decimals; NULL for an empty whole."""
    return ratio_half_up(col(part) * 100, whole)


def to_integer(c: Column | str) -> Column:
    """String to whole number; anything unparsable becomes NULL."""
    return F.floor(col(c).try_cast("double")).cast("bigint")


def round_to_int(c: Column | str) -> Column:
    """Numeric to integer with rounding, as a cast does in a relational store."""
    return F.round(col(c)).cast("bigint")


def top_k(df: DataFrame, order: list[Column], k: int | None) -> DataFrame:
    """First ``k`` rows of ``order``; the caller's order ends in a unique key.

    ``k=None`` keeps the whole report, unsorted: sorting a result nobody cuts
    only buys a shuffle.
    """
    return df if k is None else df.orderBy(*order).limit(k)
