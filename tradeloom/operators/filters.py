"""Lookups, listings and predicates; all of them reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.dialect import col

MAX_PAGE = 100
DEFAULT_PAGE = 20


def lookup(df: DataFrame, **equal) -> DataFrame:
    """Rows whose columns equal the given values."""
    for name, value in equal.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def list_products(products: DataFrame, category_id: int | None = None, limit: int | None = None) -> DataFrame:
    """One page of products: 20 unless asked otherwise, never more than 100."""
    if category_id is not None:
        products = lookup(products, category_id=category_id)
    shown = products.select("good_id", "name", "category_name", "merchant_name", "category_id", "merchant_id")
    return shown.orderBy("good_id").limit(min(limit or DEFAULT_PAGE, MAX_PAGE))


def project(df: DataFrame, keep: list[str] | None = None, drop: list[str] | None = None, **computed: Column) -> DataFrame:
    """Keep or leave out fields, then add computed ones."""
    if keep is not None:
        df = df.select(*keep, *[c.alias(n) for n, c in computed.items()])
    elif computed:
        df = df.withColumns(computed)
    return df.drop(*(drop or []))


def in_last_days(ts: Column | str, days: int, as_of: str) -> Column:
    """``ts`` not older than ``days`` before ``as_of`` (a date, never the clock)."""
    return col(ts) >= F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))


def with_tag(tags: Column | str, tag: str) -> Column:
    return F.array_contains(col(tags), tag)


def has_attributes(attributes: Column | str) -> Column:
    """Field present and not an empty object."""
    return col(attributes).isNotNull() & (F.cardinality(col(attributes)) > 0)


def not_blank(text: Column | str) -> Column:
    return col(text).isNotNull() & (F.trim(col(text)) != "")


def size_or_null(items: Column | str, value: Column) -> Column:
    """``value`` for a non-empty array, else NULL."""
    return F.when(F.cardinality(col(items)) > 0, value)


def page(df: DataFrame, order: list[Column | str], skip: int, size: int) -> DataFrame:
    """Skip-and-limit page; fine near the front, see ``page_after`` for deep ones."""
    return df.orderBy(*order).offset(skip).limit(size)


def page_after(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """Next page by key: the filter is pushed down, so depth costs nothing."""
    return (df if last is None else df.where(F.col(key) > F.lit(last))).orderBy(key).limit(size)
