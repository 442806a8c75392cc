"""Product documents: nesting, unwinding and field updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.dialect import col, nulls_last, ratio_half_even, top_k
from tradeloom.operators.reports import review_totals
from tradeloom.plans.ordered import row_index


def build_products(
    goods: DataFrame, users: DataFrame, categories: DataFrame, extra: DataFrame | None = None
) -> DataFrame:
    """Product documents with the names of merchant and category copied in.

    ``extra`` may bring ``attributes`` and ``tags`` per good; without it they
    are the empty object and the empty list.
    """
    products = (
        goods.join(users.select(F.col("user_id").alias("merch_id"), F.col("name").alias("merchant_name")), "merch_id")
        .join(categories.select("caty_id", F.col("name").alias("category_name")), "caty_id")
        .select(
            "good_id",
            "name",
            F.col("merch_id").alias("merchant_id"),
            F.col("caty_id").alias("category_id"),
            "merchant_name",
            "category_name",
        )
    )
    empty_map = F.create_map().cast("map<string,string>")
    empty_list = F.array().cast("array<string>")
    if extra is None:
        return products.withColumn("attributes", empty_map).withColumn("tags", empty_list)
    return (
        products.join(extra, "good_id", "left")
        .withColumn("attributes", F.coalesce("attributes", empty_map))
        .withColumn("tags", F.coalesce("tags", empty_list))
    )


def lookup_nested(
    left: DataFrame,
    right: DataFrame,
    key: str,
    order: str,
    fields: list[str],
    name: str = "matches",
    page_size: int = 1000,
    split: bool = True,
) -> DataFrame:
    """``left`` with its matches from ``right`` nested as an array.

    Rows are told apart by key and page: a document with more than
    ``page_size`` matches continues on further rows (``page`` 0, 1, ...), so no
    array grows with the data; one without matches has page 0 and an empty
    array.  Every match is on exactly one page.
    """
    placed = row_index(right.select(key, order, *[f for f in fields if f != order]), [key], [order], "_pos", split=split)
    pages = (
        placed.groupBy(key, F.floor((F.col("_pos") - 1) / page_size).alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_by"), *fields))).alias("_list"))
        .select(key, "page", F.transform("_list", lambda m: F.struct(*[m[f].alias(f) for f in fields])).alias(name))
    )
    joined = left.join(pages, key, "left")
    empty = F.array().cast(pages.schema[name].dataType)
    return joined.withColumn("page", F.coalesce("page", F.lit(0))).withColumn(name, F.coalesce(name, empty))


def products_with_reviews(products: DataFrame, reviews: DataFrame, k: int | None = 20) -> DataFrame:
    """Products with review count and average rating, unrated ones last.

    Only the size and the average of the nested array are asked for, so the
    array is never built: a fold per good gives both.
    """
    report = products.join(review_totals(reviews, "good_id"), "good_id", "left").select(
        "good_id",
        "name",
        "category_name",
        F.coalesce("n_reviews", F.lit(0)).alias("review_count"),
        ratio_half_even("rating_sum", "n_ratings").alias("avg_rating"),
    )
    return top_k(report, [nulls_last("avg_rating"), nulls_last("review_count"), F.col("good_id")], k)


def unwind(df: DataFrame, field: str, as_name: str | None = None, keep_empty: bool = False) -> DataFrame:
    """One row per array element; ``keep_empty`` keeps NULL and empty arrays."""
    explode = F.explode_outer if keep_empty else F.explode
    return df.select(*[c for c in df.columns if c != field], explode(field).alias(as_name or field))


def set_nested(attributes: Column | str, **values) -> Column:
    """Set keys of a nested object, replacing what is there."""
    fresh = F.create_map(*[F.lit(x).cast("string") for pair in values.items() for x in pair])
    kept = F.map_filter(F.coalesce(col(attributes), F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(*values))
    return F.map_concat(kept, fresh)


def unset_nested(attributes: Column | str, *names: str) -> Column:
    return F.map_filter(col(attributes), lambda k, _: ~k.isin(*names))


def push(items: Column | str, value) -> Column:
    """Append to an array field; a missing field becomes a one-element array."""
    return F.coalesce(F.array_append(col(items), F.lit(value)), F.array(F.lit(value)))


def increment(field: Column | str, by: int = 1) -> Column:
    """Add to a counter field; a missing one starts at 0."""
    return F.coalesce(col(field), F.lit(0)) + F.lit(by)


def to_json_documents(products: DataFrame, as_of: str) -> DataFrame:
    """One JSON text per product, created and updated stamped with ``as_of``."""
    stamped = products.withColumn("created_at", F.lit(as_of)).withColumn("updated_at", F.lit(as_of))
    return stamped.select("good_id", F.to_json(F.struct(*stamped.columns)).alias("document"))
