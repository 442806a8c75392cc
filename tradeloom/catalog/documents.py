"""Document-style queries on products and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.base import check_sql, half_even_sql, query
from tradeloom.operators import documents, filters, quality, reports
from tradeloom.plans.staging import new_folder
from tradeloom.sources.market import Market
from tradeloom.sources.tables import export_csv, export_documents, read_csv_entities, read_documents
from pyspark.sql import types as T


@query(
    "products_with_attributes",
    "P7",
    check_sql("products", "SELECT good_id, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM products"),
)
def _(m: Market):
    kept = m.products.where(filters.has_attributes("attributes"))
    return kept.select("good_id", F.col("attributes")["brand"].alias("brand"), F.col("attributes")["size"].alias("size"))


@query(
    "products_with_tag",
    "P8 F2",
    check_sql("products", "SELECT good_id, name FROM products WHERE list_contains(tags, 'red')"),
)
def _(m: Market):
    return m.products.where(filters.with_tag("tags", "red")).select("good_id", "name")


@query(
    "first_tag_if_any",
    "P12",
    check_sql("products", "SELECT good_id, CASE WHEN len(tags) > 1 THEN tags[2] END AS second_tag FROM products"),
)
def _(m: Market):
    rest = F.slice("tags", 2, 100)
    return m.products.select("good_id", filters.size_or_null(rest, F.get("tags", F.lit(1))).alias("second_tag"))


@query(
    "top_categories",
    "A6 T1",
    check_sql(
        "products",
        "SELECT category_name AS category, count(*) AS count FROM products GROUP BY 1 ORDER BY count DESC, category LIMIT 10",
    ),
)
def _(m: Market):
    return reports.top_categories(m.products)


@query(
    "top_merchants",
    "A8 T1",
    check_sql(
        "products",
        """SELECT merchant_id, min(merchant_name) AS merchant_name, count(*) AS count FROM products
           GROUP BY 1 ORDER BY count DESC, merchant_id LIMIT 10""",
    ),
)
def _(m: Market):
    return reports.top_merchants(m.products)


@query(
    "top_merchants_in_category",
    "A8",
    check_sql(
        "products",
        """SELECT merchant_id, min(merchant_name) AS merchant_name, count(*) AS count FROM products WHERE category_id = 1
           GROUP BY 1 ORDER BY count DESC, merchant_id LIMIT 5""",
    ),
)
def _(m: Market):
    return reports.top_merchants(m.products, category_id=1, k=5)


_WITH_REVIEWS = f"""
  SELECT p.good_id, p.name, p.category_name, count(r.id) AS review_count,
         {half_even_sql("sum(r.rating)", "count(r.rating)")} AS avg_rating
  FROM products p LEFT JOIN reviews r ON r.good_id = p.good_id GROUP BY 1, 2, 3"""


@query(
    "products_with_reviews",
    "A9 P12",
    check_sql(
        "products reviews",
        _WITH_REVIEWS + " ORDER BY avg_rating DESC NULLS LAST, review_count DESC, p.good_id LIMIT 20",
    ),
)
def _(m: Market):
    return documents.products_with_reviews(m.products, m.reviews)


@query("products_with_reviews_all", "A9", check_sql("products reviews", _WITH_REVIEWS))
def _(m: Market):
    return documents.products_with_reviews(m.products, m.reviews, k=None)


_NESTED = """
  SELECT p.good_id, coalesce((r.pos - 1) // {size}, 0) AS page,
         coalesce(string_agg(r.id || ':' || r.rating, '|' ORDER BY r.id), '') AS reviews
  FROM products p LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY good_id ORDER BY id) AS pos FROM reviews) r
    ON r.good_id = p.good_id
  GROUP BY 1, 2"""


def _nested_text(df):
    items = F.transform("matches", lambda r: F.concat_ws(":", r["id"].cast("string"), r["rating"].cast("string")))
    return df.select("good_id", "page", F.array_join(items, "|").alias("reviews"))


@query("nested_reviews", "J10", check_sql("products reviews", _NESTED.format(size=1000)))
def _(m: Market):
    return _nested_text(documents.lookup_nested(m.products, m.reviews, "good_id", "id", ["id", "rating"]))


@query("nested_reviews_paged", "J10", check_sql("products reviews", _NESTED.format(size=2)))
def _(m: Market):
    """Two reviews per page, with the plan used when one good holds most reviews."""
    nested = documents.lookup_nested(
        m.products, m.reviews, "good_id", "id", ["id", "rating"], page_size=2, split=True
    )
    return _nested_text(nested)


@query(
    "rating_by_category",
    "A10 F14",
    check_sql(
        "reviews products",
        """SELECT p.category_name AS category, r.rating, count(*) AS count
           FROM reviews r LEFT JOIN products p ON p.good_id = r.good_id GROUP BY 1, 2""",
    ),
)
def _(m: Market):
    return reports.rating_by_category(m.reviews, m.products)


@query(
    "tag_counts",
    "A33 F14",
    check_sql("products", "SELECT tag, count(*) AS count FROM (SELECT unnest(tags) AS tag FROM products) GROUP BY 1"),
)
def _(m: Market):
    return reports.tag_counts(m.products)


@query(
    "unwound_tags_keeping_empty",
    "F14",
    check_sql(
        "products",
        """SELECT good_id, t.tag FROM products
           LEFT JOIN (SELECT good_id AS g, unnest(tags) AS tag FROM products WHERE p_size > 10) t ON t.g = good_id""",
    ),
)
def _(m: Market):
    """Small goods lose their tags first, so the empty-array rows are seen."""
    size = F.col("attributes")["size"].cast("int")
    tags = F.when(size > 10, F.col("tags")).otherwise(F.array().cast("array<string>"))
    return documents.unwind(m.products.select("good_id", tags.alias("tags")), "tags", "tag", keep_empty=True)


@query(
    "updated_documents",
    "F19 M3",
    check_sql(
        "products",
        """SELECT good_id, CASE WHEN category_id = 1 THEN 'black' END AS color, p_brand AS brand,
                  CAST(NULL AS VARCHAR) AS size, array_to_string(list_append(tags, 'new'), '|') AS tags,
                  CASE WHEN category_id = 1 THEN 2 ELSE 1 END::BIGINT AS version
           FROM products""",
    ),
)
def _(m: Market):
    first = F.col("category_id") == 1
    changed = m.products.select(
        "good_id",
        documents.unset_nested(
            F.when(first, documents.set_nested("attributes", color="black")).otherwise(F.col("attributes")), "size"
        ).alias("attributes"),
        documents.push("tags", "new").alias("tags"),
        documents.increment(F.when(first, F.lit(1).cast("bigint"))).alias("version"),
    )
    return changed.select(
        "good_id",
        F.try_element_at("attributes", F.lit("color")).alias("color"),
        F.try_element_at("attributes", F.lit("brand")).alias("brand"),
        F.try_element_at("attributes", F.lit("size")).alias("size"),
        F.array_join("tags", "|").alias("tags"),
        "version",
    )


@query(
    "json_documents",
    "SNK2 F17",
    check_sql(
        "products",
        """SELECT good_id, '{"good_id":' || good_id || ',"name":"' || name || '","merchant_id":' || merchant_id ||
                  ',"category_id":' || category_id || ',"merchant_name":"' || merchant_name || '","category_name":"' ||
                  category_name || '","attributes":{},"tags":[],"created_at":"2001-08-01T00:00:00Z","updated_at":"2001-08-01T00:00:00Z"}'
                  AS document
           FROM products""",
    ),
)
def _(m: Market):
    plain = documents.build_products(m.goods, m.users, m.categories)
    return documents.to_json_documents(plain, "2001-08-01T00:00:00Z")


@query(
    "documents_read_back",
    "SRC3 SNK2",
    check_sql("products", "SELECT good_id, name, p_brand AS brand, array_to_string(tags, '|') AS tags FROM products"),
)
def _(m: Market):
    path = new_folder(m.spark, "documents")
    export_documents(m.products, path)
    schema = "good_id bigint, name string, attributes map<string,string>, tags array<string>"
    back = read_documents(m.spark, path, schema, array=False)
    return back.select("good_id", "name", F.col("attributes")["brand"].alias("brand"), F.array_join("tags", "|").alias("tags"))


@query(
    "csv_read_back",
    "SRC2 SNK1 F6",
    check_sql(
        "goods",
        """SELECT good_id, name, CASE WHEN caty_id % 2 = 0 THEN caty_id END AS caty_id FROM goods""",
    ),
)
def _(m: Market):
    """Goods through CSV; odd categories are written as text that is no number."""
    path = new_folder(m.spark, "csv")
    odd = F.when(F.pmod("caty_id", F.lit(2)) == 0, F.col("caty_id").cast("string")).otherwise("n/a")
    export_csv(m.goods.select("good_id", "name", odd.alias("caty_id")), path)
    schema = T.StructType(
        [T.StructField("good_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("caty_id", T.LongType())]
    )
    return read_csv_entities(m.spark, path, schema)


@query(
    "broken_documents",
    "C3",
    check_sql(
        "products",
        """SELECT good_id, concat_ws('|', CASE WHEN n IS NULL THEN 'name.required' END, CASE WHEN n = '' THEN 'name.minLength' END,
                  CASE WHEN length(n) > 500 THEN 'name.maxLength' END, CASE WHEN mid IS NULL THEN 'merchant_id.required' END,
                  CASE WHEN mid < 1 THEN 'merchant_id.minimum' END, CASE WHEN category_id < 1 THEN 'category_id.minimum' END,
                  CASE WHEN good_id < 1 THEN 'good_id.minimum' END) AS broken
           FROM (SELECT good_id, category_id,
                   CASE WHEN p_size < 5 THEN '' WHEN p_size < 10 THEN repeat(name, 50) WHEN p_size < 15 THEN NULL ELSE name END AS n,
                   CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 5 = 0 THEN -1 ELSE merchant_id END AS mid FROM products)""",
    ),
)
def _(m: Market):
    """Products spoiled by size: empty, over-long or missing names and merchants."""
    size = F.col("attributes")["size"].cast("int")
    name = F.when(size < 5, "").when(size < 10, F.repeat("name", 50)).when(size >= 15, F.col("name"))
    merchant = F.when(F.pmod(size, F.lit(7)) == 0, None).when(F.pmod(size, F.lit(5)) == 0, -1).otherwise(F.col("merchant_id"))
    spoiled = m.products.select("good_id", name.alias("name"), merchant.alias("merchant_id"), "category_id")
    checked = quality.broken_rules(spoiled, quality.PRODUCT_RULES)
    return checked.select("good_id", F.array_join("broken", "|").alias("broken"))


@query(
    "broken_json_documents",
    "C3",
    check_sql(
        "products",
        """SELECT good_id, CASE WHEN s % 10 = 9 THEN 'document.type' ELSE concat_ws('|',
                  CASE s % 10 WHEN 0 THEN 'name.type' WHEN 1 THEN 'name.type' WHEN 2 THEN 'name.minLength' WHEN 3 THEN 'name.required'
                              WHEN 4 THEN 'name.maxLength' END,
                  CASE s % 7 WHEN 0 THEN 'merchant_id.type' WHEN 1 THEN 'merchant_id.type' WHEN 2 THEN 'merchant_id.minimum'
                             WHEN 3 THEN 'merchant_id.required' WHEN 4 THEN 'merchant_id.type' END,
                  CASE s % 3 WHEN 0 THEN 'category_id.type' END,
                  CASE WHEN s % 4 = 0 THEN 'good_id.type' WHEN s % 4 = 1 OR good_id < 1 THEN 'good_id.minimum' END) END AS broken
           FROM (SELECT good_id, CAST(p_size AS INTEGER) AS s FROM products)""",
    ),
)
def _(m: Market):
    """Products as JSON whose fields come with other types, too short, too long, null or not at all, by size."""
    s = F.col("attributes")["size"].cast("int")

    def field(key: str, divisor: int, *odd: str | None, usual: Column) -> Column:
        """``"key":value`` by the size's remainder; None leaves the field out."""
        value = F.lit(None).cast("string")
        for k, text in enumerate(odd):
            value = F.when(F.pmod(s, F.lit(divisor)) == k, F.lit(text).cast("string")).otherwise(value)
        value = F.when(F.pmod(s, F.lit(divisor)) >= len(odd), usual).otherwise(value)
        return F.concat(F.lit(f'"{key}":'), value)

    quoted = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    fields = [
        field("name", 10, "5", "null", '""', None, f'"{"long" * 126}"', usual=quoted("name")),
        field("merchant_id", 7, '"7"', "1.5", "0", None, "[7]", usual=F.col("merchant_id").cast("string")),
        field("category_id", 3, '{"id":3}', usual=F.concat(F.col("category_id").cast("string"), F.lit(".0"))),
        field("good_id", 4, "true", "-3", usual=F.col("good_id").cast("string")),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    broken = F.when(F.pmod(s, F.lit(20)) == 9, "[1]").when(F.pmod(s, F.lit(20)) == 19, '{"name":').otherwise(body)
    checked = quality.broken_json_rules(m.products.select("good_id", broken.alias("body")), "body", quality.PRODUCT_RULES)
    return checked.select("good_id", F.array_join("broken", "|").alias("broken"))


@query(
    "broken_reviews",
    "C3",
    check_sql(
        "lines",
        """SELECT id, concat_ws('|', CASE WHEN r < 1 THEN 'rating.minimum' END, CASE WHEN r > 5 THEN 'rating.maximum' END) AS broken
           FROM (SELECT id, rating - 1 + CAST(l_linenumber >= 6 AS BIGINT) * 2 AS r FROM lines)""",
    ),
)
def _(m: Market):
    """Every purchase line as a review whose rating may fall outside 1..5."""
    lines = m._purchase_lines
    rating = F.floor((F.col("l_quantity") - 1) / 10) + F.when(F.col("l_linenumber") >= 6, 2).otherwise(0)
    spoiled = lines.select(
        "id", F.col("l_partkey").alias("product_id"), F.lit(1).alias("user_id"), rating.alias("rating"), F.lit("").alias("comment")
    )
    rules = [r for r in quality.REVIEW_RULES if r.field != "product_id"]
    return quality.broken_rules(spoiled, rules).select("id", F.array_join("broken", "|").alias("broken"))
