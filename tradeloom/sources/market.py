"""The marketplace tables, and how the test tables map onto them.

Operators take plain DataFrames with these columns and know nothing of where
they come from:

=================  ===========================================================
users              user_id, name, user_type ('customer' | 'merchant')
categories         caty_id, name
goods              good_id, name, caty_id, merch_id
orders             id, user_id, good_id, order_ts, price (one good per order)
reviews            id, user_id, good_id, rating, comment, review_ts
purchase_history   id, user_id, order_id
addresses          addr_id, name
warehouses         id, addr_id
pickup_points      id, addr_id
=================  ===========================================================
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that opening a table needs no job to read footers.
TEST_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Merchants share the user id space with customers; far above any customer key.
MERCHANT_BASE = 10**12

# 15 digits of order and line, 12 of part, 11 of supplier.
ORDER_ID = "decimal(38,0)"


@dataclass
class Market:
    """The marketplace tables of one folder of test tables, built on demand."""

    spark: SparkSession
    folder: str
    _read: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            reader = self.spark.read
            if name in TEST_SCHEMAS:
                reader = reader.schema(TEST_SCHEMAS[name])
            self._read[name] = reader.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")
        return self._read[name]

    @cached_property
    def users(self) -> DataFrame:
        customers = self.table("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.lit("customer").alias("user_type")
        )
        merchants = self.table("supplier").select(
            (F.col("s_suppkey") + F.lit(MERCHANT_BASE)).alias("user_id"),
            F.col("s_name").alias("name"),
            F.lit("merchant").alias("user_type"),
        )
        return customers.unionByName(merchants)

    @cached_property
    def categories(self) -> DataFrame:
        brand = self.table("part").select("p_brand").distinct()
        return brand.select(F.substring("p_brand", 7, 10).cast("bigint").alias("caty_id"), F.col("p_brand").alias("name"))

    @cached_property
    def goods(self) -> DataFrame:
        """Goods spread unevenly over the merchants by a square root."""
        merchants = self.table("supplier").select(F.count(F.lit(1))).scalar()
        return self.table("part").select(
            F.col("p_partkey").alias("good_id"),
            F.col("p_name").alias("name"),
            F.substring("p_brand", 7, 10).cast("bigint").alias("caty_id"),
            (F.floor(F.sqrt("p_partkey")) % merchants + F.lit(MERCHANT_BASE)).alias("merch_id"),
        )

    @cached_property
    def _purchase_lines(self) -> DataFrame:
        lines = self.table("lineitem")
        heads = self.table("orders").where(F.col("o_orderstatus") == "F")
        return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("id", self._order_id())

    def _order_id(self) -> Column:
        """One number per line: order, line, part and supplier keys side by side.

        (order, line) alone repeats in the test tables, and the four keys need
        more than 64 bits on large ones, so the id is a decimal at any size.
        """

        def shifted(value: Column, digits: int) -> Column:
            return (value.cast(ORDER_ID) * F.lit("1" + "0" * digits).cast(ORDER_ID)).cast(ORDER_ID)

        head = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return (shifted(head, 23) + shifted(F.col("l_partkey"), 11) + F.col("l_suppkey").cast(ORDER_ID)).cast(ORDER_ID)

    @cached_property
    def orders(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)") * (
            F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)")
        )
        return self._purchase_lines.select(
            "id",
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("good_id"),
            F.col("o_orderdate").alias("order_ts"),
            price.cast("decimal(18,4)").alias("price"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Returned early lines, one review per (user, good): the first by id.

        ``min_by`` keeps this a map-side combined hash aggregate: no sort, no
        window, and a hot pair is folded before the shuffle.
        """
        lines = self._purchase_lines.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2))
        rating = (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("bigint")
        first = lines.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("good_id")).agg(
            F.min("id").alias("id"),
            F.min_by(rating, "id").alias("rating"),
            F.min_by("l_shipdate", "id").alias("review_ts"),
        )
        return first.select(
            "id",
            "user_id",
            "good_id",
            "rating",
            F.concat(F.lit("rated "), F.col("rating").cast("string")).alias("comment"),
            "review_ts",
        )

    @cached_property
    def purchase_history(self) -> DataFrame:
        return self.orders.select("id", "user_id", F.col("id").alias("order_id"))

    @cached_property
    def addresses(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").cast("bigint").alias("addr_id"), F.col("n_name").alias("name"))

    @cached_property
    def warehouses(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("bigint").alias("addr_id"))

    @cached_property
    def pickup_points(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("addr_id"))

    @cached_property
    def products(self) -> DataFrame:
        """Product documents: names of merchant and category copied in, tags and
        attributes nested."""
        from tradeloom.operators.documents import build_products

        extra = self.table("part").select(
            F.col("p_partkey").alias("good_id"),
            F.create_map(
                F.lit("brand"), F.col("p_brand"),
                F.lit("type"), F.col("p_type"),
                F.lit("size"), F.col("p_size").cast("string"),
            ).alias("attributes"),
            F.split("p_name", " ").alias("tags"),
        )
        return build_products(self.goods, self.users, self.categories, extra)
