"""Data-quality checks: each returns the rows that break a rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.plans.ordered import top_per_group


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose foreign key has no parent; NULL keys are allowed."""
    parents = parent.select(F.col(key).alias(foreign_key))
    return child.where(F.col(foreign_key).isNotNull()).join(parents, foreign_key, "left_anti")


def check_violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which a CHECK is false; unknown (NULL) passes."""
    return df.where(~F.coalesce(rule, F.lit(True)))


@dataclass(frozen=True)
class Rule:
    """What a document field must satisfy; checks of absent fields are skipped,
    except ``required``."""

    field: str
    required: bool = False
    kind: str | None = None  # 'int' or 'string'
    minimum: int | None = None
    maximum: int | None = None
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    max_items: int | None = None

    def broken(self) -> list[Column]:
        """One column per check: the name of the check if broken, else NULL."""
        value, out = F.col(self.field), []

        def add(check: str, bad: Column) -> None:
            out.append(F.when(bad, F.lit(f"{self.field}.{check}")))

        if self.required:
            add("required", value.isNull())
        if self.kind == "int":
            # A whole number, however it is stored.
            whole = value.try_cast("decimal(38,9)")
            add("type", value.isNotNull() & F.coalesce(whole != F.floor(whole), F.lit(True)))
        if self.kind == "string":
            add("type", value.isNotNull() & (F.typeof(value) != "string"))
        # Compared as numbers, whatever type the field arrived with.
        number = value.try_cast("double") if self.minimum is not None or self.maximum is not None else None
        if self.minimum is not None:
            add("minimum", number < self.minimum)
        if self.maximum is not None:
            add("maximum", number > self.maximum)
        if self.min_length is not None:
            add("minLength", F.length(value) < self.min_length)
        if self.max_length is not None:
            add("maxLength", F.length(value) > self.max_length)
        if self.pattern is not None:
            add("pattern", ~value.rlike(self.pattern))
        if self.max_items is not None:
            add("maxItems", F.cardinality(value) > self.max_items)
        return out


    def broken_in(self, document: Column) -> list[Column]:
        """The checks on a field of a VARIANT document, by the type the value came with.

        An absent field breaks ``required`` only; a null is there and has no
        type.  Bounds are held against numbers only, lengths and patterns
        against strings, item counts against arrays, as a JSON schema does.
        """
        value = F.try_variant_get(document, f"$.{self.field}", "variant")
        kind = F.schema_of_variant(value)
        number = F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(document, f"$.{self.field}", "decimal(38,9)"))
        text = F.when(kind == "STRING", F.try_variant_get(document, f"$.{self.field}", "string"))
        out = []

        def add(check: str, bad: Column) -> None:
            out.append(F.when(bad, F.lit(f"{self.field}.{check}")))

        if self.required:
            add("required", value.isNull())
        if self.kind is not None:
            right = text.isNotNull() if self.kind == "string" else F.coalesce(number == F.floor(number), F.lit(False))
            add("type", value.isNotNull() & ~right)
        if self.minimum is not None:
            add("minimum", number < self.minimum)
        if self.maximum is not None:
            add("maximum", number > self.maximum)
        if self.min_length is not None:
            add("minLength", F.length(text) < self.min_length)
        if self.max_length is not None:
            add("maxLength", F.length(text) > self.max_length)
        if self.pattern is not None:
            add("pattern", ~text.rlike(self.pattern))
        if self.max_items is not None:
            items = F.when(kind.startswith("ARRAY"), F.try_variant_get(document, f"$.{self.field}", "array<variant>"))
            add("maxItems", F.size(items) > self.max_items)
        return out


# The business rules of the two document collections.
PRODUCT_RULES = [
    Rule("name", required=True, kind="string", min_length=1, max_length=500),
    Rule("merchant_id", required=True, kind="int", minimum=1),
    Rule("category_id", required=True, kind="int", minimum=1),
    Rule("good_id", kind="int", minimum=1),
]
REVIEW_RULES = [
    Rule("product_id", required=True, kind="int", minimum=1),
    Rule("user_id", required=True, kind="int", minimum=1),
    Rule("rating", required=True, kind="int", minimum=1, maximum=5),
    Rule("comment", kind="string", max_length=2000),
]


def broken_rules(df: DataFrame, rules: list[Rule], name: str = "broken") -> DataFrame:
    """Add the list of broken checks to each document (empty when valid)."""
    checks = [check for rule in rules if rule.field in df.columns for check in rule.broken()]
    missing = [F.lit(f"{r.field}.required") for r in rules if r.required and r.field not in df.columns]
    return df.withColumn(name, F.array_compact(F.array(*checks, *missing)))


def broken_json_rules(df: DataFrame, body: str, rules: list[Rule], name: str = "broken") -> DataFrame:
    """Add the list of broken checks to each document given as JSON text.

    Values keep the type they came with: a number in a text field is reported.
    A body that is null or no JSON, or no object, breaks ``document.type`` alone.
    """
    document = F.try_parse_json(F.col(body))
    is_object = F.coalesce(F.schema_of_variant(document).startswith("OBJECT"), F.lit(False))
    checks = F.array_compact(F.array(*[check for rule in rules for check in rule.broken_in(document)]))
    return df.withColumn(name, F.when(is_object, checks).otherwise(F.array(F.lit("document.type"))))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return top_per_group(df, keys, order, 1)


def copy_parity(**tables: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Row count and order-free checksum of both copies of each table."""
    out = None
    for name, (left, right) in tables.items():
        row = None
        for side, df in (("left", left), ("right", right)):
            # Summed as decimals: 64-bit hashes of many rows would overflow.
            part = df.select(F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)").alias("h")).agg(
                F.count(F.lit(1)).alias(f"{side}_rows"), F.coalesce(F.sum("h"), F.lit(0)).alias(f"{side}_sum")
            )
            if row is None:
                row = part.withColumn("table", F.lit(name))
            else:
                row = row.withColumn("_r", part.select(F.struct("*")).scalar()).select("*", "_r.*").drop("_r")
        row = row.select(
            "table",
            "left_rows",
            "right_rows",
            ((F.col("left_rows") == F.col("right_rows")) & (F.col("left_sum") == F.col("right_sum"))).alias("same"),
        )
        out = row if out is None else out.unionByName(row)
    return out
