"""Columns over the text of an event envelope."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields every envelope must have, in this order.
REQUIRED = ["eventId", "eventType", "entityId", "timestamp", "source", "payload", "version", "metadata"]

ENVELOPE = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("entityId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("correlationId", T.StringType()),
                    T.StructField("producer", T.StringType()),
                    T.StructField("schemaHint", T.StringType()),
                ]
            ),
        ),
    ]
)


def text_keys(value: Column) -> Column:
    """Field names of a JSON object; NULL for anything else.

    Fields that are present with a null count as present.
    """
    return F.when(F.endswith(F.rtrim(value), F.lit("}")), F.json_object_keys(value))


def missing_fields(value: Column) -> Column:
    """Required fields an envelope lacks; all of them for an empty body, NULL
    for a body that is not a JSON object."""
    required = F.array(*[F.lit(f) for f in REQUIRED])
    empty = value.isNull() | (value == "")
    return F.when(empty, required).otherwise(F.array_except(required, text_keys(value)))


def event_type_text(value: Column) -> Column:
    """``eventType`` as text; empty when absent, null, nested or unparsable.

    Text that looks like an object or array is parsed again to see whether it is
    one or a string saying so; all other events take the short way.
    """
    raw, nested = _event_type(value)
    return F.when(text_keys(value).isNotNull() & ~nested, F.coalesce(raw, F.lit(""))).otherwise("")


def _event_type(value: Column) -> tuple[Column, Column]:
    """The raw text of ``eventType``, and whether it is an object or array."""
    raw = F.get_json_object(value, "$.eventType")
    held = F.try_variant_get(F.try_parse_json(value), "$.eventType", "variant")
    nested = F.when(raw.rlike(r"^[\[{]"), F.schema_of_variant(held).rlike("^(OBJECT|ARRAY)")).otherwise(False)
    return raw, nested


def group_key(value: Column) -> Column:
    """Event type to group by."""
    raw, nested = _event_type(value)
    named = text_keys(value).isNotNull() & ~nested
    return F.when(named, F.coalesce(F.nullif(raw, F.lit("")), F.lit("UNKNOWN"))).otherwise("UNKNOWN")


def normalised(value: Column) -> Column:
    """The envelope with ``normalizedType``, the upper-cased event type, added.

    Bodies that are not JSON objects pass unchanged.  The other fields keep
    their exact text unless the field is there already and must be replaced.
    """
    name = "normalizedType"
    keys = text_keys(value)
    raw, nested = _event_type(value)
    kind = F.when(nested, F.lit("")).otherwise(F.upper(F.coalesce(raw, F.lit(""))))
    field = F.substr(F.to_json(F.struct(kind.alias(name))), F.lit(2))

    def with_field(text: Column) -> Column:
        body = F.rtrim(F.left(F.rtrim(text), F.length(F.rtrim(text)) - 1))
        return F.concat(body, F.when(F.endswith(body, F.lit("{")), F.lit("")).otherwise(F.lit(",")), field)

    others = F.to_json(F.map_filter(F.from_json(value, "map<string,variant>"), lambda k, _: k != name))
    return (
        F.when(keys.isNull(), value)
        .when(F.instr(value, f'"{name}"') == 0, with_field(value))
        .when(F.array_contains(keys, name), with_field(others))
        .otherwise(with_field(value))
    )


def event_time(value: Column) -> Column:
    """The envelope's own time (ISO-8601), NULL when absent or unreadable."""
    return F.try_to_timestamp(F.get_json_object(value, "$.timestamp"))
