"""Values without a fixed type, kept as VARIANT.

The reply's ``data`` may be any JSON value, and messages carry fields that the lead
schema does not name. Both are read without a schema, and their types reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpulse.schema import LEAD_FIELDS


def reply_variant(reply: Column) -> Column:
    """Reply text -> ``struct<code, status, msg, data, data_type>`` with ``data`` as VARIANT.

    A value that does not fit the type of its field is NULL, as is all of a text that is
    no JSON. ``data_type`` is the type of ``data`` as Spark names it.
    """
    whole = F.try_parse_json(reply)
    data = F.try_variant_get(whole, "$.data", "variant")
    return F.struct(F.try_variant_get(whole, "$.code", "int").alias("code"),
                    F.try_variant_get(whole, "$.status", "string").alias("status"),
                    F.try_variant_get(whole, "$.msg", "string").alias("msg"),
                    data.alias("data"), F.schema_of_variant(data).alias("data_type"))


def variant_value(data: Column, path: str, kind: str) -> Column:
    """The value at ``path`` as ``kind``; NULL where it is missing or another type."""
    return F.try_variant_get(data, path, kind)


def unknown_fields(messages: DataFrame, known=LEAD_FIELDS, value: str = "value") -> DataFrame:
    """``field, messages, kind`` of each field that the messages carry and ``known`` does
    not name; ``kind`` is one type for all its values, VARIANT where they differ."""
    objects = messages.select(F.try_parse_json(F.col(value).cast("string")).alias("_object"))
    fields = objects.lateralJoin(
        objects.sparkSession.tvf.variant_explode(F.col("_object").outer()))
    # Elements of an array have no key.
    return (fields.where(F.col("key").isNotNull() & ~F.col("key").isin(*known))
            .groupBy(F.col("key").alias("field"))
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.schema_of_variant_agg("value").alias("kind")))
