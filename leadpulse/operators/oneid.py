"""Identity (OneID) messages.

The reference posts one message per lead to an identity service. Here the
messages become rows of an outbox table that a delivery job can send; the
payload is the JSON the service receives: every identity field is NULL (and
so left out) and ``createTime`` is the lead's creation date as epoch
milliseconds of midnight in the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpulse.functions.dates import date_prefix, epoch_millis_of_day, lenient_date
from leadpulse.schema import ONEID_SCHEMA, REPLY_SCHEMA


def oneid_payload(create_time: Column, lenient: bool = False) -> Column:
    """JSON payload for a lead's ``createTime`` text; NULL when no date parses.

    ``lenient`` lets months and days out of range carry over, as the reference does.
    """
    day = lenient_date(create_time) if lenient else date_prefix(create_time)
    fields = []
    for field in ONEID_SCHEMA.fields:
        if field.name == "createTime":
            fields.append(epoch_millis_of_day(day).alias("createTime"))
        else:
            fields.append(F.lit(None).cast(field.dataType).alias(field.name))
    return F.when(day.isNotNull(), F.to_json(F.struct(*fields)))


def oneid_outbox(leads: DataFrame, *extra: str, lenient: bool = False) -> DataFrame:
    """``leadid, payload`` per lead whose createTime gives a date.

    ``extra`` columns (for example ``day`` to partition by) are carried along.
    """
    payload = oneid_payload(F.col("createTime"), lenient)
    return (leads.select(F.col("leadId").alias("leadid"), payload.alias("payload"), *extra)
            .filter(F.col("payload").isNotNull()))


def parse_reply(reply: Column) -> Column:
    """Reply text -> ``struct<code, status, msg, data>``; ``data`` stays JSON text."""
    return F.from_json(reply, REPLY_SCHEMA)


def reply_text(code: Column, status: Column, msg: Column, data_json: Column) -> Column:
    """Reply text as the service writes it, with ``data`` as a JSON value."""
    data = F.from_json(data_json, "createTime BIGINT")
    return F.to_json(F.struct(code.alias("code"), status.alias("status"),
                              msg.alias("msg"), data.alias("data")))
