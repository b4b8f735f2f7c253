"""Batch queries over the lead messages built from the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.functions.dates import ms_to_next_midnight
from leadpulse.functions.text import json_string_field
from leadpulse.operators import lines, metrics, oneid, repair, untyped
from leadpulse.operators.parse import parse_leads, quarantine
from leadpulse.operators.upsert import upsert
from leadpulse.schema import LEAD_FIELDS, TOTAL_COLUMNS
from leadpulse.session import scratch_dir
from leadpulse.sources.fixtures import lead_messages, table

EXPIRE_TTL_DAYS = 365
UPSERT_CUT = "1998-01-01"


def leads(spark: SparkSession, sf_dir: str, variant: str = "clean", **parse_options) -> DataFrame:
    """Parsed good leads of the fixture messages."""
    return parse_leads(lead_messages(spark, sf_dir, variant), **parse_options)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def q_parse_leads(spark, sf_dir):
    return leads(spark, sf_dir).select(*LEAD_FIELDS)


def q_lead_lines(spark, sf_dir):
    return leads(spark, sf_dir).select(lines.line_of().alias("line"))


def q_line_fields(spark, sf_dir):
    line = F.col("line")
    return (leads(spark, sf_dir).select(lines.line_of().alias("line"))
            .select(lines.line_field(line, "leadId").alias("leadid"),
                    lines.line_field(line, "regionCode").alias("regioncode"),
                    lines.line_field(line, "vfrom2").alias("vfrom2"),
                    lines.line_field(line, "newLeadDealer").alias("newleaddealer")))


def q_parse_dirty(spark, sf_dir):
    """Odd flags, dates, blanks and separators, read as the reference binds them."""
    return leads(spark, sf_dir, "dirty").select(*LEAD_FIELDS)


def q_quarantine_dirty(spark, sf_dir):
    """All four reasons for which a message is set aside."""
    bad = quarantine(lead_messages(spark, sf_dir, "dirty"))
    return bad.select(json_string_field(F.col("value"), "leadId").alias("leadid"), "reason")


def q_oneid_dirty(spark, sf_dir):
    return oneid.oneid_outbox(leads(spark, sf_dir, "dirty"))


def q_missing_line(spark, sf_dir):
    """Placeholder line (P6) for every message that could not be read."""
    bad = quarantine(lead_messages(spark, sf_dir, "truncated"))
    return bad.select(json_string_field(F.col("value"), "leadId").alias("leadid"),
                      lines.missing_line().alias("line"))


def q_lead_total_daily(spark, sf_dir):
    return metrics.total_daily(leads(spark, sf_dir))


def q_lead_hq_daily(spark, sf_dir):
    return metrics.hq_daily(leads(spark, sf_dir))


def q_lead_dealer_daily(spark, sf_dir):
    return metrics.dealer_daily(leads(spark, sf_dir))


def q_lead_counters_daily(spark, sf_dir):
    return metrics.day_counters(leads(spark, sf_dir))


def q_complete_leads(spark, sf_dir):
    return metrics.complete_leads(leads(spark, sf_dir)).select(F.col("leadId").alias("leadid"))


def q_lead_dim_daily(spark, sf_dir):
    return metrics.dim_daily(leads(spark, sf_dir))


def q_lead_dim_latest(spark, sf_dir):
    return metrics.dim_latest(metrics.dim_daily(leads(spark, sf_dir)))


def q_oneid_outbox(spark, sf_dir):
    return oneid.oneid_outbox(leads(spark, sf_dir))


def q_oneid_reply(spark, sf_dir):
    """Replies as the identity service writes them, read back."""
    good = leads(spark, sf_dir)
    payload = oneid.oneid_payload(F.col("createTime"))
    reply = oneid.reply_text(F.lit(200), F.lit("success"), F.col("leadId"), payload)
    return good.select(oneid.parse_reply(reply).alias("r")).select("r.*")


def q_oneid_lenient(spark, sf_dir):
    """Months and days out of range carried over."""
    return oneid.oneid_outbox(leads(spark, sf_dir, "rollover"), lenient=True)


def q_reply_variant(spark, sf_dir):
    """Replies whose ``data`` is an object, a text, a list, null or a flag, or that are no
    JSON at all, by the lead id modulo 6."""
    key = F.col("leadId").cast("bigint")
    data = F.concat(F.lit('{"createTime":'), key, F.lit("}"))
    for remainder, text in enumerate(('"none"', "[1,2]", "null", "true"), 1):
        data = F.when(key % 6 == remainder, F.lit(text)).otherwise(data)
    text = F.concat(F.lit('{"code":200,"status":"success","data":'), data,
                    F.when(key % 6 == 5, F.lit("")).otherwise(F.lit("}")))
    rows = leads(spark, sf_dir).select("leadId", untyped.reply_variant(text).alias("r"))
    return rows.select(F.col("leadId").alias("leadid"), "r.code", "r.data_type", untyped.variant_value(
        F.col("r.data"), "$.createTime", "bigint").alias("create_time"))


def q_unknown_fields(spark, sf_dir):
    return untyped.unknown_fields(lead_messages(spark, sf_dir, "extra"))


def q_line_repair(spark, sf_dir):
    """Lines whose dealer's name holds a separator, put right by what regular lines hold; a
    separator in the third source level could as well belong to the fourth."""
    good = leads(spark, sf_dir, "dirty").withColumn("vfrom3", F.when(
        F.col("leadId").cast("bigint") % 29 == 0, F.concat("vfrom3", F.lit(";x"))).otherwise(
        F.col("vfrom3")))
    stored = written(spark, good.select("leadId", lines.line_of().alias("line")), "lines")
    repaired = repair.repair_lines(stored, repair.learn_kinds(stored))
    return repaired.select(F.col("leadId").alias("leadid"), "status", *[
        repair.repaired_field(n).alias(n.lower()) for n in ("dealerName", "regionCode", "newLeadDealer")])


def q_csv_unquote(spark, sf_dir):
    return leads(spark, sf_dir, "csv", unquote=True).select(F.col("leadId").alias("leadid"))


def q_quarantine(spark, sf_dir):
    bad = quarantine(lead_messages(spark, sf_dir, "truncated"))
    return bad.select(json_string_field(F.col("value"), "leadId").alias("leadid"), "reason")


def q_upsert_totals(spark, sf_dir):
    """Offline-only totals (old table) replaced by full totals from 1998 on."""
    day, amount = TOTAL_COLUMNS
    # Both tables from one aggregation (one row per day), written once for the
    # three branches of the upsert, so that the leads are parsed once.
    by_day = leads(spark, sf_dir).groupBy(F.col("day").alias(day)).agg(
        F.count_if(F.col("vfrom1") == "OFF").alias("offline"),
        F.count_if(F.col("day") >= F.lit(UPSERT_CUT).cast("date")).alias("recent"),
        F.count(F.lit(1)).alias("every"))
    by_day = written(spark, by_day, "totals")
    old = by_day.filter(F.col("offline") > 0).select(day, F.col("offline").alias(amount))
    new = by_day.filter(F.col("recent") > 0).select(day, F.col("every").alias(amount))
    return upsert(old, new, [day])


def q_expire_counters(spark, sf_dir):
    daily = written(spark, metrics.dim_daily(leads(spark, sf_dir)), "daily")
    now = daily.select(F.max("lz_date")).scalar()
    return metrics.expire(daily, EXPIRE_TTL_DAYS, now)


def q_ms_to_midnight(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", ms_to_next_midnight(F.col("ts")).alias("ms"))


BATCH_QUERIES = {
    "parse_leads": q_parse_leads,
    "lead_lines": q_lead_lines,
    "line_fields": q_line_fields,
    "parse_dirty": q_parse_dirty,
    "quarantine_dirty": q_quarantine_dirty,
    "oneid_dirty": q_oneid_dirty,
    "missing_line": q_missing_line,
    "lead_total_daily": q_lead_total_daily,
    "lead_hq_daily": q_lead_hq_daily,
    "lead_dealer_daily": q_lead_dealer_daily,
    "lead_counters_daily": q_lead_counters_daily,
    "complete_leads": q_complete_leads,
    "lead_dim_daily": q_lead_dim_daily,
    "lead_dim_latest": q_lead_dim_latest,
    "oneid_outbox": q_oneid_outbox,
    "oneid_reply": q_oneid_reply,
    "csv_unquote": q_csv_unquote,
    "oneid_lenient": q_oneid_lenient,
    "reply_variant": q_reply_variant,
    "unknown_fields": q_unknown_fields,
    "line_repair": q_line_repair,
    "quarantine": q_quarantine,
    "upsert_totals": q_upsert_totals,
    "expire_counters": q_expire_counters,
    "ms_to_midnight": q_ms_to_midnight,
}
