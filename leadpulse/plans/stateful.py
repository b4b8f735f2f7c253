"""Registered queries on the streams' state: replies matched to messages, counters that
expire, and state read back from checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.functions.dates import timestamp_text
from leadpulse.operators.oneid import reply_text
from leadpulse.plans.batch import leads, written
from leadpulse.plans.oracle import COMPLETE, DIM_COLS, LEAD_VIEW, ORACLE_SQL, PAYLOAD, with_ctes
from leadpulse.plans.streams import ONCE, state_partitions
from leadpulse.schema import DIM_COLUMNS
from leadpulse.session import scratch_dir
from leadpulse.sources.fixtures import SLICE_CUTS, in_slice, lead_messages, slice_bounds
from leadpulse.sources.stream import file_leads, write_envelopes
from leadpulse.streaming import jobs
from leadpulse.streaming.expiry import MERGE_EARLY, ExpiredSink, expiring_counters
from leadpulse.streaming.offsets import batch_offsets
from leadpulse.streaming.replies import (REPLY_LOG_SCHEMA, SENT_SCHEMA, ReplySink, first_attempts,
                                         match_replies, next_attempts, tick)
from leadpulse.streaming.state import day_totals, restore

TTL_DAYS = 30
# The fixture's days lie within this; the slices of out-of-order queries come any time.
ANY_ORDER = "4000 days"


def reply_log(sent: DataFrame) -> DataFrame:
    """The fixture's replies, by the lead id modulo 7: never (0), after the limit (1), twice
    (2), once within the hour (others)."""
    key = F.col("leadid").cast("bigint")
    wait = F.when(key % 7 == 1, 7200).otherwise(60 + key % 3000)

    def reply(code: int, status: str, seconds) -> DataFrame:
        text = reply_text(F.lit(code), F.lit(status), F.col("leadid"), F.col("payload"))
        at = F.timestamp_seconds(F.unix_seconds("sent_ts") + seconds)
        return sent.select("leadid", "attempt", text.alias("reply"), at.alias("reply_ts"), key.alias("k"))

    first = reply(200, "success", wait).where("k % 7 <> 0")
    again = reply(500, "again", wait + 300).where("k % 7 = 2")
    return first.unionByName(again).drop("k")


def _exchange(spark: SparkSession, sf_dir: str) -> ReplySink:
    """Messages and replies in day-aligned slices, a restart per slice, then a tick."""
    base = scratch_dir(spark, "replies")
    sent = written(spark, first_attempts(leads(spark, sf_dir)), "sent")
    replies = written(spark, reply_log(sent), "replies")
    sink = ReplySink(base)

    def run():
        stream = match_replies(spark.readStream.schema(SENT_SCHEMA).json(f"{base}/sent"),
                               spark.readStream.schema(REPLY_LOG_SCHEMA).json(f"{base}/replies"))
        jobs.start(stream, sink, f"{base}/_ckpt", ONCE, output_mode="append",
                   state_partitions=state_partitions(spark)).awaitTermination()

    for bounds in slice_bounds():
        for rows, stamp, name in ((sent, "sent_ts", "sent"), (replies, "reply_ts", "replies")):
            rows.filter(in_slice(stamp, bounds)).write.mode("append").json(f"{base}/{name}")
        run()
    for stamp, name in (("sent_ts", "sent"), ("reply_ts", "replies")):
        tick(spark, "9999-01-01 00:00:00", stamp).write.mode("append").json(f"{base}/{name}")
    run()
    return sink


def q_stream_oneid_answered(spark, sf_dir):
    """The first reply of each message that got one in time."""
    rows = _exchange(spark, sf_dir).read_answered(spark)
    waited = F.unix_seconds("reply_ts") - F.unix_seconds("sent_ts")
    return rows.select("leadid", "code", "status", "data", waited.alias("waited"), "replies")


def q_stream_oneid_unanswered(spark, sf_dir):
    """The messages that did not, as they are sent again."""
    again = next_attempts(_exchange(spark, sf_dir).read_unanswered(spark))
    return again.select("leadid", "attempt", "payload", timestamp_text(F.col("sent_ts")).alias("sent"))


def q_stream_expiring_counters(spark, sf_dir):
    """Counters of each dimension key between expiries, from slices that come newest first.

    A last message long after all others shows the stream that they have expired.
    """
    base = scratch_dir(spark, "expiring")
    messages = written(spark, lead_messages(spark, sf_dir), "messages")
    last = spark.range(1).select(F.lit(LAST_MESSAGE).alias("value"),
                                 F.to_timestamp(F.lit("2100-01-01")).alias("ingest_ts"))
    sink = ExpiredSink(base)
    spark.conf.set(MERGE_EARLY, "true")
    slices = [messages.filter(in_slice("ingest_ts", b)) for b in reversed(slice_bounds())]
    for rows in [*slices, last]:
        write_envelopes(rows, f"{base}/in")
        jobs.start(expiring_counters(file_leads(spark, f"{base}/in"), TTL_DAYS, ANY_ORDER), sink,
                   f"{base}/_ckpt", ONCE, output_mode="append",
                   state_partitions=state_partitions(spark)).awaitTermination()
    return sink.read(spark).select(
        *DIM_COLUMNS, F.to_date("first_ts").alias("first_day"),
        F.to_date("last_ts").alias("last_day"), "lead_cnt")


LAST_MESSAGE = ('{"leadId":"last","newLeadDealer":"true","vfrom1":"-","vfrom2":"-","vfrom3":"-",'
                '"vfrom4":"-","regionCode":"-","provinceCode":"-"}')


def _counted(spark, messages: DataFrame, base: str, checkpoint: str, name: str) -> jobs.CounterSink:
    """The counters of some messages under ``base``."""
    sink = jobs.CounterSink(base)
    write_envelopes(messages, f"{base}/{name}")
    jobs.start(jobs.counters_stream(file_leads(spark, f"{base}/{name}")), sink, checkpoint, ONCE,
               state_partitions=state_partitions(spark)).awaitTermination()
    return sink


def q_state_totals(spark, sf_dir):
    """Day totals read from the state of the counters query, and whether the served table
    holds the same."""
    base = scratch_dir(spark, "state")
    sink = _counted(spark, lead_messages(spark, sf_dir), base, f"{base}/_ckpt", "in")
    held = day_totals(spark, f"{base}/_ckpt")
    served = sink.table.read(spark).withColumn("served", F.struct("total", "hq", "dealer"))
    same = F.coalesce(F.col("served") == F.struct("total", "hq", "dealer"), F.lit(False))
    return held.join(served.select("day", "served"), "day", "left").withColumn("served", same)


def q_state_restore(spark, sf_dir):
    """Totals under a new base: those of an old checkpoint's state, whose tables are gone,
    and what a new checkpoint counts from there on."""
    old, new = scratch_dir(spark, "state-old"), scratch_dir(spark, "state-new")
    messages = written(spark, lead_messages(spark, sf_dir), "messages")
    past = F.col("ingest_ts") < SLICE_CUTS[-1]
    _counted(spark, messages.filter(past), old, f"{old}/_ckpt", "in")
    restore(spark, new, counters=f"{old}/_ckpt")
    return _counted(spark, messages.filter(~past), new, f"{new}/_ckpt", "in").table.read(spark)


def q_offset_ledger(spark, sf_dir):
    """The offset that each batch read up to, beside the batch's own record."""
    base = scratch_dir(spark, "offsets")
    sink = jobs.RawSink(base, outputs=("batches",))
    messages = written(spark, lead_messages(spark, sf_dir, "truncated"), "messages")
    for bounds in slice_bounds():
        write_envelopes(messages.filter(in_slice("ingest_ts", bounds)), f"{base}/in")
        jobs.start(file_leads(spark, f"{base}/in"), sink, f"{base}/_ckpt", ONCE,
                   output_mode="append").awaitTermination()
    offsets = batch_offsets(spark, f"{base}/_ckpt")
    return offsets.join(sink.read_batches(spark), "batch").select(
        "batch", "end_offset", "messages", "leads")


STATEFUL_QUERIES = {
    "stream_oneid_answered": q_stream_oneid_answered,
    "stream_oneid_unanswered": q_stream_oneid_unanswered,
    "stream_expiring_counters": q_stream_expiring_counters,
    "state_totals": q_state_totals,
    "state_restore": q_state_restore,
    "offset_ledger": q_offset_ledger,
}

_KEY = "cast(leadId as bigint)"
_SLICE = (f"((o_orderdate >= date '{SLICE_CUTS[0]}')::bigint"
          f" + (o_orderdate >= date '{SLICE_CUTS[1]}')::bigint)")

STATEFUL_ORACLE_SQL = {
    "stream_oneid_answered": with_ctes(LEAD_VIEW) + (
        "select leadId as leadid, 200 as code, 'success' as status,"
        f" {PAYLOAD} as data, 60 + {_KEY} % 3000 as waited,"
        f" case when {_KEY} % 7 = 2 then 2 else 1 end::bigint as replies"
        f" from L where createTime is not null and {_KEY} % 7 > 1"),
    "stream_oneid_unanswered": with_ctes(LEAD_VIEW) + (
        f"select leadId as leadid, 2 as attempt, {PAYLOAD} as payload,"
        " strftime(day + interval 1 hour, '%Y-%m-%d %H:%M:%S') as sent"
        f" from L where createTime is not null and {_KEY} % 7 <= 1"),
    "stream_expiring_counters": with_ctes(
        LEAD_VIEW,
        f"C as (select vfrom1, vfrom2, vfrom3, vfrom4, regionCode as region_code,"
        f" provinceCode as province_code, day from L where {COMPLETE})",
        f"G as (select *, coalesce(day - lag(day) over (partition by {DIM_COLS} order by day)"
        f" >= {TTL_DAYS}, true) as starts from C)",
        f"I as (select *, count(*) filter (starts) over (partition by {DIM_COLS} order by day"
        " rows unbounded preceding) as life from G)") + (
        f"select {DIM_COLS}, min(day) as first_day, max(day) as last_day, count(*) as lead_cnt"
        f" from I group by {DIM_COLS}, life"),
    "state_totals": ORACLE_SQL["lead_counters_daily"].replace(
        "as dealer from L", "as dealer, true as served from L"),
    "state_restore": ORACLE_SQL["lead_counters_daily"],
    "offset_ledger": (
        f"select batch, '{{\"logOffset\":' || batch || '}}' as end_offset, messages, leads from ("
        f"select {_SLICE} as batch, count(*) as messages, count(*) filter (where o_orderkey % 19 <> 0)"
        " as leads from orders group by 1)"),
}
