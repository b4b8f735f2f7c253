"""Registered queries that run the streaming jobs (and the archive) end to end.

The fixture messages are cut into day-aligned slices by ``ingest_ts``. Each
slice is appended to the source folder as new files, then the query runs
with ``availableNow`` on the same checkpoint, as a restart does: its state,
offsets and watermark carry over from the previous run. The query's result
table is read back at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.functions.text import json_string_field
from leadpulse.operators import metrics
from leadpulse.operators.parse import parse_leads
from leadpulse.plans.backfill import Backfill
from leadpulse.plans.batch import leads, written
from leadpulse.plans.oracle import LEAD_VIEW, LINES_SQL, ORACLE_SQL, ORDER_JOIN, with_ctes
from leadpulse.session import scratch_dir
from leadpulse.sinks.archive import (LEGACY_SUFFIX, archive_counts, read_archive, recheck,
                                     write_archive)
from leadpulse.sinks.runs import compact_runs, read_runs, run_name
from leadpulse.sources.fixtures import SLICE_CUTS, in_slice, lead_messages, slice_bounds
from leadpulse.sources.stream import file_leads, write_envelopes
from leadpulse.streaming import jobs
from leadpulse.streaming.recount import recount

ONCE = {"availableNow": True}


def state_partitions(spark: SparkSession) -> int:
    """State store partitions for a new checkpoint: one per core."""
    return spark.sparkContext.defaultParallelism


def replay(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame, str], object],
           variant: str = "clean", reverse: bool = False, name: str = "stream",
           cuts=SLICE_CUTS, messages: DataFrame | None = None,
           session: SparkSession | None = None):
    """Feed the fixture slices one run at a time; returns (base, progress).

    Each run is one batch, so its progress reports are all still there.
    ``messages`` replaces the fixture of ``variant``; ``session`` runs the stream.
    """
    base = scratch_dir(spark, name)
    source = f"{base}/input"
    # Build the messages once; each slice is then a pushed-down filter on
    # the written table instead of a rebuild of the joins and the JSON.
    if messages is None:
        messages = lead_messages(spark, sf_dir, variant)
    messages.write.parquet(f"{base}/messages")
    messages = spark.read.parquet(f"{base}/messages")
    bounds = slice_bounds(tuple(cuts))
    if reverse:
        bounds = bounds[::-1]
    progress = []
    for b in bounds:
        write_envelopes(messages.filter(in_slice("ingest_ts", b)), source)
        query = run(file_leads(session or spark, source), base)
        query.awaitTermination()
        progress.extend(query.recentProgress)
    return base, progress


def _counters(spark, sf_dir, watermark=None, base=None, **options):
    """Run the counters job; ``base`` is the output folder of other writers' tables."""
    sinks = {}

    def run(src, own):
        sinks.setdefault("sink", jobs.CounterSink(base or own))
        return jobs.start(jobs.counters_stream(src, watermark), sinks["sink"], f"{own}/_ckpt", ONCE,
                          state_partitions=state_partitions(spark))

    _, progress = replay(spark, sf_dir, run, **{"name": "counters", **options})
    return sinks["sink"], progress


def _dims(spark, sf_dir, base=None, **options):
    sinks = {}

    def run(src, own):
        sinks.setdefault("sink", jobs.DimSink(base or own))
        return jobs.start(jobs.dims_stream(src), sinks["sink"], f"{own}/_ckpt", ONCE,
                          state_partitions=state_partitions(spark))

    replay(spark, sf_dir, run, **{"name": "dims", **options})
    return sinks["sink"]


def _raw(spark, sf_dir, variant="clean", outputs=jobs.RAW_OUTPUTS, base=None, **options):
    sinks = {}

    def run(src, own):
        sinks.setdefault("sink", jobs.RawSink(base or own, outputs=outputs))
        return jobs.start(src, sinks["sink"], f"{own}/_ckpt", ONCE, output_mode="append")

    replay(spark, sf_dir, run, variant=variant, **{"name": "raw", **options})
    return sinks["sink"]


def q_stream_totals(spark, sf_dir):
    sink, _ = _counters(spark, sf_dir)
    return sink.views(spark)["total"]


def q_stream_counters(spark, sf_dir):
    """All three day tables of one run, in long form."""
    sink, _ = _counters(spark, sf_dir)
    parts = []
    for name, df in sink.views(spark).items():
        date_col, amount = df.columns
        parts.append(df.select(F.lit(name).alias("counter"), F.col(date_col).alias("clue_dt"),
                               F.col(amount).alias("amount")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_stream_late_totals(spark, sf_dir):
    """Slices fed newest first: rows behind the watermark are dropped."""
    sink, _ = _counters(spark, sf_dir, watermark=jobs.DAY, reverse=True, name="late")
    return sink.views(spark)["total"]


def q_stream_late_recount(spark, sf_dir):
    """The same, then the days recounted from the stored leads: none is missing."""
    base = scratch_dir(spark, "late-recount")
    parsed = jobs.parsed_stream(lead_messages(spark, sf_dir))
    jobs.leads_by_day(parsed).write.parquet(f"{base}/leads")
    sink, _ = _counters(spark, sf_dir, watermark=jobs.DAY, reverse=True, base=base, name="late")
    recount(spark, base, "9999-01-01", ["counters"])
    return sink.table.read(spark)


def q_stream_dims(spark, sf_dir):
    return _dims(spark, sf_dir).daily.read(spark)


def q_stream_dim_latest(spark, sf_dir):
    return _dims(spark, sf_dir).latest(spark)


def q_stream_archive(spark, sf_dir):
    sink = _raw(spark, sf_dir, "clean")
    return archive_counts(read_archive(spark, sink.archive))


def q_stream_outbox(spark, sf_dir):
    sink = _raw(spark, sf_dir, "clean", outputs=("outbox",))
    return read_runs(spark, sink.outbox).select("leadid", "payload")


def q_stream_quarantine(spark, sf_dir):
    sink = _raw(spark, sf_dir, "truncated", outputs=("quarantine",))
    bad = read_runs(spark, sink.quarantine)
    return bad.select(json_string_field(F.col("value"), "leadId").alias("leadid"), "reason")


def _backfill(spark, sf_dir, outputs, variant="clean"):
    job = Backfill(scratch_dir(spark, "backfill"))
    job.run(lead_messages(spark, sf_dir, variant), outputs)
    return job


def q_backfill_counters(spark, sf_dir):
    """Day counters loaded in batch into the streaming result table."""
    return _backfill(spark, sf_dir, ["counters"]).counters.table.read(spark)


def q_backfill_dim_latest(spark, sf_dir):
    return _backfill(spark, sf_dir, ["dims"]).dims.latest(spark)


def q_backfill_quarantine(spark, sf_dir):
    job = _backfill(spark, sf_dir, ["quarantine"], variant="truncated")
    bad = read_runs(spark, job.quarantine)
    return bad.select(json_string_field(F.col("value"), "leadId").alias("leadid"), "reason")


def q_archive_readback(spark, sf_dir):
    """Batch archive write (K1), read back line by line."""
    path = scratch_dir(spark, "archive")
    write_archive(leads(spark, sf_dir), path, run_name("backfill", 0))
    return read_archive(spark, path).select("dt", F.col("value").alias("line"))


def q_archive_options(spark, sf_dir):
    """One gzip file per folder and write (K2, K3), lines with the key's suffix (K4).

    Folders are months here.
    """
    path = scratch_dir(spark, "archive-options")
    monthly = leads(spark, sf_dir).withColumn("month", F.trunc("day", "month"))
    write_archive(monthly, path, run_name("backfill", 0), dt_col="month", compression="gzip",
                  single_file=True, legacy_suffix=True)
    lines = spark.read.text(path).select("dt", "value", F.col("_metadata.file_path").alias("file"))
    return lines.groupBy("dt").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("file").alias("files"),
        F.count_if(F.col("file").endswith(".gz")).alias("in_gzip"),
        F.count_if(F.col("value").endswith(LEGACY_SUFFIX)).alias("with_suffix"))


def q_archive_recheck(spark, sf_dir):
    """Months for which the count recorded at the time is not that of the leads, counted anew
    from the archive of these months alone.

    The record lacks some leads of 1996. Folders are months here.
    """
    path = scratch_dir(spark, "archive-recheck")
    month = F.trunc("day", "month")
    monthly = written(spark, leads(spark, sf_dir).withColumn("month", month), "monthly")
    write_archive(monthly, path, run_name("backfill", 0), dt_col="month")
    forgotten = (F.year("month") == 1996) & (F.col("leadId").cast("bigint") % 4 == 0)
    counts = monthly.groupBy(F.date_format("month", "yyyy-MM-dd").alias("dt")).agg(
        F.count(F.lit(1)).alias("counted"), F.count_if(~forgotten).alias("recorded"))
    counts = written(spark, counts, "counts")
    return recheck(read_archive(spark, path), counts)


def _history_then_stream(spark, sf_dir, outputs):
    """History by a backfill, run twice, and the rest by streams into the same tables.

    The days of 1997 are cut inside: even order keys are history.
    """
    base = scratch_dir(spark, "mixed")
    lead_messages(spark, sf_dir, with_key=True).write.parquet(f"{base}/all")
    every = spark.read.parquet(f"{base}/all")
    old = ((F.col("ingest_ts") < "1997-01-01")
           | ((F.col("ingest_ts") < "1998-01-01") & (F.col("o_orderkey") % 2 == 0)))
    columns = ("value", "ingest_ts")
    job = Backfill(base)
    for _ in range(2):
        job.run(every.filter(old).select(*columns), outputs)
    return base, every.filter(~old).select(*columns)


def q_backfill_then_stream_counters(spark, sf_dir):
    """The stream's tables are also compacted once."""
    base, rest = _history_then_stream(spark, sf_dir, ["counters"])
    sink, _ = _counters(spark, sf_dir, base=base, messages=rest)
    sink.table.compact(spark)
    return sink.table.read(spark)


def q_backfill_then_stream_outbox(spark, sf_dir):
    """The outbox is also compacted once."""
    base, rest = _history_then_stream(spark, sf_dir, ["outbox"])
    sink = _raw(spark, sf_dir, outputs=("outbox",), base=base, messages=rest)
    compact_runs(spark, sink.outbox)
    return read_runs(spark, sink.outbox).select("leadid", "payload")


def q_dim_merge(spark, sf_dir):
    """The latest count per dimension (K6), merged from slices that arrive newest
    first, after a backfill of the history."""
    base, rest = _history_then_stream(spark, sf_dir, ["dims"])
    sink = _dims(spark, sf_dir, base=base, messages=rest, reverse=True)
    return sink.newest.read(spark)


def q_audit_columns(spark, sf_dir):
    """K8: over two merges ``create_time`` stays and ``update_time`` moves on.

    The second merge holds the days from the last cut on.
    """
    table = jobs.CounterSink(scratch_dir(spark, "audit")).table
    days = written(spark, metrics.day_counters(leads(spark, sf_dir)), "days")
    table.merge(days, "audit", 0)
    first = table.read(spark, audit=True).select("day", F.col("create_time").alias("created"),
                                                 F.col("update_time").alias("updated"))
    first = written(spark, first, "audit-first")
    table.merge(days.filter(F.col("day") >= SLICE_CUTS[-1]), "audit", 1)
    return (table.read(spark, audit=True).join(first, "day")
            .select("day", (F.col("create_time") == F.col("created")).alias("create_kept"),
                    (F.col("update_time") > F.col("updated")).alias("update_moved")))


def q_batch_ledger(spark, sf_dir):
    """Messages, leads and messages set aside of each batch."""
    sink = _raw(spark, sf_dir, "truncated", outputs=("batches",))
    return sink.read_batches(spark).select("batch", "messages", "leads", "set_aside")


# A zone that is not UTC; lead times are spread over the hours of a day.
ZONE = "Asia/Shanghai"


def _in_zone(spark, sf_dir):
    """A session in :data:`ZONE`, and the messages as written by the UTC session."""
    hours = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    messages = (lead_messages(spark, sf_dir, with_key=True)
                .select("value", (F.col("ingest_ts") + hours).alias("ingest_ts")))
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", ZONE)
    return session, messages


def q_lead_counters_zone(spark, sf_dir):
    """Batch day counters of a session off UTC."""
    session, messages = _in_zone(spark, sf_dir)
    path = scratch_dir(spark, "zone")
    messages.write.parquet(path)
    return metrics.day_counters(parse_leads(session.read.parquet(path)))


def q_stream_counters_zone(spark, sf_dir):
    """The same from a stream of that session."""
    session, messages = _in_zone(spark, sf_dir)
    sink, _ = _counters(spark, sf_dir, messages=messages, session=session, name="zone")
    return sink.table.read(session)


STREAM_QUERIES = {
    "archive_readback": q_archive_readback,
    "archive_options": q_archive_options,
    "archive_recheck": q_archive_recheck,
    "backfill_then_stream_counters": q_backfill_then_stream_counters,
    "backfill_then_stream_outbox": q_backfill_then_stream_outbox,
    "dim_merge": q_dim_merge,
    "audit_columns": q_audit_columns,
    "batch_ledger": q_batch_ledger,
    "lead_counters_zone": q_lead_counters_zone,
    "stream_counters_zone": q_stream_counters_zone,
    "stream_totals": q_stream_totals,
    "stream_counters": q_stream_counters,
    "stream_late_totals": q_stream_late_totals,
    "stream_late_recount": q_stream_late_recount,
    "stream_dims": q_stream_dims,
    "stream_dim_latest": q_stream_dim_latest,
    "stream_archive": q_stream_archive,
    "stream_outbox": q_stream_outbox,
    "stream_quarantine": q_stream_quarantine,
    "backfill_counters": q_backfill_counters,
    "backfill_dim_latest": q_backfill_dim_latest,
    "backfill_quarantine": q_backfill_quarantine,
}

_ARCHIVE_SQL = with_ctes(LEAD_VIEW) + "select day as dt, count(*) as lines from L group by day"

_ZONE_SQL = with_ctes(LEAD_VIEW) + (
    "select cast(day + to_hours(cast(leadId as bigint) % 24 + 8) as date) as day, count(*) as total,"
    " count(*) filter (where newLeadHQ) as hq, count(*) filter (where newLeadDealer) as dealer"
    " from L group by 1")

STREAM_ORACLE_SQL = {
    "archive_readback": with_ctes(LEAD_VIEW, f"lines as ({LINES_SQL})") + "select dt, line from lines",
    "archive_options": with_ctes(LEAD_VIEW) + (
        "select strftime(date_trunc('month', day), '%Y-%m-%d') as dt, count(*) as lines, 1 as files,"
        " count(*) as in_gzip, count(*) as with_suffix from L group by 1"),
    "archive_recheck": with_ctes(LEAD_VIEW) + (
        "select strftime(date_trunc('month', day), '%Y-%m-%d') as dt, count(*) as counted,"
        " count(*) filter (cast(leadId as bigint) % 4 <> 0) as recorded, count(*) as lines"
        " from L where year(day) = 1996 group by 1 having counted <> recorded"),
    "backfill_then_stream_counters": ORACLE_SQL["lead_counters_daily"],
    "backfill_then_stream_outbox": ORACLE_SQL["oneid_outbox"],
    "dim_merge": ORACLE_SQL["lead_dim_latest"].replace(
        "min(lz_date) as lz_date,", "min(lz_date) as lz_date, max(lz_date) as last_day,"),
    "audit_columns": with_ctes(LEAD_VIEW) + (
        f"select distinct day, true as create_kept, day >= date '{SLICE_CUTS[-1]}' as update_moved from L"),
    "batch_ledger": (
        f"select (o_orderdate >= date '{SLICE_CUTS[0]}')::bigint + (o_orderdate >= date '{SLICE_CUTS[1]}')::bigint"
        " as batch, count(*) as messages, count(*) filter (where o_orderkey % 19 <> 0) as leads,"
        f" count(*) filter (where o_orderkey % 19 = 0) as set_aside from {ORDER_JOIN} group by 1"),
    "lead_counters_zone": _ZONE_SQL,
    "stream_counters_zone": _ZONE_SQL,
    "stream_totals": ORACLE_SQL["lead_total_daily"],
    "stream_counters": with_ctes(LEAD_VIEW) + (
        "select 'total' as counter, day as clue_dt, count(*) as amount from L group by day"
        " union all select 'hq', day, count(*) from L where newLeadHQ group by day"
        " union all select 'dealer', day, count(*) from L where newLeadDealer group by day"),
    "stream_late_totals": with_ctes(LEAD_VIEW) + (
        "select day as clue_dt, count(*) as clue_amounts from L"
        f" where day >= date '{SLICE_CUTS[-1]}' group by day"),
    "stream_late_recount": ORACLE_SQL["lead_counters_daily"],
    "stream_dims": ORACLE_SQL["lead_dim_daily"],
    "stream_dim_latest": ORACLE_SQL["lead_dim_latest"],
    "stream_archive": _ARCHIVE_SQL,
    "stream_outbox": ORACLE_SQL["oneid_outbox"],
    "stream_quarantine": ORACLE_SQL["quarantine"],
    "backfill_counters": ORACLE_SQL["lead_counters_daily"],
    "backfill_dim_latest": ORACLE_SQL["lead_dim_latest"],
    "backfill_quarantine": ORACLE_SQL["quarantine"],
}
