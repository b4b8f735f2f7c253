"""Recount of days whose late leads a watermark kept out of the counters.

The leads table holds every lead, however late. What it counts beyond the
streams' own counts is written as rows of a writer of its own, ``recount``,
whose counts add to theirs as any writer's do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.operators import metrics
from leadpulse.operators.parse import split_good
from leadpulse.sinks.runs import STREAM_WRITERS
from leadpulse.streaming.jobs import LEADS_DAY, CounterSink, DimSink

WRITER = "recount"
OUTPUTS = ("counters", "dims")


def stored_leads(spark: SparkSession, base: str, before: dt.date,
                 since: dt.date | None = None) -> DataFrame:
    """Good leads of the days from ``since`` up to ``before``; other days' folders are
    not read. The session's time zone must be that of the stream."""
    rows = spark.read.parquet(f"{base}/leads").where(F.col(LEADS_DAY) < F.lit(before))
    if since is not None:
        rows = rows.where(F.col(LEADS_DAY) >= F.lit(since))
    return split_good(rows)


def recount(spark: SparkSession, base: str, before: str | dt.date, outputs=OUTPUTS,
            since: str | dt.date | None = None) -> None:
    """Bring the days before ``before`` to the counts of ``base/leads``; with ``since``, only
    those from it on are read and counted.

    These days must lie behind the watermark: a stream may still count leads
    of later ones itself. A recount run again changes nothing, and one of a later
    date takes the place of earlier ones.
    """
    if unknown := set(outputs) - set(OUTPUTS):
        raise ValueError(f"unknown outputs {sorted(unknown)}")
    before = dt.date.fromisoformat(str(before))
    number = int(before.strftime("%Y%m%d"))
    since = None if since is None else dt.date.fromisoformat(str(since))
    good = stored_leads(spark, base, before, since)
    if "counters" in outputs:
        sink = CounterSink(base)
        sink.merge(sink.table.missing(metrics.day_counters(good), STREAM_WRITERS), WRITER, number)
    if "dims" in outputs:
        sink = DimSink(base)
        rows = sink.daily.missing(metrics.dim_daily(good), STREAM_WRITERS).persist()
        try:
            sink.merge(rows, WRITER, number)
        finally:
            rows.unpersist()
