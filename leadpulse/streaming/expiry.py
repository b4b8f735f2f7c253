"""Dimension counters that expire, in a stream.

A counter lives until its time to live has passed since its last lead, and the
next lead starts it again at one. That is a session window: leads of one key with
no gap of the time to live between them. The state holds the running counters; a
counter comes out once the watermark shows that it has expired, so late leads
within the watermark still join or bridge counters, in any order of arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.operators import metrics
from leadpulse.operators.parse import REASON, parse_messages, split_good
from leadpulse.schema import DIM_COLUMNS
from leadpulse.sinks.runs import run_name, write_run, writer_of

# Sessions of a task are merged before the shuffle: a hot key sends few rows.
MERGE_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _gap(ttl_days: int) -> str:
    # Sessions that touch are one; a lead just when the counter expires starts anew.
    return f"{ttl_days * 86_400 - 1} seconds 999999 microseconds"


def expiring_counters(messages: DataFrame, ttl_days: int, watermark: str = "1 day",
                      **parse_options) -> DataFrame:
    """``<dims>, first_ts, last_ts, lead_cnt`` of each counter, as it expires (append mode)."""
    parsed = messages if REASON in messages.columns else parse_messages(messages, **parse_options)
    leads = metrics.complete_leads(split_good(parsed)).withWatermark("ingest_ts", watermark)
    window = F.session_window("ingest_ts", _gap(ttl_days))
    return (leads.groupBy(window, *metrics.dim_columns())
            .agg(F.min("ingest_ts").alias("first_ts"), F.max("ingest_ts").alias("last_ts"),
                 F.count(F.lit(1)).alias("lead_cnt"))
            .select(*DIM_COLUMNS, "first_ts", "last_ts", "lead_cnt"))


class ExpiredSink:
    """foreachBatch sink: the counters that expired in a batch, as a run of it."""

    def __init__(self, base: str):
        self.path = f"{base}/expired_counters"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        write_run(batch.hint("rebalance"), self.path,
                  run_name(writer_of(batch.sparkSession), batch_id))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("run")
