"""Backfill: the streaming outputs computed in batch from a message table.

History is loaded with the functions the streams use, into the same tables.
A backfill is one writer of them (see :mod:`leadpulse.sinks.runs`): its counts
add to a stream's, also within one day, and the same messages loaded again
under the same name replace the rows of the first time.

The messages are parsed once into a written table of typed leads (flat
parquet: every output reads all of it, so partitions would only multiply
files). That cuts the lineage (a lost executor recomputes from the table,
not from the JSON) and every later output reads only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.operators import metrics
from leadpulse.operators.oneid import oneid_outbox
from leadpulse.operators.parse import REASON, parse_messages, split_good, split_quarantine
from leadpulse.sinks.archive import write_archive
from leadpulse.sinks.runs import run_name, write_run
from leadpulse.streaming.jobs import CounterSink, DimSink

OUTPUTS = ("quarantine", "counters", "dims", "outbox", "archive")


class Backfill:
    """One named load under ``base``; other messages need another ``name``."""

    def __init__(self, base: str, name: str = "backfill"):
        self.name = name
        self.run_name = run_name(name, 0)
        self.parsed = f"{base}/parsed_leads/{name}"
        self.quarantine = f"{base}/quarantine"
        self.outbox = f"{base}/oneid_outbox"
        self.archive = f"{base}/archive"
        self.counters = CounterSink(base)
        self.dims = DimSink(base)

    def leads(self, spark: SparkSession) -> DataFrame:
        """The parsed good leads, read back from the written table."""
        return split_good(spark.read.parquet(self.parsed).drop("value"))

    def run(self, messages: DataFrame, outputs: Iterable[str] = OUTPUTS, **parse_options) -> None:
        """Parse ``messages`` once, then write the chosen outputs."""
        outputs = set(outputs)
        unknown = outputs - set(OUTPUTS)
        if unknown:
            raise ValueError(f"unknown outputs {sorted(unknown)}")
        spark = messages.sparkSession
        parsed = parse_messages(messages, **parse_options)
        # The raw text is kept only for the messages set aside.
        raw_if_bad = F.when(F.col(REASON).isNotNull(), F.col("value"))
        parsed.withColumn("value", raw_if_bad).write.mode("overwrite").parquet(self.parsed)
        good = self.leads(spark)
        if "quarantine" in outputs:
            write_run(split_quarantine(spark.read.parquet(self.parsed)), self.quarantine,
                      self.run_name)
        if "counters" in outputs:
            self.counters.merge(metrics.day_counters(good), self.name, 0)
        if "dims" in outputs:
            daily = f"{self.parsed}_daily"  # written once for the two tables made of it
            metrics.dim_daily(good).write.mode("overwrite").parquet(daily)
            self.dims.merge(spark.read.parquet(daily), self.name, 0)
        if "outbox" in outputs:
            write_run(oneid_outbox(good, "day"), self.outbox, self.run_name)
        if "archive" in outputs:
            write_archive(good, self.archive, self.run_name)
