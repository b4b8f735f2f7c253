"""The counters' state read back from a checkpoint (S3, A1-A5).

The state store of a stopped query is a table. Its totals can be compared with
the served tables, and given to tables that were lost, or to those of a new base:
they are merged as rows of the old query, to which a new checkpoint's counts add.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.functions.dates import window_day
from leadpulse.schema import DIM_COLUMNS
from leadpulse.sinks.runs import writer_name
from leadpulse.streaming.jobs import CounterSink, DimSink


def _state(spark: SparkSession, checkpoint: str, *values: str) -> DataFrame:
    """Key columns of the last batch's state, and its values under the given names."""
    named = ", ".join(f"{v}: bigint" for v in values)
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.select("key.*", F.col("value").cast(f"struct<{named}>").alias("_value")).select(
        window_day(F.col("window.start")).alias("_day"), "*", "_value.*").drop("window", "_value")


def day_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``day, total, hq, dealer`` as the counters query holds them."""
    return _state(spark, checkpoint, "total", "hq", "dealer").withColumnRenamed("_day", "day")


def dim_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``lz_date, <dims>, lead_cnt`` as the dims query holds them."""
    rows = _state(spark, checkpoint, "lead_cnt")
    return rows.toDF("lz_date", *DIM_COLUMNS, "lead_cnt")


def last_batch(spark: SparkSession, checkpoint: str) -> tuple[str, int]:
    """Writer name of a checkpoint's query, and its last batch with state."""
    held = spark.read.format("state-metadata").load(checkpoint)
    batch = held.agg(F.max("maxBatchId").alias("n")).first().n
    query = spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
    return writer_name(query), int(batch)


def restore(spark: SparkSession, base: str, counters: str | None = None,
            dims: str | None = None) -> None:
    """Give the result tables under ``base`` the totals that the named checkpoints hold.

    The rows are those that the old query itself wrote last, so a table that still has
    them stays as it is. Days that a watermark has let go are in no state.
    """
    if counters:
        CounterSink(base).merge(day_totals(spark, counters), *last_batch(spark, counters))
    if dims:
        rows = dim_totals(spark, dims).persist()
        try:
            DimSink(base).merge(rows, *last_batch(spark, dims))
        finally:
            rows.unpersist()
