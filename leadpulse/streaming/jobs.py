"""Structured Streaming jobs: the messages are parsed once, three queries read the leads.

* ``leads``: parse, and append typed leads and messages set aside to one table
  (Spark's file sink, which its file source reads exactly once).

* ``raw``: per micro-batch write the archive, the OneID outbox
  and the quarantine (stateless; outputs keyed by batch id).
* ``counters``: the day totals (total, new to brand, new to dealer) as one
  stateful aggregation over a one-day event-time window (A1-A3).
* ``dims``: the per-dimension daily counts (A4, A5).

Each has its own checkpoint: a stateful aggregation must run before
``foreachBatch``, so the three cannot share one query. Each also runs on its
own, straight on messages. The stateful ones run
in update mode and emit absolute totals for the keys that changed; the sink
writes them as its run of the batch, so a replayed batch leaves the tables as
they were (the state store restores the same version and the values are not
deltas). A new checkpoint is a new writer whose totals add to the earlier ones:
start it where the old one stopped.

Every lead counts, however late, unless a ``watermark`` on ``ingest_ts`` is
given: then days older than the watermark leave the state and later rows for
them are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadpulse.functions.dates import ingest_day, local_clock, window_day
from leadpulse.operators import metrics
from leadpulse.operators.oneid import oneid_outbox
from leadpulse.operators.parse import REASON, parse_messages, split_good, split_quarantine
from leadpulse.schema import DIM_COLUMNS
from leadpulse.sinks.archive import compact_archive, write_archive
from leadpulse.sinks.runs import (compact_runs, make_folder, read_runs, run_name, write_run,
                                   writer_of)
from leadpulse.sinks.snapshot import LatestTable, SnapshotTable

DAY = "1 day"
# The reference's micro-batch interval.
DEFAULT_TRIGGER = {"processingTime": "59 seconds"}


def parsed_stream(messages: DataFrame, **parse_options) -> DataFrame:
    """Every message parsed; the raw text is kept only of those set aside."""
    parsed = parse_messages(messages, **parse_options)
    return parsed.withColumn("value", F.when(F.col(REASON).isNotNull(), F.col("value")))


LEADS_DAY = "lead_day"  # partitions the leads table


def leads_by_day(parsed: DataFrame) -> DataFrame:
    """Parsed rows as the leads table holds them: by day, in few files per batch.

    A batch is rebalanced by day (a small day to one file, a busy one split by size), so
    its files do not multiply with the tasks that parsed it. Days are those of the
    session's time zone; rows set aside for want of a time have none.
    """
    return (parsed.withColumn(LEADS_DAY, ingest_day(F.col("ingest_ts")))
            .hint("rebalance", LEADS_DAY))


def _parsed(rows: DataFrame, **parse_options) -> DataFrame:
    """``rows`` as they are if they are parsed, else parsed."""
    return rows if REASON in rows.columns else parse_messages(rows, **parse_options)


def _by_day(good: DataFrame, watermark: str | None):
    """``good`` with its local clock, and the one-day window over it."""
    good = good.withColumn("_clock", local_clock(F.col("ingest_ts")))
    if watermark:
        good = good.withWatermark("_clock", watermark)
    return good, F.window("_clock", DAY).alias("w")


def counters_stream(messages: DataFrame, watermark: str | None = None, **parse_options) -> DataFrame:
    """``day, total, hq, dealer`` per day, in one aggregation."""
    good, window = _by_day(split_good(_parsed(messages, **parse_options)), watermark)
    counted = good.groupBy(window).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(metrics.is_new_to_brand()).alias("hq"),
        F.count_if(metrics.is_new_to_dealer()).alias("dealer"),
    )
    return counted.select(window_day(F.col("w.start")).alias("day"), "total", "hq", "dealer")


def dims_stream(messages: DataFrame, watermark: str | None = None, **parse_options) -> DataFrame:
    """``lz_date, <dims>, lead_cnt`` of the complete leads per day."""
    good = metrics.complete_leads(split_good(_parsed(messages, **parse_options)))
    good, window = _by_day(good, watermark)
    counted = good.groupBy(window, *metrics.dim_columns()).agg(F.count(F.lit(1)).alias("lead_cnt"))
    return counted.select(window_day(F.col("w.start")).alias("lz_date"), *DIM_COLUMNS, "lead_cnt")


class _PersistedBatch:
    """Persist a micro-batch while several writes read it."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __enter__(self) -> DataFrame:
        return self.df.persist()

    def __exit__(self, *exc) -> None:
        self.df.unpersist()


class CounterSink:
    """foreachBatch sink of :func:`counters_stream` (K5).

    The three day tables (total, new to brand, new to dealer) come from one
    aggregation row per day, so they are kept as one table (one merge per
    batch) and served as three views; a zero count gives no row, as in the
    reference's tables.
    """

    def __init__(self, base: str):
        self.table = SnapshotTable(f"{base}/day_counters", ["day"], ["total", "hq", "dealer"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with _PersistedBatch(batch) as rows:
            if rows.isEmpty():          # F4: nothing to write
                return
            self.merge(rows, writer_of(batch.sparkSession), batch_id)

    def merge(self, rows: DataFrame, writer: str, batch_id: int) -> None:
        self.table.merge(rows, writer, batch_id)

    def views(self, spark) -> dict[str, DataFrame]:
        """``total``, ``hq`` and ``dealer`` result tables."""
        return metrics.split_counters(self.table.read(spark))


class DimSink:
    """foreachBatch sink of :func:`dims_stream`: the daily dimension table, and the
    table of each dimension's latest day (K6)."""

    def __init__(self, base: str):
        self.daily = SnapshotTable(f"{base}/dim_daily", ["lz_date", *DIM_COLUMNS], ["lead_cnt"])
        self.newest = LatestTable(f"{base}/dim_latest", DIM_COLUMNS, "lead_cnt",
                                  first="lz_date", last="last_day")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with _PersistedBatch(batch) as rows:
            if rows.isEmpty():
                return
            self.merge(rows, writer_of(batch.sparkSession), batch_id)

    def merge(self, rows: DataFrame, writer: str, batch_id: int) -> None:
        self.daily.merge(rows, writer, batch_id)
        self.newest.merge(metrics.dim_span(rows), writer, batch_id)

    def latest(self, spark) -> DataFrame:
        """The latest count per dimension key, as the reference's table holds it."""
        return self.newest.read(spark).drop("last_day")


BATCH_RECORD = "batch bigint, messages bigint, leads bigint, set_aside bigint, newest bigint"
RAW_OUTPUTS = ("archive", "outbox", "quarantine", "batches")


class RawSink:
    """foreachBatch sink of the raw messages: archive, outbox, quarantine, and a
    record of each batch (S4: messages read, leads, messages set aside).

    A batch is one run of each output, so replaying it replaces its own files.
    ``outputs`` picks which of them are written.
    """

    def __init__(self, base: str, compression: str | None = None,
                 outputs=RAW_OUTPUTS, **parse_options):
        unknown = set(outputs) - set(RAW_OUTPUTS)
        if unknown:
            raise ValueError(f"unknown outputs {sorted(unknown)}")
        self.outputs = tuple(outputs)
        self.archive = f"{base}/archive"
        self.outbox = f"{base}/oneid_outbox"
        self.quarantine = f"{base}/quarantine"
        self.batches = f"{base}/batches"
        self.compression = compression
        self.parse_options = parse_options

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        parsed = _parsed(batch, **self.parse_options)
        with _PersistedBatch(parsed) as rows:
            if rows.isEmpty():
                return
            run = run_name(writer_of(batch.sparkSession), batch_id)
            # The first output that is written carries the counts of the batch along.
            counts = Observation()
            seen = rows.observe(counts, F.count(F.lit(1)).alias("messages"),
                                F.count_if(F.col(REASON).isNull()).alias("leads"),
                                F.count_if(F.col(REASON).isNotNull()).alias("set_aside"),
                                F.max(F.unix_micros("ingest_ts")).alias("newest"))
            if "quarantine" in self.outputs:
                write_run(split_quarantine(seen), self.quarantine, run)
            elif "batches" in self.outputs:
                seen.write.format("noop").mode("overwrite").save()
            good = split_good(rows)
            if "archive" in self.outputs:
                write_archive(good, self.archive, run, compression=self.compression)
            if "outbox" in self.outputs:
                write_run(oneid_outbox(good, "day"), self.outbox, run)
            if "batches" in self.outputs:
                got = counts.get
                row = (int(batch_id), got["messages"], got["leads"], got["set_aside"], got["newest"])
                record = batch.sparkSession.createDataFrame([row], BATCH_RECORD)
                write_run(record.withColumn("newest", F.timestamp_micros("newest")).coalesce(1),
                          self.batches, run)

    def read_batches(self, spark: SparkSession) -> DataFrame:
        """The record of the batches, each once."""
        return read_runs(spark, self.batches)

    def compact(self, spark: SparkSession) -> int:
        """Fold the finished runs of the outputs; returns how many were folded."""
        folded = compact_archive(spark, self.archive, self.compression)
        return folded + sum(compact_runs(spark, path) for path in
                            (self.outbox, self.quarantine, self.batches))


def start(frame: DataFrame, sink, checkpoint: str, trigger: dict | None = None,
          output_mode: str = "update", name: str | None = None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start ``frame`` into a foreachBatch ``sink`` with its own checkpoint.

    ``trigger`` is a ``DataStreamWriter.trigger`` keyword dict; the default is
    the reference's 59 s interval, ``{"availableNow": True}`` runs what is
    there and stops (S6, S7).

    ``state_partitions`` sizes the state store of a new checkpoint (a
    stateful query takes it from ``spark.sql.shuffle.partitions`` at its
    first start and keeps it in the checkpoint); the session setting is
    restored once the query has started.
    """
    writer = (frame.writeStream.outputMode(output_mode).foreachBatch(sink)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or DEFAULT_TRIGGER)))
    if name:
        writer = writer.queryName(name)
    if not state_partitions:
        return writer.start()
    conf = frame.sparkSession.conf
    key = "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(int(state_partitions)))
    try:
        return writer.start()
    finally:
        conf.set(key, before)


def start_all(messages: DataFrame, base: str, trigger: dict | None = None,
              watermark: str | None = None, state_partitions: int | None = None,
              **parse_options) -> dict[str, StreamingQuery]:
    """Start the leads, raw, counters and dims queries under ``base``.

    The source is read and parsed by ``leads`` alone; the others read the table
    it writes (``base/leads``). A bounded trigger (``availableNow``) runs
    ``leads`` to its end before they start.
    """
    trigger = trigger or DEFAULT_TRIGGER
    spark = messages.sparkSession
    path = f"{base}/leads"
    parsed = leads_by_day(parsed_stream(messages, **parse_options))
    make_folder(spark, path)    # the readers may come before its first batch
    leads = (parsed.writeStream.format("parquet").outputMode("append").trigger(**trigger)
             .partitionBy(LEADS_DAY)
             .option("checkpointLocation", f"{base}/_checkpoints/leads").start(path))
    if "processingTime" not in trigger:
        leads.awaitTermination()
    stored = spark.readStream.schema(parsed.schema).parquet(path)
    return {
        "leads": leads,
        "raw": start(stored, RawSink(base), f"{base}/_checkpoints/raw",
                     trigger, output_mode="append"),
        "counters": start(counters_stream(stored, watermark),
                          CounterSink(base), f"{base}/_checkpoints/counters", trigger,
                          state_partitions=state_partitions),
        "dims": start(dims_stream(stored, watermark),
                      DimSink(base), f"{base}/_checkpoints/dims", trigger,
                      state_partitions=state_partitions),
    }
