"""Streaming sources of lead messages.

Every source yields the same two columns, ``value STRING, ingest_ts
TIMESTAMP``, so the parse and the counters never depend on the transport.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.schema import MESSAGE_SCHEMA


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None,
                  extra: dict | None = None) -> dict:
    """Reader options of the Kafka source.

    With no checkpoint, reading starts at ``starting_offsets`` (S2); after
    that, offsets resume from the query's checkpoint (S3). The source never
    commits offsets to the consumer group (S5).
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    options.update(extra or {})
    return options


def ingest_time(record_ts, clock: str = "record"):
    """``ingest_ts`` of a message: the record's own timestamp (default) or,
    with ``clock="processing"``, the time the micro-batch runs, which is the
    day the reference counts a lead under."""
    if clock == "record":
        return record_ts
    if clock == "processing":
        return F.current_timestamp()
    raise ValueError("clock must be 'record' or 'processing'")


def kafka_leads(spark: SparkSession, bootstrap_servers: str, topic: str,
                starting_offsets: str = "latest", clock: str = "record", **kwargs) -> DataFrame:
    """Lead messages from a Kafka topic (needs the Kafka connector jar)."""
    reader = spark.readStream.format("kafka")
    for key, value in kafka_options(bootstrap_servers, topic, starting_offsets, **kwargs).items():
        reader = reader.option(key, value)
    raw = reader.load()
    return raw.select(F.col("value").cast("string").alias("value"),
                      ingest_time(F.col("timestamp"), clock).alias("ingest_ts"))


def file_leads(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
               clock: str = "record") -> DataFrame:
    """Lead messages from JSON-line envelope files (``value``, ``ingest_ts``)."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    envelopes = reader.json(path)
    if clock == "record":
        return envelopes
    return envelopes.select("value", ingest_time(F.col("ingest_ts"), clock).alias("ingest_ts"))


def write_envelopes(messages: DataFrame, path: str) -> None:
    """Append messages as envelope files that :func:`file_leads` picks up."""
    messages.select("value", "ingest_ts").write.mode("append").json(path)
