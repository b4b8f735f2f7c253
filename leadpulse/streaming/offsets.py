"""Offsets that each batch of a query read up to, from its checkpoint.

They are Spark's own; this only reads them as a table, beside the record of
batches that the sink writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def batch_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch, source, end_offset``: a row per batch and source, the offset as JSON text."""
    files = spark.read.text(f"{checkpoint}/offsets", wholetext=True)
    # A version line, a line of settings, then a line per source.
    lines = F.slice(F.split("value", "\n"), 3, 1 << 16)
    return files.select(F.col("_metadata.file_name").cast("bigint").alias("batch"),
                        F.posexplode(lines).alias("source", "end_offset"))
