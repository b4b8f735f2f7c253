"""Message frames for the tests."""

from pyspark.sql import functions as F


def messages(spark, values, ts="2024-03-01 10:00:00"):
    """A message frame from raw texts."""
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return df.withColumn("ingest_ts", F.to_timestamp(F.lit(ts)))
