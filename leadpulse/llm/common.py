"""Helpers shared by the corpus operators: staged tables, global row numbers
and connected components, all of which run as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadpulse.session import scratch_dir

# Rows that one Arrow batch hands to Python. Texts can be long, so the batch is
# far smaller than Spark's default of 10,000 rows.
BATCH_ROWS = 256

# White space that separates words in every operator here.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session to ``BATCH_ROWS`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts lineage: a lost executor costs a reread, not a recomputation.
    """
    path = scratch_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it where ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_numbers(spark: SparkSession, df: DataFrame, order: list[Column], name: str,
                out: str = "row", ranges: list[Column] | None = None) -> DataFrame:
    """``df`` with the 0-based global row number in ascending ``order``.

    One range shuffle and one sort per range; the numbers come from the counts
    of the ranges, of which there is one row per partition. ``df`` should be a
    staged table, as range partitioning reads it twice. ``ranges`` are coarser
    columns of the same order to cut the ranges by, where values may be long.
    """
    ranged = (df.repartitionByRange(*(ranges or order)).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    kept = stage(spark, ranged, name)
    part = F.shiftright("_at", 33)
    counts = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    # One row per range partition: its size is bounded by the partition count.
    joined = kept.withColumn("_part", part).join(F.broadcast(starts), "_part")
    index = F.col("_at") - F.shiftleft(F.col("_part"), 33)
    return joined.withColumn(out, F.col("_from") + index).drop("_at", "_part", "_from")


def components(spark: SparkSession, links: DataFrame, name: str) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b: long): the smallest node
    that it reaches.

    Alternating large-star and small-star rounds on edges from the larger to
    the smaller end. Each round hangs nodes on the smallest neighbour of their
    neighbour, until all edges are those of stars. Per round, minima are partial
    aggregates, and the joins read staged tables, so that Spark can split a hub.
    """
    a, b = F.col("a"), F.col("b")
    edges = stage(spark, links.where(a != b).select(F.greatest(a, b).alias("u"),
                                                    F.least(a, b).alias("v")).distinct(),
                  f"{name}-edges")
    while not _stars(edges):
        low = _lowest(spark, edges, name)
        hung = edges.join(low.withColumnRenamed("u", "v"), "v", "left").select(
            "u", F.coalesce("m", "v").alias("v")).distinct()
        hung = stage(spark, hung, f"{name}-large")
        low = _lowest(spark, hung, name)
        met = hung.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v")).distinct()
        edges = stage(spark, met, f"{name}-small")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _lowest(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    return stage(spark, edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}-low")


def _stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other, which itself hangs on none."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs"),
                                      F.lit(0).alias("holds")),
                             F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs"),
                                      F.lit(1).alias("holds"))))
    nodes = edges.select(ends.alias("end")).groupBy("end.node").agg(
        F.sum("end.hangs").alias("hangs"), F.max("end.holds").alias("holds"))
    return nodes.where((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("holds") > 0))
                       ).isEmpty()
