"""Mix sources to target weights by pivotal dependent rounding.

Each source has a target in words, so each of its documents has the same copy
count target / source size. Its whole part is taken at once. The rest is a
probability, and a pivotal pass rounds these: two documents exchange words of
expected copies at random, in a way that keeps both expectations and the sum,
until one of them is integral. Groups of a source are rounded in tasks of their
own; each leaves at most one fractional document, and these residuals meet in
the next level of a reduction tree, until one group per source is left. That
last group ends the rounding and then flips documents, largest first, to take
up the error that its last fractional document leaves.

Random numbers are hashes of a seed and of the document, so reruns agree.

Defined cases: a null text has size 0; a document of size 0 is never taken. A
null source is a source, last in order. Rows of equal id, source and text are
items of their own. Sources without words have the target 0. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadpulse.llm.common import WORD, free_name, prepare, row_numbers, stage

WEIGHTS = (5, 2, 1)  # by code point of the source, repeating, null last
MOST = 3.0           # a target is at most so many times its source's size
SHARE = 1.0          # the targets' share of all words
LEAF = 2000          # documents that one pivotal pass takes, on average
FAN = 1000           # residuals that meet in a group of the next level
SEED = 20

KEYS = ("doc_id", "source", "size", "text_hash")


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def items(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash) of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       word_count("text").alias("size"), F.xxhash64("text").alias("text_hash"))


def targets(spark: SparkSession, sized: DataFrame, weights=WEIGHTS, most: float = MOST,
            share: float = SHARE) -> DataFrame:
    """(source, source_size, docs, target).

    A target is min(most * size, level * weight), with the level at which the
    targets sum up to the share: what capped sources leave goes to the others
    by weight. Each round is one aggregation over the sources.
    """
    per_source = stage(spark, sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), "sources")
    numbered = row_numbers(spark, per_source, [F.col("source").asc_nulls_last()], "source-rows")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("row") % len(weights) + 1).cast("int"))
    sources = stage(spark, numbered.withColumn("weight", weight), "source-weights")
    cap, w = F.col("source_size") * most, F.col("weight")
    total = (sources.agg(F.sum("source_size").alias("t")).first().t or 0) * share
    level = 0.0
    while total:
        capped = cap < w * level
        row = sources.agg(F.sum(F.when(capped, cap)).alias("fixed"),
                          F.sum(F.when(~capped, w)).alias("open")).first()
        if not row.open:
            break
        raised = (total - (row.fixed or 0.0)) / row.open
        if raised <= level:
            break
        level = raised
    return sources.select("source", "source_size", "docs",
                          F.least(cap, w * level).cast("double").alias("target"))


def pivotal_pass(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Round probabilities in order; returns them, and the index of the one
    that is still fractional (-1: none). The sum of size * p stays."""
    p = p.astype(float).copy()
    at = -1
    for i in range(len(p)):
        if not 0 < p[i] < 1:
            continue
        if at < 0:
            at = i
            continue
        room, mass = (1 - p[at]) * size[at], p[at] * size[at]
        other_room, other_mass = (1 - p[i]) * size[i], p[i] * size[i]
        gain, loss = min(room, other_mass), min(mass, other_room)
        if u[i] * (gain + loss) < loss:
            first, second = mass + gain, other_mass - gain
            ends = (room <= other_mass, other_mass <= room)
            p[at], p[i] = (1.0 if ends[0] else first / size[at],
                           0.0 if ends[1] else second / size[i])
        else:
            first, second = mass - loss, other_mass + loss
            ends = (mass <= other_room, other_room <= mass)
            p[at], p[i] = (0.0 if ends[0] else first / size[at],
                           1.0 if ends[1] else second / size[i])
        left = [j for j, done in ((at, ends[0]), (i, ends[1])) if not done and 0 < p[j] < 1]
        at = left[0] if left else -1
    return p, at


def balance(size: np.ndarray, extra: np.ndarray, over: float) -> np.ndarray:
    """Flip whole documents, largest first, where that brings the words taken
    nearer to the target; ``over`` is how far they are above it."""
    for i in np.argsort(-size, kind="stable"):
        step = -size[i] if extra[i] else size[i]
        if abs(over + step) < abs(over):
            extra[i], over = 1 - extra[i], over + step
    return extra


def copies(spark: SparkSession, sized: DataFrame, per_source: DataFrame,
           seed: int = SEED) -> DataFrame:
    """Items with their source's size and target, and ``copies``, how often the
    mix takes each."""
    prepare(spark)
    rate = F.least(F.coalesce(F.col("target") / F.when(F.col("source_size") > 0,
                                                       F.col("source_size")), F.lit(0.0)),
                   F.lit(MOST))
    # Equal rows are counted first and told apart by a number of their own.
    alone = sized.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("twins")).withColumn(
        "twin", F.explode(F.sequence(F.lit(1), F.col("twins").cast("int"))))
    # A struct of a null equals another one, so null sources join as well.
    rows = (alone.withColumn("_s", F.struct("source")).drop("source", "twins")
            .join(per_source.withColumn("_s", F.struct("source")), "_s").drop("_s")
            .withColumns({"whole": F.floor(rate), "p": rate - F.floor(rate)})
            .withColumn("key", F.xxhash64(F.lit(seed), *KEYS, "twin"))
            .withColumn("leaf", F.pmod(F.xxhash64(F.lit(seed + 1), "key"),
                                       F.ceil(F.col("docs") / LEAF).cast("long")))
            # pandas has no long that may be null
            .withColumn("doc_id", F.col("doc_id").cast("string")))
    rows = stage(spark, rows, "mix-items")
    fields = rows.schema
    open_ = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    done = [rows.where(~open_).withColumn("extra", F.lit(0).cast("long"))]
    left = rows.where(open_)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", extra long"

    def round_group(frame: pd.DataFrame, last: bool) -> pd.DataFrame:
        frame = frame.sort_values(["key", "doc_id", "size", "twin"], na_position="first")
        size = frame["size"].to_numpy(dtype=float)
        p = frame.p.to_numpy(dtype=float)
        u = np.array([((int(k) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)) / 2.0 ** 64
                      for k in frame.key])
        q, at = pivotal_pass(size, p, u)
        if last:
            if at >= 0:
                q[at] = 1.0 if u[at] < q[at] else 0.0
            q = balance(size, q, float((q - p) @ size))
            at = -1
        extra = pd.array(np.rint(q).astype("int64"), dtype="Int64")
        if at >= 0:
            extra[at] = pd.NA
        return frame.assign(p=q, extra=extra)

    top = left.agg(F.max("leaf")).first()[0]
    while top is not None:
        # Leaf 0 waits for the residuals of all others, then ends its source.
        at_root = top == 0
        now = left if at_root else left.where(F.col("leaf") > 0)
        rounded = now.groupBy("source", "leaf").applyInPandas(
            (lambda f: round_group(f, True)) if at_root else (lambda f: round_group(f, False)),
            schema)
        rounded = stage(spark, rounded, "mix-level")
        done.append(rounded.where(F.col("extra").isNotNull()))
        if at_root:
            break
        rest = rounded.where(F.col("extra").isNull()).drop("extra").withColumn(
            "leaf", F.expr(f"leaf div {FAN}"))
        left = left.where(F.col("leaf") == 0).unionByName(rest)
        top = top // FAN
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    count = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "size",
                      "text_hash", "source_size", "target",
                      count.cast("long").alias("copies"))


def mix(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies
    and taken, the words that the mix takes."""
    sized = stage(spark, items(docs), "mix-sizes")
    counted = copies(spark, sized, targets(spark, sized, **options))
    return counted.withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: each as often as it has copies."""
    plan = mix(spark, docs, **options)
    plan = stage(spark, plan.groupBy(*KEYS).agg(F.sum("copies").alias("copies"),
                                                F.count(F.lit(1)).alias("twins")), "mix-plan")
    key, total, twins, nth, mine = (free_name(docs, f"_mix_{c}")
                                    for c in ("key", "copies", "twins", "nth", "mine"))
    # One struct as key: null parts are equal, and the join's partitions serve
    # the numbering of equal rows too.
    wanted = plan.select(F.struct(*KEYS).alias(key), F.col("copies").alias(total),
                         F.col("twins").alias(twins))
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                   F.col("source").cast("string").alias("source"),
                   word_count("text").alias("size"), F.xxhash64("text").alias("text_hash"))
    both = docs.withColumn(key, own).join(wanted, key)
    number = F.row_number().over(Window.partitionBy(key).orderBy(key))
    share = F.floor(F.col(total) / F.col(twins)) + F.when(
        F.col(nth) <= F.col(total) % F.col(twins), 1).otherwise(0)
    return (both.withColumn(nth, number).withColumn(mine, share.cast("int"))
            .where(F.col(mine) > 0)
            .withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(mine))))
            .select(*docs.columns))
