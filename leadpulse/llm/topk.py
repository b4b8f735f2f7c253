"""Exact top-k inner-product search by pivot-table elimination.

Vectors become integers, floor(scale * x). A table holds each vector's angles to
many pivots. Angles are a distance: for a query q and a candidate x the largest
|a(q, p) - a(x, p)| over the pivots is a lower bound of the angle between them, hence

    q.x = |q| |x| cos a(q, x)  <=  |q| |x| cos(bound)

Candidates are evaluated in the order of this upper bound of the score, until
no bound reaches the k-th best score found. The result is exact.

A vector's cell is its nearest pivot. A query first meets its own cell, which gives
it a k-th score to beat. Every cell has the smallest and the largest angle of its
vectors to each pivot, and its longest vector; the query then meets the other cells
whose bound reaches that score, and no others. Cells of many vectors are cut into
blocks, so a task holds a block of queries and a block of candidates.

Defined cases: a vector that is null, holds a null or a non-finite component,
or has no id takes no part. Rows that share an id are vectors of their own: each that
is a query has its own ranks, and leaves out itself alone. A query sees only
candidates of its own dimension. Ties go to the smaller id. An empty table gives no
rows. Scores beyond a long are clipped to its range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadpulse.llm.common import prepare, stage

K = 10
SCALE = 1024
PIVOTS = 256
PIVOT_SAMPLE = 1024  # vectors from which the pivots are chosen
BLOCK = 4096         # most candidates, and most queries, in a task on average
CHUNK = 256          # candidates evaluated between two looks at the bound
WIDE = 1 << 24       # beyond it, sums of products may leave a long
STEPS = 65535        # an angle in the table is a whole number of steps, of which pi has so many
SLACK = 3            # steps by which rounding may move the difference of two angles


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col(vec_col)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    rows = df.where(v.isNotNull() & F.col(id_col).isNotNull() & usable)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))


def matrix(rows, kind) -> np.ndarray:
    """Rows of equal length, which may be 0, as a matrix."""
    rows = list(rows)
    return np.array([np.asarray(r, dtype=kind) for r in rows]).reshape(len(rows), len(rows[0]))


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and the lengths. What has no length keeps it."""
    lengths = np.linalg.norm(vectors, axis=1)
    return vectors / np.maximum(lengths, 1e-300)[:, None], lengths


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """n directions far from one another: each next one maximizes the distance to
    those chosen."""
    sample, lengths = directions(sample)
    sample = sample[lengths > 0]
    if not len(sample):
        return sample
    chosen = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 1e-9:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def pivot_angles(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles to the pivots, in steps, and the vectors' lengths. A vector of no length is at
    right angles to all."""
    units, lengths = directions(vectors)
    angles = np.arccos(np.clip(units @ pivots.T, -1, 1))
    return np.floor(angles * (STEPS / math.pi)).astype(np.uint16), lengths


def bounds(gap: np.ndarray, lengths: np.ndarray, length: float) -> np.ndarray:
    """Upper bounds of the scores at angles of at least ``gap`` steps."""
    angle = np.maximum(gap.astype(float) - SLACK, 0) * (math.pi / STEPS)
    top = length * lengths * np.cos(np.minimum(angle, math.pi))
    return top + 1 + 1e-9 * length * lengths


def search_block(queries: tuple, candidates: tuple, k: int, tally: list | None = None
                 ) -> Iterator[tuple]:
    """(query row, query id, candidate, score): the k best of a block for each query.

    ``queries`` is (row, id, vectors, angles, lengths, score to reach), ``candidates`` the
    same without the last. ``tally`` gets the number of candidates evaluated per query.
    """
    q_row, q_id, q, q_angles, q_lengths, to_reach = queries
    x_row, x_id, x, x_angles, x_lengths = candidates
    wide = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) > WIDE
    exact_q, exact_x = (q.astype(object), x.astype(object)) if wide else (q, x)
    x_angles = x_angles.astype(np.int32)
    for i in range(len(q_row)):
        gap = (np.abs(x_angles - q_angles[i].astype(np.int32)).max(axis=1) if x_angles.shape[1]
               else np.zeros(len(x_row)))
        bound = bounds(gap, x_lengths, q_lengths[i])
        order = np.argsort(-bound, kind="stable")
        best: list[tuple] = []
        least, seen = to_reach[i], 0
        for at in range(0, len(order), CHUNK):
            if bound[order[at]] < least:
                break
            chunk = order[at:at + CHUNK]
            chunk = chunk[(x_row[chunk] != q_row[i]) & (bound[chunk] >= least)]
            seen += len(chunk)
            scores = exact_x[chunk] @ exact_q[i]
            best = sorted(best + list(zip((-scores).tolist(), x_id[chunk].tolist())))[:k]
            if len(best) == k:
                least = max(least, -best[-1][0])
        if tally is not None:
            tally.append(seen)
        for minus, vec in best:
            yield int(q_row[i]), int(q_id[i]), int(vec), max(-(1 << 63), min(-minus, (1 << 63) - 1))


def _block(frame: pd.DataFrame) -> tuple:
    return (frame.row.to_numpy(), frame.vec_id.to_numpy(), matrix(frame.v, np.int64),
            matrix([np.frombuffer(a, np.uint16) for a in frame.angles], np.uint16),
            frame.length.to_numpy())


class Cells:
    """What is known of the cells of one dimension: arrays by cell."""

    def __init__(self, rows):
        self.cell = np.array([r.cell for r in rows])
        self.low, self.high = (np.array([np.frombuffer(r[c], np.uint16) for r in rows], np.int32)
                               for c in ("low", "high"))
        self.length = np.array([r.length for r in rows])

    def worth(self, angles: np.ndarray, length: float, score: float) -> np.ndarray:
        """Cells that may hold a score as good as ``score``."""
        a = angles.astype(np.int32)
        gap = np.maximum(np.maximum(self.low - a, a - self.high), 0).max(axis=1, initial=0)
        return self.cell[bounds(gap, self.length, length) >= score]


FOUND = "row long, query_id long, vec_id long, score long"
MEASURED = "row long, vec_id long, v array<long>, dim int, angles binary, length double, cell int"


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = K,
          pivots: int = PIVOTS) -> DataFrame:
    """Best ``k`` candidates of every query: query_id, rank, vec_id, score.

    ``vectors`` has (vec_id, v array<long>).
    """
    prepare(spark)
    vectors = stage(spark, vectors.select("vec_id", "v", F.size("v").alias("dim"),
                                          F.monotonically_increasing_id().alias("row")), "vectors")
    sample = (vectors.orderBy(F.xxhash64("row"), "row").limit(PIVOT_SAMPLE)
              .select("dim", "v").collect())
    by_dim = {dim: choose_pivots(matrix([r.v for r in sample if r.dim == dim], float), pivots)
              for dim in {r.dim for r in sample}}

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                v = matrix(part.v, float)
                known = by_dim[dim] if dim in by_dim else np.empty((0, v.shape[1]))
                angles, lengths = pivot_angles(v, known)
                cell = angles.argmin(axis=1) if len(known) else np.zeros(len(v), int)
                yield part.assign(angles=[a.tobytes() for a in angles], length=lengths, cell=cell)

    measured = stage(spark, vectors.mapInPandas(measure, MEASURED), "pivot-table")

    def span(frame: pd.DataFrame) -> tuple:
        lows, highs = (matrix([np.frombuffer(a, np.uint16) for a in frame[c]], np.uint16)
                       for c in ("low", "high"))
        return lows.min(axis=0).tobytes(), highs.max(axis=0).tobytes(), frame.length.max()

    def spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.assign(low=frame.angles, high=frame.angles)
            rows = [(*key, *span(part), len(part)) for key, part in frame.groupby(["dim", "cell"])]
            yield pd.DataFrame(rows, columns=["dim", "cell", "low", "high", "length", "n"])

    def joined(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *span(frame), frame.n.sum())],
                            columns=["dim", "cell", "low", "high", "length", "n"])

    summary = "dim int, cell int, low binary, high binary, length double, n long"
    # One row per cell: at most as many as pivots per dimension of the sample, and one
    # for any other dimension.
    cells = stage(spark, measured.select("dim", "cell", "angles", "length").mapInPandas(spans, summary)
                  .groupBy("dim", "cell").applyInPandas(joined, summary), "cells")
    known = [r for r in cells.where(F.col("dim").isin(list(by_dim))).collect()]
    table = {dim: Cells([r for r in known if r.dim == dim]) for dim in by_dim}
    blocks = cells.select("dim", "cell", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    queries = measured.where(is_query)
    q_blocks = F.lit(max(math.ceil(queries.count() / BLOCK), 1)).cast("long")
    row_hash = F.xxhash64("row")
    # Both sides: a block of a cell meets each block of queries.
    right = (measured.join(blocks, ["dim", "cell"])
             .withColumn("block", F.pmod(row_hash, F.col("blocks")))
             .withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), q_blocks - 1))))
    group = ["dim", "cell", "q_block", "block"]

    def meet(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        rows: list = []
        if len(qs) and len(xs):
            rows = list(search_block((*_block(qs), qs.to_reach.to_numpy()), _block(xs), k))
        return pd.DataFrame(rows, columns=["row", "query_id", "vec_id", "score"]).astype("int64")

    def search(asked: DataFrame) -> DataFrame:
        left = (asked.join(blocks, ["dim", "cell"]).withColumn("q_block", F.pmod(row_hash, q_blocks))
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
        left = left.toDF(*left.columns)  # columns of its own: both sides come from one table
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(meet, FOUND)

    anything = F.lit(float("-inf"))
    near = stage(spark, search(queries.withColumn("to_reach", anything)), "near")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    reached = ranked.where(F.col("rank") == k).select("row", F.col("score").cast("double")
                                                      .alias("to_reach"))

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cell = []
            for dim, own, angles, length, least in zip(frame.dim, frame.cell, frame.angles,
                                                       frame.length, frame.to_reach):
                worth = (table[dim].worth(np.frombuffer(angles, np.uint16), length, least)
                         if dim in table else np.empty(0, int))
                cell.append(worth[worth != own])
            yield frame.assign(cell=cell).explode("cell").dropna(subset="cell").astype({"cell": "int"})

    asked = queries.join(reached, "row", "left").fillna(float("-inf"), "to_reach")
    asked = asked.select(*[c.split()[0] for c in MEASURED.split(", ")], "to_reach")
    far = search(stage(spark, asked.mapInPandas(route, MEASURED + ", to_reach double"), "routes"))
    return (ranked.drop("rank").unionByName(far).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
