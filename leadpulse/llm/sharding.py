"""Reproducible shuffle into shards by a Feistel permutation.

Rows have a global number, in the order of ids. A balanced Feistel network on
the smallest even number of bits that holds the row count permutes them; a
value beyond the count walks on along its cycle until it falls below. The
position in the shuffle then gives the shard and the slot by division, so both
can be computed for any row number, and the row number for any shard and slot,
without a table.

Law: ``rows``, the shards' counts are at most one apart.

Defined cases: a null text has no bytes and the CRC of none. Rows of equal id
are ordered by size and CRC; rows without an id come first. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm.common import row_numbers, stage

SHARDS = 24
SEED = 1
ROUNDS = 6
OVERHEAD = 8  # bytes that a document takes beside its text


class Permutation:
    """Permutation of 0 .. n - 1."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        with np.errstate(over="ignore"):
            steps = np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            self.keys = self._hash(steps + np.uint64(seed))

    @staticmethod
    def _hash(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        return self._hash(x ^ key) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x, dtype=np.uint64))
        while (out := x >= np.uint64(self.n)).any():
            x[out] = step(x[out])
        return x.astype(np.int64)

    def position(self, row: np.ndarray) -> np.ndarray:
        """Where a row number stands in the shuffle."""
        return self._walk(row, self._once)

    def row(self, position: np.ndarray) -> np.ndarray:
        """The row number at a position of the shuffle."""
        return self._walk(position, self._back)


def place(row: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple:
    """(shard, slot) of row numbers among n rows."""
    at = Permutation(n, seed).position(row)
    return at % shards, at // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """Row number of a shard's slot."""
    return int(Permutation(n, seed).row(np.array([slot * shards + shard]))[0])


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS,
                    seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stage(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                    (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
                                    F.crc32(raw).alias("text_crc32")), "shard-rows")
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "size", "text_crc32")]
    numbered = row_numbers(spark, rows, order, "shard-order")
    n = rows.count()

    @F.pandas_udf("long")
    def position(row: pd.Series) -> pd.Series:
        return pd.Series(Permutation(n, seed).position(row.to_numpy()))

    at = numbered.withColumn("position", position("row"))
    return at.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                     (F.col("position") % shards).cast("int").alias("shard"),
                     F.expr(f"position div {shards}").alias("slot"),
                     F.lit(None).cast("int").alias("grown_shard"), "row")
