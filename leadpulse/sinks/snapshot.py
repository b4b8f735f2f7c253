"""Result tables kept current by keyed writes (K5, K6, K8).

A merge only adds a run (see :mod:`leadpulse.sinks.runs`) that holds the
changed rows with their absolute values; nothing that is read is overwritten,
so a crash at any point loses no row, and the replayed merge replaces its own
run. Reading folds the runs: within a writer the last batch of a key holds,
and the writers' counts (history by a backfill, the rest by a stream, a
stream continued on a new checkpoint) add up. :meth:`SnapshotTable.compact`
bounds the number of runs a reader folds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.sinks.runs import FOLD, RUN, delete_runs, finished, run_name, write_run

WRITER, BATCH = "_writer", "_batch"
AUDIT = ("create_time", "update_time")


class SnapshotTable:
    """A keyed table of counts at ``path``: ``keys`` are unique, ``amounts`` add up
    over writers."""

    def __init__(self, path: str, keys: Sequence[str], amounts: Sequence[str]):
        self.path = path
        self.keys = list(keys)
        self.amounts = list(amounts)

    def merge(self, changes: DataFrame, writer: str, batch_id: int) -> None:
        """Add the changed rows of one batch (absolute values of their writer)."""
        now = F.current_timestamp()
        rows = changes.select(*self.keys, *self._stored(), F.lit(writer).alias(WRITER),
                              F.lit(int(batch_id)).cast("bigint").alias(BATCH),
                              now.alias("create_time"), now.alias("update_time"))
        # Changed rows of an aggregate, not leads: few files, however many
        # tasks made them.
        write_run(rows.hint("rebalance"), self.path, run_name(writer, batch_id))

    def read(self, spark: SparkSession, audit: bool = False) -> DataFrame:
        """The table's rows (with ``create_time`` and ``update_time`` if asked)."""
        rows = self._over_writers(self._last(self._runs(spark)))
        return rows if audit else rows.drop(*AUDIT)

    def missing(self, whole: DataFrame, writers: str) -> DataFrame:
        """What the writers whose names match a pattern lack of ``whole``'s counts."""
        try:
            runs = self._runs(whole.sparkSession).filter(F.col(WRITER).rlike(writers))
        except FileNotFoundError:  # nothing was written yet
            return whole.select(*self.keys, *self.amounts)
        held = self._over_writers(self._last(runs)).select(
            *self.keys, *[F.col(c).alias(f"_held_{c}") for c in self.amounts])
        lack = {c: F.col(c) - F.coalesce(f"_held_{c}", F.lit(0)) for c in self.amounts}
        rows = whole.join(held, self.keys, "left").select(
            *self.keys, *[lack[c].alias(c) for c in self.amounts])
        return rows.filter(F.greatest(*self.amounts, F.lit(0)) > 0)

    def compact(self, spark: SparkSession) -> int:
        """Fold the finished runs into one and delete them; returns how many were folded.

        A writer's newest run may still be being written and is left alone.
        The folded rows keep their writer and batch, so that rows read twice
        (after a crash between the write and the last delete, or when a batch
        is replayed) are the same rows and change nothing. Readers that
        listed the old files meanwhile have to read again.
        """
        found = self._runs(spark)
        # One short text per run; compaction is what bounds their number.
        names = finished([r[0] for r in found.select(RUN).distinct().collect()])
        if len(names) > 1:
            write_run(self._last(found.filter(F.col(RUN).isin(names))), self.path,
                      f"{FOLD}-{uuid.uuid4().hex}")
            delete_runs(spark, self.path, names)
            return len(names)
        return 0

    def _runs(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise  # not the same as a table that does not exist yet
            raise FileNotFoundError(self.path) from error

    def _stored(self) -> list[str]:
        return self.amounts

    def _audit(self) -> list:
        """K8: the first write of a key, and its last one."""
        return [F.min("create_time").alias("create_time"),
                F.max("update_time").alias("update_time")]

    def _last(self, rows: DataFrame) -> DataFrame:
        """Per writer and key the row of the last batch."""
        return rows.groupBy(*self.keys, WRITER).agg(
            *[F.max_by(c, BATCH).alias(c) for c in self.amounts],
            F.max(BATCH).alias(BATCH), *self._audit())

    def _over_writers(self, last: DataFrame) -> DataFrame:
        return last.groupBy(*self.keys).agg(
            *[F.sum(c).alias(c) for c in self.amounts], *self._audit())


class LatestTable(SnapshotTable):
    """The count of each key's latest day (K6): ``first`` stays the day a key was
    first seen, ``last`` is its latest day, whichever order the days arrive in."""

    def __init__(self, path: str, keys: Sequence[str], amount: str, first: str, last: str):
        super().__init__(path, keys, [amount])
        self.first, self.last = first, last

    def _stored(self) -> list[str]:
        return [*self.amounts, self.first, self.last]

    def _last(self, rows: DataFrame) -> DataFrame:
        newest = F.struct(self.last, BATCH)
        return rows.groupBy(*self.keys, WRITER).agg(
            F.max_by(self.amounts[0], newest).alias(self.amounts[0]),
            F.max(newest).alias("_newest"), F.min(self.first).alias(self.first), *self._audit(),
        ).select("*", f"_newest.{self.last}", f"_newest.{BATCH}").drop("_newest")

    def _over_writers(self, last: DataFrame) -> DataFrame:
        # Writers that share a key's latest day add up; older days are history.
        by_day = last.groupBy(*self.keys, self.last).agg(
            F.sum(self.amounts[0]).alias(self.amounts[0]),
            F.min(self.first).alias(self.first), *self._audit())
        return by_day.groupBy(*self.keys).agg(
            F.min(self.first).alias(self.first), F.max(self.last).alias(self.last),
            F.max_by(self.amounts[0], self.last).alias(self.amounts[0]), *self._audit())
