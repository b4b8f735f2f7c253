"""Day-partitioned text archive of lead lines (K1-K4).

``dt=yyyy-MM-dd/run=<writer>-<batch>/`` directories under a base path (see
:mod:`leadpulse.sinks.runs`), one line per lead. Spark's commit protocol keeps
a retried task from duplicating a line, and a replayed batch replaces its own
files. Writers are parallel by default; a day that holds most of the leads is
split over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.functions.dates import date_text
from leadpulse.operators.lines import line_of
from leadpulse.sinks.runs import compact_runs, read_runs, write_run

# --- fixed value: the archive's key/value separator and empty value ----------
LEGACY_SUFFIX = "\t "
# -----------------------------------------------------------------------------


def archive_lines(leads: DataFrame, dt_col: str = "day", legacy_suffix: bool = False) -> DataFrame:
    """``value, dt``: the line of each lead and its day as ``yyyy-MM-dd``."""
    line = line_of()
    if legacy_suffix:
        line = F.concat(line, F.lit(LEGACY_SUFFIX))
    return leads.select(line.alias("value"), date_text(F.col(dt_col)).alias("dt"))


def write_archive(leads: DataFrame, path: str, run: str, dt_col: str = "day",
                  compression: str | None = None, single_file: bool = False,
                  legacy_suffix: bool = False) -> None:
    """Write lead lines under ``path/dt=.../run=.../``.

    ``run`` (:func:`leadpulse.sinks.runs.run_name`) names the write; writing it
    again replaces its files.
    ``compression`` (for example ``"gzip"``) compresses the files (K3).
    ``single_file`` gives each folder one file a write (K2): all lines of a day go to
    one task, different days to several. A busy day is not split, so it is off by default.

    The lines are rebalanced by day, so that a day's lines of one write lie in
    few files; AQE merges small days and splits a busy one. One pass, no sampling.
    """
    out = archive_lines(leads, dt_col, legacy_suffix)
    out = out.repartition("dt") if single_file else out.hint("rebalance", "dt")
    options = {"compression": compression} if compression else {}
    write_run(out, path, run, "dt", fmt="text", **options)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``value, dt, run``; filters on ``dt`` prune directories."""
    return read_runs(spark, path, "dt", fmt="text")


def compact_archive(spark: SparkSession, path: str, compression: str | None = None) -> int:
    """Fold each day's finished runs into one of few files; returns how many were folded."""
    options = {"compression": compression} if compression else {}
    return compact_runs(spark, path, "dt", fmt="text", **options)


def archive_counts(archive: DataFrame) -> DataFrame:
    """Lines per day of an archive."""
    return archive.groupBy("dt").agg(F.count(F.lit(1)).alias("lines"))


def recheck(archive: DataFrame, counts: DataFrame) -> DataFrame:
    """Days whose lines need another look: ``dt, counted, recorded, lines``.

    ``counts`` (a row per day) has what the leads count and what a record says of the
    archive. Only the folders of the days where they differ are read (dynamic partition
    pruning by the small side, which holds at most a row per day).
    """
    differ = counts.where(F.col("counted") != F.col("recorded"))
    lines = archive.join(F.broadcast(differ.select("dt")), "dt").groupBy("dt").agg(
        F.count(F.lit(1)).alias("lines"))
    return differ.join(lines, "dt", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))
