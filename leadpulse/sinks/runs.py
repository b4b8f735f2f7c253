"""One layout for every output: the rows of one write lie under ``run=<writer>-<batch>``.

A writer is a streaming query (named by its checkpoint's query id, which is
kept across restarts and new with a new checkpoint) or a named backfill. A
write replaces the files of its own run and no others: a replayed batch or a
backfill run again leaves a table as it was, and several writers share a
table without hiding or overwriting each other's rows.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run"
FOLD = "fold"  # the writer of compacted runs
# Set by Spark on the thread that runs a micro-batch.
_QUERY_ID = "sql.streaming.queryId"
STREAM_WRITERS = "^q[0-9a-f]{32}$"  # names of writers that are streaming queries


def writer_name(query_id) -> str:
    """Writer name of a streaming query."""
    # A leading letter keeps the folder name from being read as a number.
    return "q" + str(query_id).replace("-", "")


def writer_of(spark: SparkSession) -> str:
    """Writer name of the micro-batch that runs on this thread.

    Outside a streaming query (a sink called by hand) it is ``direct``.
    """
    query_id = spark.sparkContext.getLocalProperty(_QUERY_ID)
    return writer_name(query_id) if query_id else "direct"


def run_name(writer: str, batch_id: int) -> str:
    """``<writer>-<batch>``, the folder name of one write."""
    if not writer.isidentifier() or writer == FOLD:
        raise ValueError(f"a writer is named by letters, digits and underscores: {writer!r}")
    return f"{writer}-{int(batch_id):010d}"


def finished(runs: list[str]) -> list[str]:
    """``runs`` without each writer's newest. A writer writes one run at a time."""
    newest: dict[str, str] = {}
    for run in runs:
        writer = run.rpartition("-")[0]
        newest[writer] = max(run, newest.get(writer, run))
    return [r for r in runs if r.rpartition("-")[0] == FOLD or r not in newest.values()]


def write_run(df: DataFrame, path: str, run: str, *partitions: str, fmt: str = "parquet",
              **options) -> None:
    """Write ``df`` as the rows of ``run``, replacing what this run wrote before."""
    (df.withColumn(RUN, F.lit(run)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").options(**options)
     .partitionBy(*partitions, RUN).format(fmt).save(path))


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    """Create ``path`` if it does not exist."""
    folder, files = _folder(spark, path)
    files.mkdirs(folder)


def delete_runs(spark: SparkSession, path: str, runs: list[str]) -> None:
    """Remove the folders of ``runs`` directly below ``path``."""
    for run in runs:
        folder, files = _folder(spark, f"{path}/{RUN}={run}")
        files.delete(folder, True)


# --- tables of rows (archive, outbox, quarantine, batch record) ---------------
#
# A fold of such a table holds the rows of one writer's batches first..last and
# says so in its name, ``fold-<writer>-<first>-<last>``. It is put in place by
# one rename a folder, and the runs that it covers are deleted after that. Where
# a crash comes between the two, readers leave the covered runs out.

_FOLD_NAME = re.compile(rf"{FOLD}-(?P<writer>\w+)-(?P<first>\d+)-(?P<last>\d+)")


def run_folders(spark: SparkSession, path: str, by: str | None = None) -> dict[str, list[str]]:
    """Names of the runs in ``path``, or in each of its ``by=...`` folders.

    One name per write and folder, which compaction keeps few.
    """
    below = f"{by}=*/" if by else ""
    pattern, files = _folder(spark, f"{path}/{below}{RUN}=*")
    found = defaultdict(list)
    for status in files.globStatus(pattern) or []:
        folder = status.getPath()
        parent = folder.getParent().getName() if by else ""
        found[parent].append(folder.getName().removeprefix(f"{RUN}="))
    return dict(found)


def covered(runs: list[str]) -> list[str]:
    """Those of a folder's runs whose rows a fold beside them holds."""
    folds = [m for m in map(_FOLD_NAME.fullmatch, runs) if m]

    def held(run: str) -> bool:
        writer, _, batch = run.rpartition("-")
        return any(m["writer"] == writer and m["first"] <= batch <= m["last"] for m in folds)

    return [r for r in runs if held(r)]


def _place(by: str | None):
    """The folder of a row as text, by which partitions are pruned."""
    return F.concat_ws("/", *([F.concat(F.lit(f"{by}="), F.col(by).cast("string"))] if by else []),
                       RUN)


def _place_of(folder: str, run: str) -> str:
    return f"{folder}/{run}" if folder else run


def read_runs(spark: SparkSession, path: str, by: str | None = None,
              fmt: str = "parquet") -> DataFrame:
    """The rows of all runs, each once."""
    rows = spark.read.format(fmt).load(path)
    twice = [_place_of(folder, run) for folder, runs in run_folders(spark, path, by).items()
             for run in covered(runs)]
    return rows.filter(~_place(by).isin(twice)) if twice else rows


def _drop_covered(spark: SparkSession, path: str, by: str | None) -> None:
    for folder, runs in run_folders(spark, path, by).items():
        delete_runs(spark, f"{path}/{folder}" if folder else path, covered(runs))


def compact_runs(spark: SparkSession, path: str, by: str | None = None, fmt: str = "parquet",
                 **options) -> int:
    """Fold the finished runs of each folder into one per writer; returns how many
    were folded.

    A writer's newest run may still be being written or replayed and is left
    alone, as are folds: a row is written anew once. Safe to run again after a
    crash, and beside the writers; one compaction at a time. Readers that listed
    the old files meanwhile have to read again.
    """
    _drop_covered(spark, path, by)  # of a compaction that was cut short
    folders = {folder: [r for r in runs if not _FOLD_NAME.fullmatch(r)]
               for folder, runs in run_folders(spark, path, by).items()}
    done = finished(sorted({r for runs in folders.values() for r in runs}))
    batches = defaultdict(list)
    for run in done:
        batches[run.rpartition("-")[0]].append(run)
    folded = 0
    for writer, runs in batches.items():
        # Alone in its folder, a run gains nothing from being written again.
        held = {folder: mine for folder, every in folders.items()
                if len(mine := [r for r in every if r in set(runs)]) > 1}
        places = [_place_of(folder, r) for folder, mine in held.items() for r in mine]
        if not places:
            continue
        first, last = (f(r for mine in held.values() for r in mine).rpartition("-")[2]
                       for f in (min, max))
        rows = spark.read.format(fmt).load(path).filter(_place(by).isin(places))
        partitions = (by,) if by else ()
        write_run(rows.hint("rebalance", *partitions), path, f"{FOLD}-{writer}-{first}-{last}",
                  *partitions, fmt=fmt, **options)
        folded += len(places)
    _drop_covered(spark, path, by)
    return folded
