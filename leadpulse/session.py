"""Session defaults and the shared scratch location.

Every path the library writes on its own (streaming checkpoints, fixture
slices, snapshot tables of the registered queries) lives under the cluster's
shared checkpoint folder, read from ``spark.checkpoint.dir``. Only a session
that has none (a local test run) gets a fresh folder of its own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings for a cluster run. Shuffle partitions start high and AQE coalesces
# them to ``advisoryPartitionSizeInBytes``; skewed join partitions are split.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Many (day x dimension) keys: keep streaming state off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit one changelog file per partition and batch, not a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Micro-batches without state are re-planned by size as well.
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "leadpulse",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from ``spark.checkpoint.dir`` (or a folder already set on the
    context). When neither exists, a local session gets a new folder, which is
    set, so ``DataFrame.checkpoint()`` works as well. On a cluster a local
    folder would be another one on each machine, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="leadpulse-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/leadpulse/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, wherever they run: a zip of its modules goes to
    them as a Spark file, once per application. ``--py-files`` does the same."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="leadpulse-ship-"), "leadpulse.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(package):
            for name in sorted(f for f in files if f.endswith(".py")):
                file = os.path.join(folder, name)
                out.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
