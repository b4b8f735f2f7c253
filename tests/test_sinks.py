"""Archive options (K1-K4), snapshot tables (K5, K8) and the backfill."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from lead_messages import messages

from leadpulse.operators import metrics
from leadpulse.operators.parse import parse_leads
from leadpulse.plans.backfill import Backfill
from leadpulse.plans.batch import leads
from leadpulse.schema import LEAD_FIELDS
from leadpulse.session import scratch_dir
from leadpulse.sinks import runs, snapshot
from leadpulse.sinks.archive import compact_archive, read_archive, write_archive
from leadpulse.sinks.runs import compact_runs, covered, read_runs, run_name, write_run
from leadpulse.sinks.snapshot import LatestTable, SnapshotTable
from leadpulse.sources.fixtures import lead_messages
from leadpulse.streaming.jobs import CounterSink, RawSink


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def two_day_leads(spark):
    msgs = messages(spark, ['{"leadId":"a"}', '{"leadId":"b"}'], "2024-03-01 10:00:00").unionByName(
        messages(spark, ['{"leadId":"c"}'], "2024-03-02 23:59:59"))
    return parse_leads(msgs)


def test_archive_layout_gzip_single_file_and_suffix(spark):
    base = scratch_dir(spark, "k")
    path = f"{base}/gz"
    write_archive(two_day_leads(spark), path, run_name("w", 3), compression="gzip",
                  single_file=True, legacy_suffix=True)
    files = sorted(glob.glob(local(path) + "/dt=*/run=w-0000000003/*.gz"))
    assert [f.split("/")[-3] for f in files] == ["dt=2024-03-01", "dt=2024-03-02"]
    text = gzip.open(files[0], "rt").read().splitlines()
    assert sorted(text) == sorted(["a" + ";\\N" * 19 + ";lead_center\t ",
                                   "b" + ";\\N" * 19 + ";lead_center\t "])
    got = read_archive(spark, path).filter(F.col("dt") == "2024-03-02").collect()
    assert [r["value"].split(";")[0] for r in got] == ["c"]


def test_single_files_of_several_days_are_written_by_several_tasks(spark):
    path = scratch_dir(spark, "k2")
    days = [None, *(f"2024-03-{d:02d}" for d in range(1, 13))]
    leads = spark.createDataFrame([(f"{d}-{n}", d) for n in range(40) for d in days],
                                  "leadId string, day string").repartition(4).select(
        *[F.col("leadId") if n == "leadId" else F.lit(None).cast("string").alias(n) for n in LEAD_FIELDS],
        F.to_date("day").alias("day"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")                              # so little would be one partition
    try:
        write_archive(leads, path, run_name("w", 0), single_file=True)
    finally:
        spark.conf.unset(merge)
    files = glob.glob(local(path) + "/dt=*/run=w-0000000000/part-*")
    assert len(files) == len({os.path.dirname(f) for f in files}) == len(days)
    assert len({os.path.basename(f).split("-")[1] for f in files}) > 1
    got = spark.read.text(path)
    assert sorted(r["value"].split(";")[0] for r in got.collect()) == sorted(
        f"{d}-{n}" for n in range(40) for d in days)


def test_a_run_written_again_replaces_itself_alone(spark):
    path = scratch_dir(spark, "k3")
    good = two_day_leads(spark)
    for writer, batch in (("a", 7), ("a", 7), ("a", 8), ("b", 7)):
        write_archive(good, path, run_name(writer, batch))
    counts = {r["run"]: r["count"] for r in read_archive(spark, path).groupBy("run").count().collect()}
    assert counts == {"a-0000000007": 3, "a-0000000008": 3, "b-0000000007": 3}
    for name in ("a-b", "fold"):
        with pytest.raises(ValueError):
            run_name(name, 0)


def day_rows(spark, *pairs):
    return (spark.createDataFrame(list(pairs), "d string, n bigint")
            .select(F.to_date("d").alias("d"), "n"))


def values(table, spark):
    return {str(r["d"]): r["n"] for r in table.read(spark).collect()}


def test_last_batch_of_a_writer_holds_and_writers_add_up(spark):
    t = SnapshotTable(scratch_dir(spark, "snap"), ["d"], ["n"])
    with pytest.raises(FileNotFoundError):
        t.read(spark)
    t.merge(day_rows(spark, ("2024-01-05", 1), ("2024-02-05", 2)), "a", 0)
    created = {r["d"]: r["create_time"] for r in t.read(spark, audit=True).collect()}
    t.merge(day_rows(spark, ("2024-02-05", 5), ("2024-02-06", 1)), "a", 1)
    t.merge(day_rows(spark, ("2024-02-05", 10)), "b", 0)
    want = {"2024-01-05": 1, "2024-02-05": 15, "2024-02-06": 1}
    assert values(t, spark) == want
    rows = {r["d"]: r for r in t.read(spark, audit=True).collect()}
    for d, ts in created.items():
        assert rows[d]["create_time"] == ts                     # K8
    t.merge(day_rows(spark, ("2024-02-05", 10)), "b", 0)        # a replay
    assert values(t, spark) == want
    t.merge(day_rows(spark, (None, 4)), "b", 1)                 # a null key is a key
    assert values(t, spark) == {**want, "None": 4}


def test_compaction_keeps_every_key_also_when_it_is_cut_short(spark, monkeypatch):
    t = SnapshotTable(scratch_dir(spark, "fold"), ["d"], ["n"])
    for batch in range(3):
        t.merge(day_rows(spark, ("2024-02-05", batch), (f"2024-03-0{batch + 1}", 7)), "a", batch)
    t.merge(day_rows(spark, ("2024-02-05", 10)), "b", 0)
    want = values(t, spark)
    assert want["2024-02-05"] == 12
    with monkeypatch.context() as cut:                          # the deletes never run
        cut.setattr(snapshot, "delete_runs", lambda *a: None)
        t.compact(spark)
    assert values(t, spark) == want
    assert t.compact(spark) == 3                                # a-0, a-1 and the first fold
    assert values(t, spark) == want
    folders = [f for f in os.listdir(local(t.path)) if f.startswith("run=")]
    assert len(folders) == 3                                    # a-2, b-0 and the fold
    assert t.compact(spark) == 0
    t.merge(day_rows(spark, ("2024-02-05", 2), ("2024-03-03", 7)), "a", 2)   # replayed after the fold
    assert values(t, spark) == want
    t.merge(day_rows(spark, ("2024-02-05", 3)), "a", 3)
    assert values(t, spark)["2024-02-05"] == 13


def test_archive_compaction_keeps_every_line_also_when_it_is_cut_short(spark, monkeypatch):
    path = scratch_dir(spark, "archive-fold")
    good = two_day_leads(spark)
    for writer, batch in (("a", 0), ("a", 1), ("a", 10), ("a", 11), ("b", 0), ("b", 1)):
        # batch 1 of a holds one day, so that day's folder has fewer runs
        rows = good.filter(F.col("day") == "2024-03-01") if (writer, batch) == ("a", 1) else good
        write_archive(rows, path, run_name(writer, batch))

    def lines():
        return sorted((str(r["dt"]), r["value"]) for r in read_archive(spark, path).collect())

    def folders(day):
        return sorted(f[4:] for f in os.listdir(local(f"{path}/dt={day}")) if f.startswith("run="))

    want = lines()
    with monkeypatch.context() as cut:                          # the deletes never run
        cut.setattr(runs, "delete_runs", lambda *a: None)
        assert compact_archive(spark, path) == 5
    assert spark.read.text(path).count() > len(want) and lines() == want
    assert compact_archive(spark, path) == 0                    # finishes what was cut short
    assert lines() == want and spark.read.text(path).count() == len(want)
    fold = "fold-a-0000000000-0000000010"
    newest = ["a-0000000011", "b-0000000000", "b-0000000001"]
    assert folders("2024-03-01") == folders("2024-03-02") == sorted([*newest, fold])
    write_archive(good, path, run_name("a", 11))                # replayed after the fold
    assert lines() == want
    for batch in (12, 13):
        write_archive(good, path, run_name("a", batch))
    assert compact_archive(spark, path) == 4
    assert len(lines()) == len(want) + 6
    assert folders("2024-03-01")[-2:] == [fold, "fold-a-0000000011-0000000012"]


def test_compaction_of_a_flat_table_and_of_none(spark):
    path = scratch_dir(spark, "flat-fold")
    assert compact_runs(spark, path) == 0
    for batch in range(4):
        write_run(spark.range(batch, batch + 2), path, run_name("w", batch))
    write_run(spark.range(100, 103), path, run_name("w_2", 0))  # a name that begins alike
    want = sorted(r.id for r in read_runs(spark, path).collect())
    assert compact_runs(spark, path) == 3
    assert sorted(r.id for r in read_runs(spark, path).collect()) == want
    assert covered(["fold-w-0000000000-0000000002", "w-0000000002", "w-0000000003",
                    "w_2-0000000001"]) == ["w-0000000002"]


def test_a_failed_merge_and_its_replay_lose_no_key(spark):
    t = SnapshotTable(scratch_dir(spark, "crash"), ["d"], ["n"])
    t.merge(day_rows(spark, ("2024-01-05", 1), ("2024-02-05", 2)), "a", 0)
    change = day_rows(spark, ("2024-01-05", 8), ("2024-02-05", 9))
    broken = change.withColumn("n", F.when(F.col("d") == "2024-02-05", F.raise_error(F.lit("lost")))
                               .otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        t.merge(broken, "a", 1)
    assert values(t, spark) == {"2024-01-05": 1, "2024-02-05": 2}
    t.merge(change, "a", 1)
    assert values(t, spark) == {"2024-01-05": 8, "2024-02-05": 9}


def test_latest_table_in_any_order_and_over_writers(spark):
    rows = [("k", "2024-01-02", 4, "a", 0), ("k", "2024-01-05", 6, "a", 1), ("k", "2024-01-01", 9, "a", 2),
            ("k", "2024-01-05", 7, "a", 3), ("k", "2024-01-05", 1, "b", 0), ("j", "2024-01-03", 2, "b", 1)]
    want = {("k", "2024-01-01", "2024-01-05", 8), ("j", "2024-01-03", "2024-01-03", 2)}
    for order in (rows, rows[::-1]):
        t = LatestTable(scratch_dir(spark, "latest"), ["key"], "n", first="first", last="last")
        for key, day, n, writer, batch in order:
            change = (spark.createDataFrame([(key, day, n)], "key string, day string, n bigint")
                      .select("key", F.to_date("day").alias("first"), F.to_date("day").alias("last"), "n"))
            t.merge(change, writer, batch)
        for _ in range(2):
            got = {(r["key"], str(r["first"]), str(r["last"]), r["n"]) for r in t.read(spark).collect()}
            assert got == want
            t.compact(spark)


def test_backfill_twice_is_backfill_once_also_beside_a_stream(spark):
    base = scratch_dir(spark, "twice")
    good = ['{"leadId":"a","createTime":"2024-03-01 01:00:00"}', '{"leadId":']
    job = Backfill(base)
    stream = RawSink(base)
    stream(messages(spark, good, "2024-03-01 20:00:00"), 0)
    CounterSink(base)(metrics.day_counters(parse_leads(messages(spark, good, "2024-03-01 20:00:00"))), 0)
    for _ in range(2):
        job.run(messages(spark, good, "2024-03-01 10:00:00"))
        Backfill(base, "more").run(messages(spark, good, "2024-03-01 11:00:00"))
        assert spark.read.parquet(job.outbox).count() == 3
        assert spark.read.parquet(job.quarantine).count() == 3
        assert read_archive(spark, job.archive).count() == 3
        assert [tuple(r)[1:] for r in job.counters.table.read(spark).collect()] == [(3, 0, 0)]


def test_backfill_equals_batch_and_quarantine(spark, small_dir):
    job = Backfill(scratch_dir(spark, "bf"))
    job.run(lead_messages(spark, small_dir, "truncated"), ["quarantine", "counters", "dims", "outbox"])
    good = leads(spark, small_dir, "truncated")
    want = sorted(tuple(r) for r in metrics.day_counters(good).collect())
    assert sorted(tuple(r) for r in job.counters.table.read(spark).collect()) == want
    assert job.dims.daily.read(spark).count() == metrics.dim_daily(good).count()
    n_bad = spark.read.parquet(job.quarantine).count()
    assert n_bad > 0 and n_bad + good.count() == lead_messages(spark, small_dir).count()
    # the typed table keeps raw text only for the messages set aside
    raw = spark.read.parquet(job.parsed).filter(F.col("value").isNotNull()).count()
    assert raw == n_bad
