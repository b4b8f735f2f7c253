"""The command line runs the three streaming jobs and the backfill."""

from pyspark.sql import functions as F

from leadpulse.__main__ import run
from leadpulse.operators import metrics
from leadpulse.plans.batch import leads
from leadpulse.session import scratch_dir
from leadpulse.sources.fixtures import lead_messages
from leadpulse.sources.stream import write_envelopes
from leadpulse.streaming.jobs import CounterSink, DimSink


def test_stream_command_available_now(spark, small_dir):
    base = scratch_dir(spark, "cli")
    msgs = lead_messages(spark, small_dir).filter(F.col("ingest_ts") >= "2001-07-15")
    write_envelopes(msgs, f"{base}/in")
    queries = run(["stream", "--files", f"{base}/in", "--out", f"{base}/out", "--available-now"],
                  spark=spark)
    assert set(queries) == {"leads", "raw", "counters", "dims"}
    for q in queries.values():
        q.awaitTermination()
    # the messages are read once: the other queries read the leads table
    described = {name: q.lastProgress.sources[0].description for name, q in queries.items()}
    assert [n for n, d in described.items() if f"{base}/in" in d] == ["leads"]
    assert all(f"{base}/out/leads" in d for n, d in described.items() if n != "leads")
    good = leads(spark, small_dir).filter(F.col("day") >= "2001-07-15")
    got = sorted(tuple(r) for r in CounterSink(f"{base}/out").table.read(spark).collect())
    assert got == sorted(tuple(r) for r in metrics.day_counters(good).collect())
    run(["compact", "--out", f"{base}/out"], spark=spark)
    assert sorted(tuple(r) for r in CounterSink(f"{base}/out").table.read(spark).collect()) == got
    assert DimSink(f"{base}/out").daily.read(spark).count() == metrics.dim_daily(good).count()
    assert spark.read.text(f"{base}/out/archive").count() == good.count()


def test_backfill_command(spark, small_dir):
    base = scratch_dir(spark, "clib")
    lead_messages(spark, small_dir).write.parquet(f"{base}/msgs")
    run(["backfill", "--messages", f"{base}/msgs", "--out", f"{base}/out",
         "--outputs", "counters,outbox"], spark=spark)
    got = CounterSink(f"{base}/out").table.read(spark).count()
    assert got == metrics.day_counters(leads(spark, small_dir)).count()
