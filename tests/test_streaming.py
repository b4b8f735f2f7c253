"""Streaming runs: equal to batch, restart, replay, late data, ledger."""

from pyspark.sql import functions as F

from leadpulse.operators import metrics
from leadpulse.plans.batch import leads
from leadpulse.plans.streams import ONCE, replay
from leadpulse.session import scratch_dir
from leadpulse.sources.fixtures import SLICE_CUTS, lead_messages
from leadpulse.sources.stream import file_leads, kafka_options, write_envelopes
from leadpulse.streaming import jobs
from leadpulse.streaming.recount import recount, stored_leads


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def too_late(progress):
    """Rows that a batch dropped behind the watermark."""
    return sum(int(o.numRowsDroppedByWatermark) for o in progress.stateOperators)


def test_counters_stream_equals_batch_and_survives_restarts(spark, small_dir):
    holder = {}

    def run(src, base):
        holder.setdefault("sink", jobs.CounterSink(base))
        return jobs.start(jobs.counters_stream(src), holder["sink"], f"{base}/_ckpt", ONCE)

    base, progress = replay(spark, small_dir, run)
    batch = metrics.split_counters(metrics.day_counters(leads(spark, small_dir)))
    for name, view in holder["sink"].views(spark).items():
        assert rows(view) == rows(batch[name])
    read = [p for p in progress if p.numInputRows]
    assert len(read) == 3                                      # one data batch per restart
    assert sum(map(too_late, read)) == 0
    assert sum(p.numInputRows for p in read) == lead_messages(spark, small_dir).count()


def test_replayed_batch_changes_nothing(spark, small_dir):
    base = scratch_dir(spark, "replay")
    sink = jobs.DimSink(base)
    batch = metrics.dim_daily(leads(spark, small_dir))
    sink(batch, 0)
    first = rows(sink.daily.read(spark))
    sink(batch, 0)
    assert rows(sink.daily.read(spark)) == first
    assert len(first) == batch.count()


def test_late_slices_are_dropped_behind_the_watermark(spark, small_dir):
    holder = {}

    def run(src, base):
        holder.setdefault("sink", jobs.CounterSink(base))
        return jobs.start(jobs.counters_stream(src, watermark="1 day"), holder["sink"],
                          f"{base}/_ckpt", ONCE)

    _, progress = replay(spark, small_dir, run, reverse=True, name="late")
    dropped = [too_late(p) for p in progress if p.numInputRows]
    assert dropped[0] == 0 and all(n > 0 for n in dropped[1:])
    got = holder["sink"].views(spark)["total"]
    newest = metrics.total_daily(leads(spark, small_dir)).filter(F.col("clue_dt") >= SLICE_CUTS[-1])
    assert rows(got) == rows(newest)


def test_recount_adds_the_late_leads_and_no_more(spark, small_dir):
    base = scratch_dir(spark, "recount")
    msgs = lead_messages(spark, small_dir)
    jobs.leads_by_day(jobs.parsed_stream(msgs)).write.parquet(f"{base}/leads")
    counters, dims = jobs.CounterSink(base), jobs.DimSink(base)
    msgs.write.parquet(f"{base}/messages")
    msgs = spark.read.parquet(f"{base}/messages")
    for late in (False, True):
        old = F.col("ingest_ts") < SLICE_CUTS[-1]
        write_envelopes(msgs.filter(old if late else ~old), f"{base}/in")
        for make, sink in ((jobs.counters_stream, counters), (jobs.dims_stream, dims)):
            jobs.start(make(file_leads(spark, f"{base}/in"), watermark="1 day"), sink,
                       f"{base}/{make.__name__}", ONCE).awaitTermination()
    good = leads(spark, small_dir)
    days = metrics.day_counters(good)
    newest = rows(days.filter(F.col("day") >= SLICE_CUTS[-1]))
    assert rows(counters.table.read(spark)) == newest
    # history by another writer, which a recount leaves alone
    counters.merge(days.limit(1).select("day", *[F.lit(100).cast("long").alias(c)
                                                 for c in ("total", "hq", "dealer")]), "backfill", 0)
    for before in ("1998-01-01", SLICE_CUTS[-1], SLICE_CUTS[-1]):
        recount(spark, base, before)
    own = counters.table.missing(days, "^backfill$").count()
    assert own == days.count() - 1                              # small days lack, the added one not
    total = counters.table.read(spark).agg(F.sum("total")).first()[0]
    assert total == good.count() + 100
    assert rows(dims.daily.read(spark)) == rows(metrics.dim_daily(good))
    assert rows(dims.latest(spark)) == rows(metrics.dim_latest(metrics.dim_daily(good)))


def test_no_watermark_keeps_late_rows(spark, small_dir):
    holder = {}

    def run(src, base):
        holder.setdefault("sink", jobs.CounterSink(base))
        return jobs.start(jobs.counters_stream(src), holder["sink"],
                          f"{base}/_ckpt", ONCE)

    replay(spark, small_dir, run, reverse=True, name="nowm")
    got = holder["sink"].views(spark)["total"]
    assert rows(got) == rows(metrics.total_daily(leads(spark, small_dir)))


def test_raw_sink_writes_archive_outbox_quarantine(spark, small_dir):
    base = scratch_dir(spark, "raw")
    source = f"{base}/input"
    msgs = lead_messages(spark, small_dir, "truncated").filter(F.col("ingest_ts") >= "1998-01-01")
    write_envelopes(msgs, source)
    sink = jobs.RawSink(base)
    q = jobs.start(file_leads(spark, source), sink, f"{base}/_ckpt", ONCE, output_mode="append")
    q.awaitTermination()
    total = msgs.count()
    bad = spark.read.parquet(sink.quarantine).count()
    archived = spark.read.text(sink.archive).count()
    assert bad > 0 and archived + bad == total
    assert spark.read.parquet(sink.outbox).count() <= archived


def test_a_new_checkpoint_on_an_old_base_loses_nothing(spark):
    import os
    from lead_messages import messages
    base = scratch_dir(spark, "ckpts")
    counters, raw = jobs.CounterSink(base), jobs.RawSink(base, outputs=("outbox",))
    lead = '{"leadId":"a","createTime":"2024-03-01 01:00:00"}'
    for n, ts in enumerate(("2024-03-01 10:00:00", "2024-03-01 20:00:00")):
        write_envelopes(messages(spark, [lead, lead], ts), f"{base}/in{n}")
        src = file_leads(spark, f"{base}/in{n}")
        for name, frame, sink, mode in (("c", jobs.counters_stream(src), counters, "update"),
                                        ("r", src, raw, "append")):
            jobs.start(frame, sink, f"{base}/ck{n}{name}", ONCE, output_mode=mode).awaitTermination()
    assert [tuple(r)[1:] for r in counters.table.read(spark).collect()] == [(4, 0, 0)]
    assert spark.read.parquet(raw.outbox).count() == 4
    runs = [d for d in os.listdir(raw.outbox.removeprefix("file:")) if d.startswith("run=")]
    assert len(runs) == 2 and all(d.startswith("run=q") and d.endswith("-0000000000") for d in runs)


def test_days_off_utc_are_local_days_in_batch_and_stream(spark):
    from lead_messages import messages
    from leadpulse.operators.parse import parse_leads
    base = scratch_dir(spark, "zones")
    for zone in ("Asia/Shanghai", "America/New_York"):
        path = f"{base}/{zone.replace('/', '_')}"
        stamps = ["2024-03-09 18:00:00", "2024-03-10 04:59:00", "2024-03-10 05:01:00",
                  "2024-03-11 03:59:00", "2024-03-11 04:01:00", "2024-11-04 04:30:00"]
        for ts in stamps:
            write_envelopes(messages(spark, ['{"leadId":"a"}'], ts), f"{path}/in")
        local = spark.newSession()
        local.conf.set("spark.sql.session.timeZone", zone)
        sink = jobs.CounterSink(path)
        jobs.start(jobs.counters_stream(file_leads(local, f"{path}/in")), sink, f"{path}/ck", ONCE,
                   state_partitions=2).awaitTermination()
        table = local.read.schema("value string, ingest_ts timestamp").json(f"{path}/in")
        want = rows(metrics.day_counters(parse_leads(table)))
        assert len(want) > 1 and rows(sink.table.read(local)) == want


def test_a_lead_without_a_time_is_set_aside_in_both_paths(spark):
    from pyspark.sql.functions import lit
    from leadpulse.operators.parse import parse_leads, quarantine
    base = scratch_dir(spark, "notime")
    msgs = spark.createDataFrame([('{"leadId":"a"}',)], "value string").withColumn(
        "ingest_ts", lit(None).cast("timestamp"))
    assert parse_leads(msgs).count() == 0
    assert [r["reason"] for r in quarantine(msgs).collect()] == ["no_time"]
    sink = jobs.RawSink(base)
    sink(msgs, 0)
    assert [r["reason"] for r in spark.read.parquet(sink.quarantine).collect()] == ["no_time"]
    got = spark.read.parquet(sink.batches).collect()[0]
    assert (got["messages"], got["leads"], got["set_aside"]) == (1, 0, 1)


def test_kafka_options():
    o = kafka_options("b:9092", "leads", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "leads" and o["startingOffsets"] == "latest"
    assert o["kafka.bootstrap.servers"] == "b:9092" and o["maxOffsetsPerTrigger"] == "1000"


def test_processing_clock_counts_leads_under_the_run_day(spark, small_dir):
    import datetime as dt
    base = scratch_dir(spark, "clock")
    write_envelopes(lead_messages(spark, small_dir), f"{base}/in")
    sink = jobs.CounterSink(base)
    src = file_leads(spark, f"{base}/in", clock="processing")
    q = jobs.start(jobs.counters_stream(src), sink, f"{base}/ck", ONCE, state_partitions=4)
    q.awaitTermination()
    got = sink.views(spark)["total"].collect()
    assert len(got) == 1 and got[0]["clue_amounts"] == lead_messages(spark, small_dir).count()
    assert abs((got[0]["clue_dt"] - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_leads_table_is_partitioned_by_day_in_few_files_and_recount_prunes(spark):
    import contextlib
    import datetime as dt
    import glob
    import io
    from lead_messages import messages
    base = scratch_dir(spark, "byday")
    texts = ['{"leadId":"%d"}' % i for i in range(400)]
    for day in (1, 2, 3):
        write_envelopes(messages(spark, texts, f"2024-03-0{day} 10:00:00").repartition(8), f"{base}/in")
    for q in jobs.start_all(file_leads(spark, f"{base}/in"), base, ONCE, state_partitions=2).values():
        q.awaitTermination()
    files = glob.glob(f"{base}/leads/lead_day=*/*.parquet".removeprefix("file:"))
    assert len(files) == 3                     # of 24 tasks' rows
    df = stored_leads(spark, base, dt.date(2024, 3, 3), dt.date(2024, 3, 2))
    assert [str(r.day) for r in df.select("day").distinct().collect()] == ["2024-03-02"]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    assert "PartitionFilters: [isnotnull(lead_day" in out.getvalue()
    recount(spark, base, "2024-03-03", since="2024-03-02")
    assert [r[1] for r in rows(jobs.CounterSink(base).table.read(spark))] == [400] * 3


def test_batch_record_is_observed_whatever_is_written(spark):
    from lead_messages import messages
    for outputs in (("batches",), jobs.RAW_OUTPUTS):
        sink = jobs.RawSink(scratch_dir(spark, "observed"), outputs=outputs)
        sink(messages(spark, ['{"leadId":"a"}', "{", ""]), 4)
        got = sink.read_batches(spark).drop("run").collect()
        assert [tuple(r)[:4] for r in got] == [(4, 3, 1, 2)]
        assert str(got[0]["newest"]) == "2024-03-01 10:00:00"


def test_drain_ends_batches_and_a_restart_loses_and_repeats_nothing(spark):
    from lead_messages import messages
    from leadpulse.streaming.drain import run_for, seconds_to_midnight
    assert 0 < seconds_to_midnight(spark) <= 86400
    base = scratch_dir(spark, "drain")
    for part in (1, 2):
        write_envelopes(messages(spark, ['{"leadId":"a"}', "{"] * 5), f"{base}/in")
        queries = jobs.start_all(file_leads(spark, f"{base}/in"), f"{base}/out",
                                 {"processingTime": "1 second"}, state_partitions=2)
        run_for(queries, 3)
        assert not any(q.isActive for q in queries.values())
    for q in jobs.start_all(file_leads(spark, f"{base}/in"), f"{base}/out", ONCE,
                            state_partitions=2).values():
        q.awaitTermination()
    assert [r[1] for r in rows(jobs.CounterSink(f"{base}/out").table.read(spark))] == [10]
    sink = jobs.RawSink(f"{base}/out")
    assert spark.read.text(sink.archive).count() == 10
    assert spark.read.parquet(sink.quarantine).count() == 10


def test_any_split_into_ordered_batches_gives_the_batch_totals(spark, small_dir):
    import random
    days = sorted({r[0] for r in leads(spark, small_dir).select("day").distinct().collect()})
    cuts = sorted(random.Random(7).sample(days[1:], 4))
    holder = {}

    def run(src, base):
        holder.setdefault("sink", jobs.DimSink(base))
        return jobs.start(jobs.dims_stream(src), holder["sink"], f"{base}/_ckpt", ONCE,
                          state_partitions=3)

    _, progress = replay(spark, small_dir, run, name="split", cuts=[str(c) for c in cuts])
    assert len([p for p in progress if p.numInputRows]) == 5
    assert rows(holder["sink"].daily.read(spark)) == rows(metrics.dim_daily(leads(spark, small_dir)))


def test_running_streams_read_the_leads_table_and_go_on_after_a_restart(spark):
    from lead_messages import messages
    base = scratch_dir(spark, "running")
    lead = ('{"leadId":"a","createTime":"2024-03-01 01:00:00","newLeadDealer":"true","vfrom1":"1",'
            '"vfrom2":"2","vfrom3":"3","vfrom4":"4","regionCode":"5","provinceCode":"6"}')
    texts = [lead, lead, "{", '{"leadId":"b"}']
    write_envelopes(messages(spark, texts), f"{base}/in")
    for rounds in (1, 2):
        queries = jobs.start_all(file_leads(spark, f"{base}/in"), f"{base}/out",
                                 {"processingTime": "1 second"}, state_partitions=2)
        try:
            if rounds == 2:
                write_envelopes(messages(spark, texts, "2024-03-01 12:00:00"), f"{base}/in")
            for name in ("leads", "raw", "counters", "dims"):
                queries[name].processAllAvailable()
        finally:
            for query in queries.values():
                query.stop()
        counted = jobs.CounterSink(f"{base}/out").table.read(spark).collect()
        assert [tuple(r)[1:] for r in counted] == [(3 * rounds, 0, 2 * rounds)]
        sink = jobs.RawSink(f"{base}/out")
        bad = spark.read.parquet(sink.quarantine).collect()
        assert [(r["value"], r["reason"]) for r in bad] == [("{", "malformed")] * rounds
        assert spark.read.text(sink.archive).count() == 3 * rounds
        assert spark.read.parquet(sink.outbox).count() == 2 * rounds
        latest = jobs.DimSink(f"{base}/out").latest(spark).collect()
        assert [r["lead_cnt"] for r in latest] == [2 * rounds]
