"""Replies matched to messages, counters that expire, state read back."""

import datetime as dt

from pyspark.sql import functions as F

from lead_messages import messages

from leadpulse.__main__ import run
from leadpulse.plans.streams import ONCE
from leadpulse.session import scratch_dir
from leadpulse.sources.stream import file_leads, write_envelopes
from leadpulse.streaming import jobs
from leadpulse.streaming.expiry import ExpiredSink, expiring_counters
from leadpulse.streaming.replies import (REPLY_LOG_SCHEMA, SENT_SCHEMA, ReplySink, first_answers,
                                         match_replies, next_attempts, tick)
from leadpulse.streaming.state import day_totals, dim_totals, last_batch, restore


def at(text):
    return dt.datetime.fromisoformat(f"2024-03-01 {text}")


def sent(spark, *rows):
    return spark.createDataFrame([(k, n, "{}", at(t)) for k, n, t in rows], SENT_SCHEMA)


def replies(spark, *rows):
    return spark.createDataFrame([(k, n, text, at(t)) for k, n, text, t in rows], REPLY_LOG_SCHEMA)


OK = '{"code":200,"status":"success","data":{"createTime":1}}'
SENT = [("a", 1, "10:00:00"), ("b", 1, "10:00:00"), ("c", 1, "10:00:00"), ("c", 2, "11:00:00"),
        ("d", 1, "10:00:00"), ("e", 1, "10:00:00")]
REPLIES = [("a", 1, '{"code":500,"status":"again"}', "10:30:00"), ("a", 1, OK, "10:20:00"),
           ("d", 1, "no json", "10:25:00"), ("b", 1, OK, "11:00:00.001"), ("c", 2, OK, "11:10:00"),
           ("e", 1, OK, "09:59:59"), ("x", 1, OK, "10:10:00")]
ANSWERED = {("a", 1, 200, 2), ("c", 2, 200, 1), ("d", 1, None, 1)}
UNANSWERED = {("b", 1), ("c", 1), ("e", 1)}


def outcome(answers, rest):
    return ({(r.leadid, r.attempt, r.code, r.replies) for r in answers.collect()},
            {(r.leadid, r.attempt) for r in rest.collect()})


def test_replies_in_a_table_late_twice_never_and_of_another_attempt(spark):
    rows = match_replies(sent(spark, *SENT), replies(spark, *REPLIES))
    rest = rows.where("reply_ts is null")
    assert outcome(first_answers(rows), rest) == (ANSWERED, UNANSWERED)
    again = {(r.leadid, r.attempt, r.sent_ts) for r in next_attempts(rest).collect()}
    assert again == {("b", 2, at("11:00:00")), ("c", 2, at("11:00:00")), ("e", 2, at("11:00:00"))}


def test_replies_in_a_stream_come_in_any_batch_and_after_restarts(spark):
    base = scratch_dir(spark, "replies")
    sink = ReplySink(base)

    def batch(messages_, replies_):
        for rows, name in ((messages_, "sent"), (replies_, "replies")):
            rows.coalesce(1).write.mode("append").json(f"{base}/{name}")
        stream = match_replies(spark.readStream.schema(SENT_SCHEMA).json(f"{base}/sent"),
                               spark.readStream.schema(REPLY_LOG_SCHEMA).json(f"{base}/replies"))
        jobs.start(stream, sink, f"{base}/ck", ONCE, output_mode="append",
                   state_partitions=2).awaitTermination()

    batch(sent(spark, *SENT[:3]), replies(spark, *REPLIES[:1]))
    batch(sent(spark, *SENT[3:]), replies(spark, *REPLIES[1:3]))   # before their limits pass
    batch(sent(spark), replies(spark, *REPLIES[3:]))
    assert spark.read.parquet(sink.answered).count() == 4
    for _ in range(2):                                             # an idle stream needs a tick
        batch(tick(spark, "2024-03-02 00:00:00", "sent_ts"), tick(spark, "2024-03-02", "reply_ts"))
        assert outcome(sink.read_answered(spark), sink.read_unanswered(spark)) == (
            ANSWERED, UNANSWERED)


LEAD = ('{"leadId":"a","newLeadDealer":"true","vfrom1":"%s","vfrom2":"2","vfrom3":"3","vfrom4":"4",'
        '"regionCode":"5","provinceCode":"6"}')


def test_counters_expire_by_their_last_lead_and_start_again(spark):
    base = scratch_dir(spark, "expiry")
    sink = ExpiredSink(base)
    days = {"k": ["2024-01-05", "2024-01-01", "2024-01-14 23:59:59", "2024-01-24 23:59:59", "2024-03-01"],
            "j": ["2024-01-01", "2024-01-11"]}
    for key, stamps in days.items():                               # each a batch, out of order
        for ts in stamps:
            write_envelopes(messages(spark, [LEAD % key, LEAD % key, "{"], ts), f"{base}/in")
    last = messages(spark, [LEAD % "last"], "2030-01-01")
    write_envelopes(last, f"{base}/in2")
    for folder in ("in", "in2"):
        source = file_leads(spark, f"{base}/{folder}", max_files_per_trigger=2)
        ck = f"{base}/ck"
        if folder == "in2":
            last.write.mode("append").json(f"{base}/in")
            source = file_leads(spark, f"{base}/in", max_files_per_trigger=2)
        jobs.start(expiring_counters(source, 10, "400 days"), sink, ck, ONCE, output_mode="append",
                   state_partitions=2).awaitTermination()
    got = {(r.vfrom1, str(r.first_ts), str(r.last_ts), r.lead_cnt) for r in sink.read(spark).collect()}
    # A lead just when the counter expires, ten days after the last, starts it again.
    assert got == {("k", "2024-01-01 00:00:00", "2024-01-14 23:59:59", 6),
                   ("k", "2024-01-24 23:59:59", "2024-01-24 23:59:59", 2),
                   ("k", "2024-03-01 00:00:00", "2024-03-01 00:00:00", 2),
                   ("j", "2024-01-01 00:00:00", "2024-01-01 00:00:00", 2),
                   ("j", "2024-01-11 00:00:00", "2024-01-11 00:00:00", 2)}


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_state_holds_the_served_totals_and_fills_lost_tables(spark):
    base, new = scratch_dir(spark, "state"), scratch_dir(spark, "state-new")
    write_envelopes(messages(spark, [LEAD % "1", LEAD % "2", LEAD % "1"]), f"{base}/in")
    run(["stream", "--files", f"{base}/in", "--out", base, "--available-now", "--state-partitions", "2"],
        spark=spark)["dims"].awaitTermination()
    for q in spark.streams.active:
        q.awaitTermination()
    counters, dims = jobs.CounterSink(base), jobs.DimSink(base)
    checkpoints = [f"{base}/_checkpoints/{n}" for n in ("counters", "dims")]
    assert values(day_totals(spark, checkpoints[0])) == values(counters.table.read(spark))
    assert values(dim_totals(spark, checkpoints[1])) == values(dims.daily.read(spark))
    assert last_batch(spark, checkpoints[0])[1] == 0
    restore(spark, base, *checkpoints)                             # tables that are there stay
    assert values(counters.table.read(spark)) == [(dt.date(2024, 3, 1), 3, 0, 3)]
    run(["restore", "--old", base, "--out", new], spark=spark)
    write_envelopes(messages(spark, [LEAD % "1"], "2024-03-01 20:00:00"), f"{new}/in")
    jobs.start(jobs.counters_stream(file_leads(spark, f"{new}/in")), jobs.CounterSink(new),
               f"{new}/ck", ONCE, state_partitions=2).awaitTermination()
    assert values(jobs.CounterSink(new).table.read(spark)) == [(dt.date(2024, 3, 1), 4, 0, 4)]
    assert values(jobs.DimSink(new).daily.read(spark)) == values(dims.daily.read(spark))


def test_replies_command_reads_the_leads_table(spark):
    base = scratch_dir(spark, "replies-cli")
    lead = '{"leadId":"a","createTime":"2024-03-01 01:00:00"}'
    write_envelopes(messages(spark, [lead], "2024-03-01 10:00:00"), f"{base}/in")
    for q in run(["stream", "--files", f"{base}/in", "--out", base, "--available-now",
                  "--state-partitions", "2"], spark=spark).values():
        q.awaitTermination()
    replies(spark, ("a", 1, OK, "10:20:00")).write.json(f"{base}/replies")
    query = run(["replies", "--out", base, "--replies", f"{base}/replies", "--available-now"],
                spark=spark)["replies"]
    query.awaitTermination()
    got = ReplySink(base).read_answered(spark).collect()
    assert [(r.leadid, r.code, r.replies) for r in got] == [("a", 200, 1)]
