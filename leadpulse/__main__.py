"""Command line: run the lead jobs.

    python -m leadpulse stream --kafka broker:9092 --topic leads --out hdfs:///leads
    python -m leadpulse stream --files /landing/leads --out /data/leads --available-now
    python -m leadpulse backfill --messages /data/old_messages --out /data/leads
    python -m leadpulse compact --out /data/leads
    python -m leadpulse recount --out /data/leads --before 2024-03-01
    python -m leadpulse replies --out /data/leads --replies /landing/replies
    python -m leadpulse restore --old /data/leads --out /data/leads2

``stream`` parses one source into ``--out/leads`` and starts the raw, counters and
dimension queries on that table (each with its own checkpoint under
``--out/_checkpoints``) and waits for them;
``backfill`` loads a message table (parquet with ``value`` and ``ingest_ts``)
in batch into the same result tables. Another part of the history needs
another ``--name``. ``compact`` folds the runs of all outputs, also while streams run.
``recount`` adds the late leads that a ``--watermark`` kept out of earlier days. ``replies``
matches replies to identity messages. ``restore`` fills new result tables from the state
of a stopped job, for a new checkpoint to go on from.
"""

from __future__ import annotations

import argparse
import sys

from leadpulse.operators.parse import PRODUCER_ALIASES
from leadpulse.session import build_session, ship


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="leadpulse")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("stream", help="run the streaming jobs")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of JSON-line envelopes (value, ingest_ts)")
    s.add_argument("--topic", help="Kafka topic")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--out", required=True, help="base folder of the outputs")
    s.add_argument("--trigger-seconds", type=int, default=59)
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.add_argument("--watermark", default="none",
                   help="for example '30 days': forget older days and drop their late leads; "
                        "'none' (default) counts every lead")
    s.add_argument("--max-offsets-per-trigger", type=int, default=None,
                   help="Kafka records a micro-batch may read")
    s.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="files a micro-batch may read")
    s.add_argument("--clock", choices=("record", "processing"), default="record")
    s.add_argument("--state-partitions", type=int, default=None,
                   help="state store partitions of a new checkpoint")
    s.add_argument("--producer-aliases", action="store_true",
                   help="bind preLeadId / countryName as leadId / countyName")
    s.add_argument("--until-midnight", action="store_true",
                   help="run to the session's next midnight, end the running batches, then stop")
    b = sub.add_parser("backfill", help="load a message table in batch")
    b.add_argument("--messages", required=True, help="parquet with value, ingest_ts")
    b.add_argument("--out", required=True)
    b.add_argument("--outputs", default="quarantine,counters,dims,outbox,archive")
    b.add_argument("--name", default="backfill",
                   help="writer name; the same name replaces its earlier rows")
    b.add_argument("--producer-aliases", action="store_true")
    c = sub.add_parser("compact", help="fold the runs of all outputs")
    c.add_argument("--out", required=True)
    c.add_argument("--compression", default=None, help="of the archive files, for example gzip")
    r = sub.add_parser("recount", help="add the late leads that a watermark dropped")
    r.add_argument("--out", required=True)
    r.add_argument("--before", required=True,
                   help="yyyy-mm-dd: days before it, which must lie behind the watermark")
    r.add_argument("--since", default=None, help="yyyy-mm-dd: only days from it on")
    m = sub.add_parser("replies", help="match the identity service's replies to the messages")
    m.add_argument("--out", required=True, help="base folder of a stream job")
    m.add_argument("--replies", required=True,
                   help="folder of JSON-line replies (leadid, attempt, reply, reply_ts)")
    m.add_argument("--limit", default="1 hour", help="within which a reply counts")
    m.add_argument("--delay", default="10 minutes", help="by which rows may come out of order")
    m.add_argument("--available-now", action="store_true")
    w = sub.add_parser("restore", help="give result tables the totals of a checkpoint's state")
    w.add_argument("--out", required=True, help="base folder of the new tables")
    w.add_argument("--old", required=True, help="base folder of the stopped stream job")
    for q in (s, b, c, r, m, w):
        q.add_argument("--master", default=None)
    return p


def run(argv: list[str] | None = None, spark=None):
    """Run a command; returns the started queries (stream) or None."""
    args = _parser().parse_args(argv)
    spark = spark or build_session(args.master)
    ship(spark)
    if args.command == "compact":
        from leadpulse.streaming.jobs import CounterSink, DimSink, RawSink
        RawSink(args.out, args.compression).compact(spark)
        dims = DimSink(args.out)
        for table in (CounterSink(args.out).table, dims.daily, dims.newest):
            table.compact(spark)
        return None
    if args.command == "recount":
        from leadpulse.streaming.recount import recount
        recount(spark, args.out, args.before, since=args.since)
        return None
    if args.command == "replies":
        from leadpulse.operators.parse import split_good
        from leadpulse.streaming.jobs import DEFAULT_TRIGGER, start
        from leadpulse.streaming.replies import (REPLY_LOG_SCHEMA, ReplySink, first_attempts,
                                                 match_replies)
        stored = spark.readStream.schema(spark.read.parquet(f"{args.out}/leads").schema).parquet(
            f"{args.out}/leads")
        log = spark.readStream.schema(REPLY_LOG_SCHEMA).json(args.replies)
        matched = match_replies(first_attempts(split_good(stored)), log, args.limit, args.delay)
        trigger = {"availableNow": True} if args.available_now else DEFAULT_TRIGGER
        return {"replies": start(matched, ReplySink(args.out), f"{args.out}/_checkpoints/replies",
                                 trigger, output_mode="append")}
    if args.command == "restore":
        from leadpulse.streaming.state import restore
        restore(spark, args.out, f"{args.old}/_checkpoints/counters",
                f"{args.old}/_checkpoints/dims")
        return None
    parse_options = {"aliases": PRODUCER_ALIASES} if args.producer_aliases else {}
    if args.command == "backfill":
        from leadpulse.plans.backfill import Backfill
        Backfill(args.out, args.name).run(spark.read.parquet(args.messages),
                               [o for o in args.outputs.split(",") if o], **parse_options)
        return None
    from leadpulse.sources.stream import file_leads, kafka_leads
    from leadpulse.streaming.jobs import start_all
    if args.kafka:
        if not args.topic:
            raise SystemExit("--topic is required with --kafka")
        messages = kafka_leads(spark, args.kafka, args.topic, args.starting_offsets, clock=args.clock,
                               max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        messages = file_leads(spark, args.files, args.max_files_per_trigger, args.clock)
    trigger = ({"availableNow": True} if args.available_now
               else {"processingTime": f"{args.trigger_seconds} seconds"})
    watermark = None if args.watermark.lower() == "none" else args.watermark
    queries = start_all(messages, args.out, trigger, watermark, args.state_partitions,
                        **parse_options)
    if args.until_midnight and not args.available_now:
        from leadpulse.streaming.drain import run_for, seconds_to_midnight
        run_for(queries, seconds_to_midnight(spark))
    return queries


def main(argv: list[str] | None = None) -> int:
    queries = run(argv)
    if queries:
        for q in queries.values():
            q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
