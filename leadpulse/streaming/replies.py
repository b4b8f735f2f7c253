"""Replies of the identity service matched to the messages they answer.

The reference waits for the reply of each post before the next. Here messages
and replies are two streams, joined on the lead and the attempt within a time
limit. Watermarks on both bound the state, which holds the messages whose limit
has not passed. A message without a reply by then comes out with no reply, for
another attempt.

An idle stream holds the watermark back. A *tick*, a row of attempt 0, carries a
stream's clock on and is written nowhere.

Defined cases: a reply after the limit answers nothing. Of several replies in the
limit, the earliest counts. A reply whose text cannot be read is a reply with no code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.operators.oneid import oneid_outbox, parse_reply
from leadpulse.sinks.runs import run_name, write_run, writer_of

LIMIT = "1 hour"
DELAY = "10 minutes"  # by which rows of either stream may come out of order

SENT_SCHEMA = "leadid STRING, attempt INT, payload STRING, sent_ts TIMESTAMP"
REPLY_LOG_SCHEMA = "leadid STRING, attempt INT, reply STRING, reply_ts TIMESTAMP"
MESSAGE_KEY = ("leadid", "attempt", "sent_ts")


def first_attempts(leads: DataFrame) -> DataFrame:
    """The identity message of each lead as sent for the first time, when the lead came in."""
    out = oneid_outbox(leads, "ingest_ts")
    return out.select("leadid", F.lit(1).alias("attempt"), "payload",
                      F.col("ingest_ts").alias("sent_ts"))


def match_replies(sent: DataFrame, replies: DataFrame, limit: str = LIMIT,
                  delay: str = DELAY) -> DataFrame:
    """Each message with each of its replies within ``limit``, or with none.

    ``leadid, attempt, payload, sent_ts, reply_ts, code, status, msg, data``; works on
    tables and on streams. In a stream, a message without a reply comes out when both
    watermarks have passed its limit.
    """
    sent = sent.withWatermark("sent_ts", delay)
    replies = replies.withWatermark("reply_ts", delay).select(
        F.col("leadid").alias("_leadid"), F.col("attempt").alias("_attempt"), "reply", "reply_ts")
    within = ((F.col("leadid") == F.col("_leadid")) & (F.col("attempt") == F.col("_attempt"))
              & (F.col("reply_ts") >= F.col("sent_ts"))
              & (F.col("reply_ts") <= F.col("sent_ts") + F.expr(f"INTERVAL {limit}")))
    answer = parse_reply(F.col("reply"))
    return (sent.join(replies, within, "left")
            .select("leadid", "attempt", "payload", "sent_ts", "reply_ts", answer.alias("_answer"))
            .select("leadid", "attempt", "payload", "sent_ts", "reply_ts", "_answer.*"))


def first_answers(matched: DataFrame) -> DataFrame:
    """One row per answered message: its earliest reply, and how many there were."""
    reply = F.struct("reply_ts", "code", "status", "msg", "data")
    return (matched.where(F.col("reply_ts").isNotNull()).groupBy(*MESSAGE_KEY)
            .agg(F.min(reply).alias("_first"), F.count(F.lit(1)).alias("replies"))
            .select(*MESSAGE_KEY, "_first.*", "replies"))


def next_attempts(unanswered: DataFrame, limit: str = LIMIT) -> DataFrame:
    """Unanswered messages as they are sent again, when their limit has passed."""
    return unanswered.select("leadid", (F.col("attempt") + 1).alias("attempt"), "payload",
                             (F.col("sent_ts") + F.expr(f"INTERVAL {limit}")).alias("sent_ts"))


class ReplySink:
    """foreachBatch sink of :func:`match_replies`: answered and unanswered messages, each
    batch as a run of its own, so that a replayed batch replaces its rows."""

    def __init__(self, base: str):
        self.answered = f"{base}/oneid_answered"
        self.unanswered = f"{base}/oneid_unanswered"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        run = run_name(writer_of(batch.sparkSession), batch_id)
        rows = batch.where(F.col("attempt") > 0).persist()  # no ticks
        try:
            if rows.isEmpty():
                return
            has_reply = F.col("reply_ts").isNotNull()
            write_run(rows.where(has_reply).drop("payload"), self.answered, run)
            write_run(rows.where(~has_reply).select("leadid", "attempt", "payload", "sent_ts"),
                      self.unanswered, run)
        finally:
            rows.unpersist()

    def read_answered(self, spark: SparkSession) -> DataFrame:
        """The first answer of each answered message."""
        return first_answers(spark.read.parquet(self.answered))

    def read_unanswered(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.unanswered).select("leadid", "attempt", "payload", "sent_ts")


def tick(spark: SparkSession, at, stamp: str) -> DataFrame:
    """A row that moves a stream's clock to ``at``; ``stamp`` names its time column."""
    text = "payload" if stamp == "sent_ts" else "reply"
    return spark.range(1).select(F.lit("").alias("leadid"), F.lit(0).alias("attempt"),
                                 F.lit(None).cast("string").alias(text),
                                 F.lit(at).cast("timestamp").alias(stamp))
