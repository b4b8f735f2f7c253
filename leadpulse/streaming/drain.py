"""Runs that end at a given time, without cutting a batch short."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadpulse.functions.dates import ms_to_next_midnight

POLL_SECONDS = 0.2


def seconds_to_midnight(spark: SparkSession) -> float:
    """Seconds until the next midnight of the session's time zone."""
    now = spark.range(1).select(ms_to_next_midnight(F.current_timestamp()).alias("ms"))
    return now.first().ms / 1000


def drain(query: StreamingQuery) -> None:
    """Stop ``query`` between two batches: the running one ends first."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(POLL_SECONDS)
    query.stop()


def run_for(queries: dict[str, StreamingQuery], seconds: float) -> None:
    """Let the queries run for ``seconds``, then stop them in order.

    The first one feeds the others (:func:`leadpulse.streaming.jobs.start_all`): it
    stops first, the others take in all it has written, then stop. Should a query fail
    meanwhile, the others are stopped the same way and its error is raised.
    """
    end = time.monotonic() + seconds
    while time.monotonic() < end and all(q.isActive for q in queries.values()):
        time.sleep(min(POLL_SECONDS, max(0.0, end - time.monotonic())))
    first, *others = queries.values()
    drain(first)
    for query in others:
        if query.isActive:
            query.processAllAvailable()
        drain(query)
    for query in queries.values():
        if query.exception() is not None:
            raise query.exception()
