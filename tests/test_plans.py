"""Physical plans: one exchange per aggregation, no Python on the data path,
pruned scans and partition pruning on the archive."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from leadpulse.operators import metrics
from leadpulse.operators.parse import parse_leads
from leadpulse.plans import batch as B
from leadpulse.session import scratch_dir
from leadpulse.sinks.archive import read_archive, write_archive
from leadpulse.sources.fixtures import lead_messages


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(p):
    """Shuffle exchanges in a formatted plan (node detail headers)."""
    return len(re.findall(r"^\(\d+\) Exchange$", p, flags=re.M))


def stored_messages(spark, small_dir):
    path = scratch_dir(spark, "msgs")
    lead_messages(spark, small_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_counters_one_exchange_partial_aggregate(spark, small_dir):
    p = plan(metrics.day_counters(parse_leads(stored_messages(spark, small_dir))))
    assert exchanges(p) == 1
    assert "hashpartitioning(day" in p and "partial_count" in p
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert python_node not in p


def test_dim_daily_one_exchange(spark, small_dir):
    p = plan(metrics.dim_daily(parse_leads(stored_messages(spark, small_dir))))
    assert exchanges(p) == 1


def test_fixture_scan_is_pruned(spark, small_dir):
    p = plan(B.q_lead_total_daily(spark, small_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," \
           "o_orderdate:timestamp_ntz,o_orderpriority:string>" in p
    assert "o_totalprice" not in p


def test_archive_read_prunes_days(spark, small_dir):
    path = scratch_dir(spark, "arch")
    good = B.leads(spark, small_dir).filter(F.col("day") >= "1998-06-01")
    write_archive(good, path, "w-0000000000")
    last = read_archive(spark, path).select(F.max("dt")).first()[0]
    df = read_archive(spark, path).filter(F.col("dt") == last)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(dt" in p
    assert df.count() == good.filter(F.col("day") == last).count() > 0


def test_stream_counters_partial_aggregate_before_state(spark, small_dir):
    from leadpulse.sources.stream import file_leads, write_envelopes
    from leadpulse.streaming import jobs
    base = scratch_dir(spark, "splan")
    write_envelopes(lead_messages(spark, small_dir), f"{base}/in")
    q = jobs.start(jobs.counters_stream(file_leads(spark, f"{base}/in")), jobs.CounterSink(base),
                   f"{base}/ck", {"availableNow": True}, state_partitions=4)
    q.awaitTermination()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    p = buf.getvalue()
    assert p.count("Exchange hashpartitioning") == 1
    assert p.index("StateStoreSave") < p.index("StateStoreRestore") < p.index("Exchange") \
        < p.index("partial_count")
    assert "PythonUDF" not in p and "BatchEvalPython" not in p
