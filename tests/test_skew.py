"""A day and a dimension key holding a third of all leads."""

import contextlib
import io

from pyspark.sql import functions as F

from leadpulse.operators import metrics
from leadpulse.operators.parse import parse_leads
from leadpulse.sources.fixtures import lead_messages


def skewed_messages(spark, small_dir):
    """The fixture with every third message moved to one day and one source."""
    msgs = lead_messages(spark, small_dir, with_key=True)
    hot = F.col("o_orderkey") % 3 == 0
    value = F.when(hot, F.regexp_replace("value", '"vfrom1":"[A-Z]+"', '"vfrom1":"HOT"')) \
             .otherwise(F.col("value"))
    ts = F.when(hot, F.to_timestamp(F.lit("2000-01-01 12:00:00"))).otherwise(F.col("ingest_ts"))
    return msgs.select(value.alias("value"), ts.alias("ingest_ts"), hot.alias("hot"))


def test_hot_day_and_key_counted_whole_with_partial_aggregation(spark, small_dir):
    msgs = skewed_messages(spark, small_dir)
    leads = parse_leads(msgs)
    n_hot = msgs.filter("hot").count()
    counters = metrics.day_counters(leads)
    hot_day = counters.filter(F.col("day") == "2000-01-01").first()
    assert hot_day["total"] >= n_hot                      # nothing dropped or capped
    assert counters.agg(F.sum("total")).first()[0] == msgs.count()
    daily = metrics.dim_daily(leads)
    expected = metrics.complete_leads(leads).filter(F.col("vfrom1") == "HOT").count()
    assert daily.filter(F.col("vfrom1") == "HOT").agg(F.sum("lead_cnt")).first()[0] == expected
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        daily.explain()
    plan = buf.getvalue()
    # the aggregation's exchange (the other one spreads the single-split scan)
    agg_exchange = plan.index("Exchange hashpartitioning(day")
    assert plan.index("partial_count") > agg_exchange
