"""Daily lead counters.

All counters are hash aggregations: a partial aggregate runs before the
shuffle, so a day or a dimension key that holds a large share of the leads
costs one row per task on the wire, not one row per lead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpulse.schema import DEALER_COLUMNS, DIM_COLUMNS, DIMS, HQ_COLUMNS, TOTAL_COLUMNS


def is_new_to_brand() -> Column:
    """newLeadHQ is true (NULL counts as not true)."""
    return F.coalesce(F.col("newLeadHQ"), F.lit(False))


def is_new_to_dealer() -> Column:
    """newLeadDealer is true."""
    return F.coalesce(F.col("newLeadDealer"), F.lit(False))


def is_complete() -> Column:
    """every dimension present and the lead new to the dealer."""
    present = [F.col(d).isNotNull() for d in DIMS]
    cond = is_new_to_dealer()
    for p in present:
        cond = cond & p
    return cond


def count_by_day(leads: DataFrame, names=TOTAL_COLUMNS, predicate: Column | None = None,
                 day_col: str = "day") -> DataFrame:
    """Leads per day (A1), optionally of the leads matching ``predicate``.

    A day with no matching lead has no row.
    """
    rows = leads if predicate is None else leads.filter(predicate)
    return rows.groupBy(F.col(day_col).alias(names[0])).agg(F.count(F.lit(1)).alias(names[1]))


def total_daily(leads: DataFrame) -> DataFrame:
    """A1: ``clue_dt, clue_amounts``."""
    return count_by_day(leads, TOTAL_COLUMNS)


def hq_daily(leads: DataFrame) -> DataFrame:
    """A2: ``clue_hq_dt, clue_hq_amounts``."""
    return count_by_day(leads, HQ_COLUMNS, is_new_to_brand())


def dealer_daily(leads: DataFrame) -> DataFrame:
    """A3: ``clue_new_dt, clue_new_amounts``."""
    return count_by_day(leads, DEALER_COLUMNS, is_new_to_dealer())


def day_counters(leads: DataFrame, day_col: str = "day") -> DataFrame:
    """A1-A3 in one aggregation: ``day, total, hq, dealer``.

    One exchange instead of three; the three result tables are cut from it
    with :func:`split_counters`.
    """
    return leads.groupBy(F.col(day_col).alias("day")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_new_to_brand()).alias("hq"),
        F.count_if(is_new_to_dealer()).alias("dealer"),
    )


def split_counters(counters: DataFrame) -> dict[str, DataFrame]:
    """The total, HQ and dealer tables of :func:`day_counters` output.

    A zero count means no matching lead that day, so it gives no row.
    """
    out = {}
    for table, source, names in (("total", "total", TOTAL_COLUMNS),
                                 ("hq", "hq", HQ_COLUMNS),
                                 ("dealer", "dealer", DEALER_COLUMNS)):
        out[table] = (counters.filter(F.col(source) > 0)
                      .select(F.col("day").alias(names[0]), F.col(source).alias(names[1])))
    return out


def complete_leads(leads: DataFrame) -> DataFrame:
    """the leads that feed the dimension counters."""
    return leads.filter(is_complete())


def dim_columns() -> list[Column]:
    """The six dimensions under their result-table names."""
    return [F.col(d).alias(c) for d, c in zip(DIMS, DIM_COLUMNS)]


def dim_daily(leads: DataFrame, day_col: str = "day") -> DataFrame:
    """P9 + A4: ``lz_date, vfrom1-4, region_code, province_code, lead_cnt``."""
    return (complete_leads(leads)
            .groupBy(F.col(day_col).alias("lz_date"), *dim_columns())
            .agg(F.count(F.lit(1)).alias("lead_cnt")))


def dim_latest(daily: DataFrame) -> DataFrame:
    """K6 as the result table keeps it: one row per dimension key.

    ``lead_cnt`` is the count of the latest day; ``lz_date`` stays the day
    the key was first inserted, since updates never touch it.
    """
    return dim_span(daily).drop("last_day")


def dim_span(daily: DataFrame) -> DataFrame:
    """:func:`dim_latest` with ``last_day``, the day that ``lead_cnt`` belongs to."""
    return daily.groupBy(*DIM_COLUMNS).agg(
        F.min("lz_date").alias("lz_date"),
        F.max("lz_date").alias("last_day"),
        F.max_by("lead_cnt", "lz_date").alias("lead_cnt"),
    )


def expire(daily: DataFrame, ttl_days: int, now: Column | _dt.date | None = None) -> DataFrame:
    """Latest counters of the keys updated within ``ttl_days`` of ``now``.

    A key expires ``ttl_days`` after its last update (not after its first),
    so keys seen once expire too. ``now`` defaults to the current date.
    """
    if now is None:
        now = F.current_date()
    elif not isinstance(now, Column):
        now = F.lit(now)
    return (dim_span(daily).filter(F.col("last_day") > F.date_sub(now, ttl_days))
            .select(*DIM_COLUMNS, "lead_cnt"))
