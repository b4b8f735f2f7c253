"""Lead messages built from the driver's order tables.

One lead per order: ``orders`` joined to ``customer``, ``nation`` and
``region``, written as the JSON a producer sends, with blank and missing
values injected by key. The join is planned by Spark, with no hints: the
two dimension tables (25 and 5 rows) always fall under the broadcast
threshold. ``customer`` does too at the test sizes. Once it outgrows the
threshold, ``orders`` and ``customer`` meet in a sort-merge join, and AQE
splits the partition of a customer that holds a large share of the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.functions.dates import timestamp_text

VARIANTS = ("clean", "truncated", "csv", "dirty", "extra", "rollover")

# Day-aligned cuts of the streaming fixture: three slices in time order.
SLICE_CUTS = ("1997-01-01", "1999-01-01")


# Columns used from the driver tables (FIXTURES.md section 5). Declaring them
# skips the schema-inference job and reads only these columns.
TABLE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (declared columns only when the table is known)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def order_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order x customer x nation x region rows a lead is made from."""
    # Dealt to all cores, at every size: the per-row steps that follow (building
    # and parsing JSON) cost far more than this shuffle of a few columns.
    orders = table(spark, sf_dir, "orders").repartition(
        spark.sparkContext.defaultParallelism, "o_orderkey")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (orders
            .join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, F.col("c_nationkey") == nation.n_nationkey)
            .join(region, F.col("n_regionkey") == region.r_regionkey))


def _blank_when(cond, value):
    return F.when(cond, F.lit("")).otherwise(value)


def lead_json(rows: DataFrame) -> DataFrame:
    """``o_orderkey, value, ingest_ts``: the JSON message of each order."""
    key = F.col("o_orderkey")
    nation = F.col("n_nationkey").cast("string")
    flag_hq = (F.when(key % 5 == 0, F.lit("true"))
               .when((key % 5 == 1) | (key % 5 == 2), F.lit("false"))
               .when(key % 5 == 3, F.lit("")))           # key % 5 = 4: field absent
    flag_dealer = (F.when(key % 3 == 0, F.lit("true"))
                   .when(key % 3 == 1, F.lit("false"))
                   .otherwise(F.lit("")))
    message = F.struct(
        key.alias("pkId"),
        key.cast("string").alias("leadId"),
        _blank_when(key % 17 == 0, timestamp_text(F.col("o_orderdate"))).alias("createTime"),
        F.col("c_custkey").cast("string").alias("dealerId"),
        F.col("c_name").alias("dealerName"),
        F.lit("").alias("countyCode"),
        F.lit(None).cast("string").alias("countyName"),
        nation.alias("cityCode"),
        F.col("n_name").alias("cityName"),
        nation.alias("provinceCode"),
        F.col("n_name").alias("provinceName"),
        F.when(key % 11 == 0, F.lit(" "))
         .otherwise(F.col("r_regionkey").cast("string")).alias("regionCode"),
        F.col("r_name").alias("regionName"),
        F.col("c_mktsegment").alias("seriesCode"),
        F.lit(None).cast("string").alias("seriesName"),
        F.when(F.col("o_orderstatus") == "F", F.lit("OFF")).otherwise(F.lit("ON")).alias("vfrom1"),
        _blank_when(key % 13 == 0, F.col("o_orderpriority")).alias("vfrom2"),
        F.col("o_orderstatus").alias("vfrom3"),
        F.col("c_mktsegment").alias("vfrom4"),
        flag_hq.alias("newLeadHQ"),
        flag_dealer.alias("newLeadDealer"),
    )
    return rows.select(key, F.to_json(message).alias("value"),
                       F.col("o_orderdate").cast("timestamp").alias("ingest_ts"))


def lead_messages(spark: SparkSession, sf_dir: str, variant: str = "clean",
                  with_key: bool = False) -> DataFrame:
    """Messages ``value, ingest_ts`` (plus ``o_orderkey`` if ``with_key``).

    ``truncated`` cuts the last five characters of every 19th message;
    ``csv`` doubles every quote and wraps the text in quotes; ``dirty`` gives
    the forms of :func:`dirty` by the order key modulo 23; ``extra`` adds fields that the
    lead schema does not name; ``rollover`` gives dates out of range.
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    messages = lead_json(order_leads(spark, sf_dir))
    value = F.col("value")
    if variant == "truncated":
        value = F.when(F.col("o_orderkey") % 19 == 0,
                       F.expr("substring(value, 1, length(value) - 5)")).otherwise(value)
    elif variant == "csv":
        value = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    elif variant == "extra":
        key = F.col("o_orderkey")
        value = F.concat(
            F.lit("{"), F.when(key % 5 != 0, F.concat(F.lit('"id":"k'), key, F.lit('",')))
            .otherwise(F.lit("")), F.lit('"updateTime":'),
            F.when(key % 2 == 0, key.cast("string")).otherwise(F.lit('"2019-01-05 10:00:00"')),
            F.lit(","), F.expr("substring(value, 2)"))
    elif variant == "rollover":
        value = rollover(value)
    ts = F.col("ingest_ts")
    if variant == "dirty":
        value, ts = dirty(value, ts)
    key = [F.col("o_orderkey")] if with_key else []
    return messages.select(*key, value.alias("value"), ts.alias("ingest_ts"))


def rollover(value):
    """Message text whose ``createTime`` has a month or a day out of range, by the order
    key modulo 7."""
    text = value
    for remainder, stamp in enumerate(("2019-13-5 10:00:00", "2019-2-30", "2019-0-10",
                                       "2019-03-00 01:02:03", "2019-25-61", "none")):
        text = F.when(F.col("o_orderkey") % 7 == remainder, F.regexp_replace(
            value, '"createTime":"[^"]+"', f'"createTime":"{stamp}"')).otherwise(text)
    return text


def dirty(value, ts):
    """Message text and time with odd but valid forms (flags, dates, blanks, a
    separator in a value) and messages to set aside, by the order key modulo 23."""
    form = F.col("o_orderkey") % 23

    def put(name: str, text: str):
        return F.regexp_replace(value, f'"{name}":"[^"]*"', f'"{name}":{text}')

    odd = {
        0: F.lit(""),                                          # empty
        1: put("newLeadDealer", '" true "'),
        2: put("newLeadDealer", '"True"'),
        3: put("newLeadDealer", "1"),
        4: put("newLeadDealer", "0"),
        5: put("newLeadDealer", '"yes"'),                      # bad_flag
        6: put("dealerName", '"a;b"'),
        7: put("createTime", '"2019-1-5 10:00:00"'),
        8: put("createTime", '"soon"'),                        # a lead without a date
        9: put("vfrom2", '"\u2028"'),                          # no blank: beyond U+0020
        10: put("vfrom2", r'"\\t"'),                           # a tab: blank
        12: F.expr("substring(value, 1, length(value) - 5)"),  # malformed
    }
    text = value
    for remainder, changed in odd.items():
        text = F.when(form == remainder, changed).otherwise(text)
    return text, F.when(form != 11, ts)                        # 11: no_time


def slice_bounds(cuts=SLICE_CUTS) -> list[tuple[str | None, str | None]]:
    """``[start, end)`` day bounds of the streaming slices, in time order."""
    edges = [None, *cuts, None]
    return list(zip(edges[:-1], edges[1:]))


def in_slice(ts_col: str, bounds: tuple[str | None, str | None]):
    """Predicate of one slice on a timestamp column."""
    start, end = bounds
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts_col) >= F.to_timestamp(F.lit(start)))
    if end is not None:
        cond = cond & (F.col(ts_col) < F.to_timestamp(F.lit(end)))
    return cond
