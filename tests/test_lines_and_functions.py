"""Lines (P5-P7), date helpers (X1-X4) and the OneID payload."""

import datetime as dt
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lead_messages import messages

from leadpulse.functions.dates import date_prefix, ms_to_next_midnight
from leadpulse.functions.text import unquote_csv_json
from leadpulse.operators.lines import from_line, line_of
from leadpulse.operators.oneid import oneid_payload, parse_reply
from leadpulse.operators.parse import parse_leads
from leadpulse.schema import LEAD_FIELDS, TEXT_FIELDS


def test_java_style_blank(spark):
    texts = ["\t ", " x", "", "\n", "\u2028", "\u0085", " \u00a0", "x\n"]
    rows = [(json.dumps({"leadId": str(i), "vfrom1": t}),) for i, t in enumerate(texts)]
    leads = parse_leads(spark.createDataFrame(rows, "value string")).collect()
    got = {int(r["leadId"]): r["vfrom1"] for r in leads}
    # What a trim of characters up to U+0020 empties is blank; all else stays.
    assert got == {i: t if t.strip("".join(map(chr, range(33)))) else None
                   for i, t in enumerate(texts)}


def test_unquote_order(spark):
    df = spark.createDataFrame([('"{""a"": ""b""}"',)], "s string")
    assert df.select(unquote_csv_json(F.col("s"))).first()[0] == '{"a": "b"}'


def test_date_prefix_and_payload(spark):
    df = spark.createDataFrame([("2019-11-21 20:27:00.000000",), ("bad",), (None,),
                                ("2019-1-5 10:00:00",), ("2019-02-30 1:00",)], "c string")
    rows = df.select(date_prefix(F.col("c")).alias("d"), oneid_payload(F.col("c")).alias("p")).collect()
    assert rows[0]["d"] == dt.date(2019, 11, 21)
    assert rows[0]["p"] == '{"createTime":1574294400000}'
    assert rows[1]["p"] is None and rows[2]["p"] is None
    assert rows[3]["d"] == dt.date(2019, 1, 5) and rows[4]["d"] is None


def test_reply_keeps_data_as_json_text(spark):
    df = spark.createDataFrame([('{"code":0,"status":"ok","msg":"m","data":{"a":[1,2]}}',)], "r string")
    r = df.select(parse_reply(F.col("r")).alias("x")).select("x.*").first()
    assert (r["code"], r["status"], r["msg"], r["data"]) == (0, "ok", "m", '{"a":[1,2]}')


def test_ms_to_midnight(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07.179575",), ("2024-01-01 23:59:59.999",)], "s string")
    df = df.select(F.to_timestamp("s").alias("ts"))
    assert [r[0] for r in df.select(ms_to_next_midnight(F.col("ts"))).collect()] == [86392821, 1]
    ntz = df.select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert [r[0] for r in ntz.select(ms_to_next_midnight(F.col("ts"))).collect()] == [86392821, 1]


value_text = st.text(alphabet=st.characters(blacklist_characters=';"\\', min_codepoint=33,
                                            max_codepoint=0x2FFF), min_size=1, max_size=8)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from(TEXT_FIELDS), value_text, max_size=6),
       st.sampled_from([None, "true", "false"]))
def test_line_round_trip(spark, fields, flag):
    """parse -> line -> split gives the fields back (values without ';')."""
    import json
    msg = dict(fields)
    if flag is not None:
        msg["newLeadDealer"] = flag
    df = parse_leads(messages(spark, [json.dumps(msg)]))
    back = from_line(df.select(line_of().alias("line"))).first().asDict()
    for f in LEAD_FIELDS:
        expected = msg.get(f)
        assert back[f] == expected, (f, back[f], expected)
