"""Keyed upsert (K5, K6): properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

from leadpulse.operators.upsert import upsert

rows = st.dictionaries(st.integers(0, 6), st.integers(0, 99), max_size=6)


def frame(spark, d, extra=0):
    return spark.createDataFrame([(k, v, extra) for k, v in d.items()], "k int, v int, first int")


def as_dict(df):
    return {r["k"]: (r["v"], r["first"]) for r in df.collect()}


@settings(max_examples=12, deadline=None)
@given(rows, rows)
def test_replace_semantics_and_idempotence(spark, old, new):
    o, n = frame(spark, old, 1), frame(spark, new, 2)
    once = upsert(o, n, ["k"])
    expected = {k: (v, 1) for k, v in old.items()}
    expected.update({k: (v, 2) for k, v in new.items()})
    assert as_dict(once) == expected
    assert once.count() == len(expected)
    assert as_dict(upsert(once, n, ["k"])) == expected


@settings(max_examples=8, deadline=None)
@given(rows, rows)
def test_keep_columns_stay_from_old_row(spark, old, new):
    o, n = frame(spark, old, 1), frame(spark, new, 2)
    out = as_dict(upsert(o, n, ["k"], keep=["first"]))
    for k in new:
        assert out[k] == (new[k], 1 if k in old else 2)
    for k in set(old) - set(new):
        assert out[k] == (old[k], 1)


def test_null_keys_match_null_safely(spark):
    o = spark.createDataFrame([(None, 1, 0)], "k int, v int, first int")
    n = spark.createDataFrame([(None, 5, 0)], "k int, v int, first int")
    assert [tuple(r) for r in upsert(o, n, ["k"]).collect()] == [(None, 5, 0)]
