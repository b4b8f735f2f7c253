"""Registered queries against their DuckDB oracles on the smallest tables."""

import datetime as dt
import json
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from leadpulse.plans import registry

TABLES = ("region", "nation", "customer", "orders", "events")
# Queries whose archive writes make one directory per fixture day; run with -m slow.
SLOW = {"archive_readback", "stream_archive"}


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def cell(v):
        if isinstance(v, (dt.date, dt.datetime)):
            return v.isoformat()
        return v
    return sorted(json.dumps([cell(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{small_dir}/{t}.parquet')")
    return con


def _check(spark, duck, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    got = _norm([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(E.oracle_sql()[name])
    want = _norm(res.fetchall(), [d[0] for d in res.description])
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert len(got) == len(want) and got == want


# The corpus operators have their own tests.
FAST = sorted(n for n in registry.oracle_sql() if n not in SLOW)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, small_dir, name):
    _check(spark, duck, small_dir, name)


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(SLOW))
def test_slow_query_matches_oracle(spark, duck, small_dir, name):
    _check(spark, duck, small_dir, name)


def test_every_query_is_registered_with_a_callable(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    qs = registry.queries()
    assert set(qs) <= set(E.queries())
    assert set(qs) == set(registry.oracle_sql())
    assert all(callable(q) for q in qs.values())


def test_every_test_module_is_collected():
    """Collection in a process of its own, as the whole suite is collected."""
    here = os.path.dirname(os.path.abspath(__file__))
    done = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", here],
                          capture_output=True, text=True, cwd=os.path.dirname(here))
    assert done.returncode == 0, done.stdout[-2000:]
    for folder, _, files in os.walk(here):
        for name in files:
            if name.startswith("test_") and name.endswith(".py"):
                assert f"{name}::" in done.stdout, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "total", "hq", "dealer"]
    assert df.count() > 0
