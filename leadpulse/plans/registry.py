"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from leadpulse.plans.batch import BATCH_QUERIES
from leadpulse.plans.oracle import ORACLE_SQL
from leadpulse.plans.stateful import STATEFUL_ORACLE_SQL, STATEFUL_QUERIES
from leadpulse.plans.streams import STREAM_ORACLE_SQL, STREAM_QUERIES


def queries() -> dict:
    """name -> callable(spark, sf_dir) -> DataFrame."""
    return {**BATCH_QUERIES, **STREAM_QUERIES, **STATEFUL_QUERIES}


def oracle_sql() -> dict:
    """name -> DuckDB SQL, for the queries that have one."""
    out = {**ORACLE_SQL, **STREAM_ORACLE_SQL, **STATEFUL_ORACLE_SQL}
    return {k: v for k, v in out.items() if k in queries()}
