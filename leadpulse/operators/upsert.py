"""Keyed upsert of result tables (K5, K6).

A result table is replaced row by row by key: ``REPLACE`` semantics (K5) by
default, or with some columns kept from the old row (K6 keeps the first
``lz_date`` and ``create_time``). Rows carry absolute values, never deltas,
so applying the same change twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key_match(keys: Sequence[str], left: str, right: str):
    cond = None
    for k in keys:
        c = F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        cond = c if cond is None else cond & c
    return cond


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str],
           keep: Sequence[str] = ()) -> DataFrame:
    """``old`` with every key of ``new`` replaced by the new row.

    Columns in ``keep`` keep the old value when the key existed. Keys match
    NULL-safely. Both inputs have the same columns; the result has
    ``new``'s column order.
    """
    keys = list(keys)
    columns = new.columns
    if not keep:
        # REPLACE: new rows, plus the old rows whose key is not in new.
        untouched = old.alias("o").join(new.select(*keys).alias("n"),
                                        _key_match(keys, "o", "n"), "left_anti")
        return new.unionByName(untouched.select(*columns))
    marked_old = old.withColumn("_is_old", F.lit(True))
    marked_new = new.withColumn("_is_new", F.lit(True))
    joined = marked_old.alias("o").join(marked_new.alias("n"), _key_match(keys, "o", "n"),
                                        "full_outer")
    is_new = F.col("n._is_new").isNotNull()
    is_old = F.col("o._is_old").isNotNull()
    out = []
    for c in columns:
        if c in keep:
            value = F.when(is_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        else:
            value = F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        out.append(value.alias(c))
    return joined.select(*out)
