"""JSON message -> typed lead (P1-P4, P12) and the quarantine of bad messages.

One ``from_json`` per message (kept under a one-row ``explode`` so that
Catalyst cannot copy it into pushed-down filters) with every field STRING; the typed
columns are derived from it with built-in expressions, so the whole parse
stays in the JVM. A message is bad when it is empty (NULL struct), is not a
JSON object (corrupt-record column set), carries a flag that is neither
blank nor a boolean, or has no ``ingest_ts`` where the input has that column (it
belongs to no day). Single-quoted JSON is malformed; an object in a text field
is kept as its JSON text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpulse.functions.dates import ingest_day
from leadpulse.functions.text import (bad_flag_sql, blank_pattern_sql, blank_to_null_sql,
                                      flag_patterns_sql, to_flag_sql, unquote_csv_json)
from leadpulse.schema import CORRUPT_COLUMN, FLAG_FIELDS, LEAD_FIELDS, LEAD_SCHEMA, TEXT_FIELDS

REASON = "_reason"
_PARSED = "_lead"

# Alias map that binds the field names the sample producers send.
PRODUCER_ALIASES = {"preLeadId": "leadId", "countryName": "countyName"}


def _schema_with_aliases(aliases: Mapping[str, str]) -> T.StructType:
    extra = [T.StructField(name, T.StringType()) for name in aliases
             if name not in LEAD_SCHEMA.fieldNames()]
    return T.StructType(LEAD_SCHEMA.fields + extra)


def parse_messages(df: DataFrame, value_col: str = "value",
                   aliases: Mapping[str, str] | None = None,
                   unquote: bool = False) -> DataFrame:
    """Parse every message; keep the input columns, add the 20 lead fields
    and ``_reason`` (NULL for a good message).

    ``aliases`` maps an extra JSON field name to a lead field; the alias is
    used when the lead field itself is blank. ``unquote`` first undoes CSV
    quoting (P12).
    """
    aliases = dict(aliases or {})
    value = F.col(value_col).cast("string")
    if unquote:
        value = unquote_csv_json(value)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN,
               "allowSingleQuotes": "false"}
    parsed = F.from_json(value, _schema_with_aliases(aliases), options)
    keep = [F.col(c) for c in df.columns if c not in LEAD_FIELDS]
    # The parse sits in a one-row Generate: filters on the parsed fields
    # cannot be pushed below it, so each message is parsed exactly once
    # (pushed through a Project, every conjunct would re-run from_json).
    with_struct = df.select(*keep, F.explode(F.array(parsed)).alias(_PARSED))

    # The typed projection is built as SQL text: one call instead of a few
    # hundred Column calls, each of which costs the driver a round trip.
    blank = blank_pattern_sql(df.sparkSession)
    flags = flag_patterns_sql(df.sparkSession)

    def field(name: str) -> str:
        return f"`{_PARSED}`.`{name}`"

    def text(name: str) -> str:
        expr = blank_to_null_sql(field(name), blank)
        for alias, target in aliases.items():
            if target == name:
                expr = f"coalesce({expr}, {blank_to_null_sql(field(alias), blank)})"
        return f"{expr} AS `{name}`"

    typed = [text(n) if n in TEXT_FIELDS else f"{to_flag_sql(field(n), flags)} AS `{n}`"
             for n in LEAD_FIELDS]
    reason = (f"CASE WHEN `{_PARSED}` IS NULL THEN 'empty'"
              f" WHEN {field(CORRUPT_COLUMN)} IS NOT NULL THEN 'malformed'"
              f" WHEN {bad_flag_sql(field(FLAG_FIELDS[0]), blank, flags)}"
              f" OR {bad_flag_sql(field(FLAG_FIELDS[1]), blank, flags)} THEN 'bad_flag'"
              + (" WHEN ingest_ts IS NULL THEN 'no_time'" if "ingest_ts" in df.columns else "")
              + f" END AS `{REASON}`")
    kept = [f"`{c}`" for c in df.columns if c not in LEAD_FIELDS]
    return with_struct.selectExpr(*kept, *typed, reason)


def parse_leads(df: DataFrame, value_col: str = "value",
                aliases: Mapping[str, str] | None = None,
                unquote: bool = False) -> DataFrame:
    """Good leads only, with ``day`` when the input has ``ingest_ts``."""
    return split_good(parse_messages(df, value_col, aliases, unquote))


def quarantine(df: DataFrame, value_col: str = "value",
               aliases: Mapping[str, str] | None = None,
               unquote: bool = False) -> DataFrame:
    """Bad messages as they arrived: ``value, ingest_ts, reason``."""
    return split_quarantine(parse_messages(df, value_col, aliases, unquote), value_col)


def split_quarantine(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Quarantine rows of an already parsed frame (see :func:`parse_messages`)."""
    ts = F.col("ingest_ts") if "ingest_ts" in parsed.columns else F.lit(None).cast("timestamp")
    return (parsed.filter(F.col(REASON).isNotNull())
            .select(F.col(value_col).alias("value"), ts.alias("ingest_ts"),
                    F.col(REASON).alias("reason")))


def split_good(parsed: DataFrame) -> DataFrame:
    """Good rows of an already parsed frame, with ``day``."""
    good = parsed.filter(F.col(REASON).isNull()).drop(REASON)
    if "ingest_ts" in parsed.columns:
        good = good.withColumn("day", ingest_day(F.col("ingest_ts")))
    return good
