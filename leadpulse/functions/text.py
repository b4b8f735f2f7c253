"""Column functions on message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value is blank when it is NULL or holds only characters <= U+0020, the
# set a JVM String.trim() removes. Spark's trim() strips only spaces.
# ``\\z`` is the very end: ``$`` would also match before a last line separator.
_BLANK = r"\A[\x00-\x20]*\z"

# Flags as a JSON binder reads them into a boolean: the two words with a small
# or capital first letter, trimmed, and integers (0 is false).
_TRUE = r"\A(?:[\x00-\x20]*[tT]rue[\x00-\x20]*|-?0*[1-9][0-9]*)\z"
_FALSE = r"\A(?:[\x00-\x20]*[fF]alse[\x00-\x20]*|-?0+)\z"


def _literal(spark, pattern: str) -> str:
    """A pattern as a SQL literal for ``spark``'s parser.

    A raw literal R'...' keeps the backslashes as written; with the legacy
    setting ``spark.sql.parser.escapedStringLiterals`` a plain literal does.
    """
    legacy = str(spark.conf.get("spark.sql.parser.escapedStringLiterals", "false")).lower() == "true"
    return ("'" if legacy else "R'") + pattern + "'"


def blank_pattern_sql(spark) -> str:
    """The blank pattern as a SQL literal."""
    return _literal(spark, _BLANK)


def flag_patterns_sql(spark) -> tuple[str, str]:
    """The patterns of true and false flags as SQL literals."""
    return _literal(spark, _TRUE), _literal(spark, _FALSE)


# The parse is SQL text (for ``selectExpr``); ``blank`` is the literal from
# :func:`blank_pattern_sql`, ``flags`` those from :func:`flag_patterns_sql`.
def blank_to_null_sql(expr: str, blank: str) -> str:
    """NULL for a blank value, else the value as it is (not trimmed)."""
    return f"CASE WHEN NOT ({expr} RLIKE {blank}) THEN {expr} END"


def to_flag_sql(expr: str, flags: tuple[str, str]) -> str:
    """Nullable boolean from the forms a producer sends; NULL for any other."""
    return f"CASE WHEN {expr} RLIKE {flags[0]} THEN true WHEN {expr} RLIKE {flags[1]} THEN false END"


def bad_flag_sql(expr: str, blank: str, flags: tuple[str, str]) -> str:
    """TRUE for a flag that is neither blank nor a boolean."""
    return (f"(NOT ({expr} IS NULL OR {expr} RLIKE {blank})"
            f" AND NOT ({expr} RLIKE {flags[0]} OR {expr} RLIKE {flags[1]}))")


def unquote_csv_json(c: Column) -> Column:
    """Undo CSV quoting around a JSON object, as three literal replaces."""
    unwrapped_open = F.replace(c, F.lit('"{"'), F.lit("{"))
    unwrapped = F.replace(unwrapped_open, F.lit('"}"'), F.lit("}"))
    return F.replace(unwrapped, F.lit('""'), F.lit('"'))


def json_string_field(c: Column, name: str) -> Column:
    """Text of a string field read straight from (possibly broken) JSON."""
    return F.regexp_extract(c, '"' + name + r'"\s*:\s*"([^"]*)"', 1)
