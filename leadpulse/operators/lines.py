"""Lead <-> archived line.

The line is the archive's format: 20 fields joined by ``;``, ``\\N`` for a
missing value, then the source tag. Values are written raw, so a ``;`` inside
a value shifts later positions when the line is split again; the typed
columns are the source of truth and the line exists only at the archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpulse.schema import FLAG_FIELDS, LEAD_FIELDS, LINE_SEPARATOR, LINE_TAG, MISSING


def line_of(fields=LEAD_FIELDS) -> Column:
    """The archive line of the lead columns ``fields`` (P5).

    ``concat_ws`` skips NULLs, so each field is first replaced by ``\\N``.
    """
    parts = [F.coalesce(F.col(f).cast("string"), F.lit(MISSING)) for f in fields]
    return F.concat_ws(LINE_SEPARATOR, *parts, F.lit(LINE_TAG))


def to_line(df: DataFrame, name: str = "line") -> DataFrame:
    """Add the archive line of each lead."""
    return df.withColumn(name, line_of())


def missing_line() -> Column:
    """The line of a lead with every field missing, without the tag."""
    return F.array_join(F.array_repeat(F.lit(MISSING), len(LEAD_FIELDS)), LINE_SEPARATOR)


def line_field(line: Column, name: str) -> Column:
    """Field ``name`` of a line by position, ``\\N`` read back as NULL.

    Flags come back as the text ``true`` / ``false``, as the line holds them.
    """
    position = LEAD_FIELDS.index(name)
    value = F.get(F.split(line, LINE_SEPARATOR, -1), position)
    return F.nullif(value, F.lit(MISSING))


def from_line(df: DataFrame, line_col: str = "line", fields=LEAD_FIELDS) -> DataFrame:
    """Split lines back into (text) lead fields."""
    line = F.col(line_col)
    return df.select(*[line_field(line, f).alias(f) for f in fields])


def flag_from_line(line: Column, name: str) -> Column:
    """A flag of a line as a nullable boolean (only ``true`` is true)."""
    if name not in FLAG_FIELDS:
        raise ValueError(f"{name} is not a flag")
    return line_field(line, name) == F.lit("true")
