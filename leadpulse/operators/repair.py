"""Archived lines whose values hold the separator, put back in place.

A line is written raw, so a ``;`` inside a value gives more pieces than the line
has places and shifts all later ones. What a place usually holds is learned from
the regular lines: the share of each kind of value (number, time, flag, word ...)
per place, some 150 numbers. A line with extra pieces is then aligned: each place
takes one piece or several that follow one another, joined again, and the alignment
of the greatest likelihood is found by dynamic programming over the places, in
built-in higher-order functions. A line is ``repaired`` if no other alignment
comes near the best; where one does, it is ``ambiguous`` and its fields stay empty.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpulse.schema import LEAD_FIELDS, LINE_SEPARATOR, LINE_TAG, MISSING

PLACES = len(LEAD_FIELDS) + 1  # the tag is the last
KINDS = ("missing", "time", "flag", "number", "tag", "empty", "word", "text")
FREE = ("word", "text")        # kinds that may hold a separator
JOINED = math.log(1e-3)        # a value with a separator is that rare
MARGIN = 3.0                   # by which the best alignment must beat the next, as a logarithm
_NEVER = -1e9


_BLANKS = " \t\n\x0b\f\r"      # what ``\s`` matches


def pieces_of(line: Column) -> Column:
    return F.split(line, LINE_SEPARATOR, -1)


def kind_of(piece: Column) -> Column:
    """Number of the kind of a piece in :data:`KINDS`."""
    # Patterns only where the first byte may begin a time or a number ("-" to "9").
    digits = (piece >= "-") & (piece < ":")
    blank = reduce(or_, [F.contains(piece, F.lit(c)) for c in _BLANKS])
    kinds = (piece == MISSING, digits & piece.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"),
             piece.isin("true", "false"), digits & piece.rlike(r"^-?\d+$"), piece == LINE_TAG,
             piece == "", ~blank)
    out = F.lit(len(kinds))
    for number in range(len(kinds) - 1, -1, -1):
        out = F.when(kinds[number], F.lit(number)).otherwise(out)
    return out


def learn_kinds(lines: DataFrame, line: str = "line") -> list[list[float]]:
    """Logarithms of the share of each kind per place of the regular lines."""
    pieces = lines.select(pieces_of(F.col(line)).alias("p")).where(F.size("p") == PLACES)
    seen = pieces.select(F.posexplode("p").alias("place", "piece")).groupBy(
        "place", kind_of(F.col("piece")).alias("kind")).count()
    counts = {(r["place"], r["kind"]): r["count"] for r in seen.collect()}  # places x kinds
    out = []
    for place in range(PLACES):
        row = [counts.get((place, kind), 0) + 0.5 for kind in range(len(KINDS))]
        out.append([math.log(n / sum(row)) for n in row])
    return out


def _takes(kinds: Column, table: list[list[float]]) -> Column:
    """struct<best, next, takes>: the greatest likelihood of an alignment, that of the next
    one, and how many pieces each place takes in the best."""
    single = F.array(*[F.array(*map(F.lit, row)) for row in table])
    several = F.array(*[F.lit(JOINED + math.log(sum(
        math.exp(row[KINDS.index(kind)]) for kind in FREE))) for row in table])
    extra = F.size(kinds) - PLACES

    def state(best, after, takes) -> Column:
        return F.struct(best.alias("best"), after.alias("next"), takes.alias("takes"))

    nothing = F.array().cast("array<int>")
    none = state(F.lit(2 * _NEVER), F.lit(2 * _NEVER), nothing)
    start = F.transform(F.sequence(F.lit(0), extra), lambda e: state(
        F.when(e == 0, F.lit(0.0)).otherwise(F.lit(_NEVER)), F.lit(_NEVER), nothing))

    def place(states: Column, at: Column) -> Column:
        def with_extra(e: Column) -> Column:
            """The best ways to have spent ``e`` extra pieces up to this place."""
            def from_(before: Column) -> Column:
                old, take = F.get(states, before), e - before + 1
                gain = F.when(take == 1, F.get(F.get(single, at), F.get(kinds, at + before))
                              ).otherwise(F.get(several, at))
                return state(old["best"] + gain, old["next"] + gain,
                             F.concat(old["takes"], F.array(take)))

            def merge(top: Column, way: Column) -> Column:
                ahead = way["best"] > top["best"]
                return F.when(ahead, state(way["best"], F.greatest(top["best"], way["next"]), way["takes"])
                              ).otherwise(state(top["best"], F.greatest(top["next"], way["best"]),
                                                top["takes"]))

            return F.aggregate(F.transform(F.sequence(F.lit(0), e), from_), none, merge)

        return F.transform(F.sequence(F.lit(0), extra), with_extra)

    states = F.aggregate(F.sequence(F.lit(0), F.lit(PLACES - 1)), start, place)
    return F.get(states, extra)


def repair_lines(lines: DataFrame, table: list[list[float]], line: str = "line") -> DataFrame:
    """``lines`` with ``status`` and ``fields``: the text of each place, the tag left out.

    ``whole``: a regular line. ``repaired``: values held separators and were put together.
    ``ambiguous``: several alignments are as likely. ``broken``: fewer pieces than places, or
    no tag at the end. ``fields`` is NULL for the last two.
    """
    columns = [F.col(f"`{c}`") for c in lines.columns]
    text = F.col(line)
    text = F.when(F.contains(text, F.lit("\t ")), F.regexp_replace(text, "\t $", "")).otherwise(text)

    def once(df: DataFrame, step: Column, name: str) -> DataFrame:
        """``step`` in a one-row Generate, so that it is computed once per line."""
        return df.select("*", F.explode(F.array(step)).alias(name))

    p, way = F.col("_pieces"), F.col("_way")
    regular = F.size(p) == PLACES
    tagged = F.element_at(p, -1) == LINE_TAG
    # Kinds and alignments only of the lines with extra pieces; a regular line is its pieces.
    split = once(lines, pieces_of(text), "_pieces")
    kinds = once(split, F.when(tagged & (F.size(p) > PLACES), F.transform(p, kind_of)), "_kinds")
    aligned = once(kinds, F.when(F.col("_kinds").isNotNull(), _takes(F.col("_kinds"), table)), "_way")
    status = (F.when(text.isNull() | ~tagged | (F.size(p) < PLACES), F.lit("broken"))
              .when(regular, F.lit("whole"))
              .when(way["best"] - way["next"] >= MARGIN, F.lit("repaired"))
              .otherwise(F.lit("ambiguous")))
    takes = way["takes"]
    joined = F.transform(F.slice(takes, 1, len(LEAD_FIELDS)), lambda take, at: F.array_join(F.slice(
        p, F.aggregate(F.slice(takes, 1, at), F.lit(1), lambda a, b: a + b), take), LINE_SEPARATOR))
    fields = (F.when(F.col("status") == "whole", F.slice(p, 1, len(LEAD_FIELDS)))
              .when(F.col("status") == "repaired", joined))
    return (aligned.select(*columns, status.alias("status"), "_pieces", "_way")
            .select(*columns, "status", fields.alias("fields")))


def repaired_field(name: str, fields: Column | None = None) -> Column:
    """Field ``name`` of a repaired line, ``\\N`` read back as NULL."""
    fields = F.col("fields") if fields is None else fields
    return F.nullif(F.get(fields, LEAD_FIELDS.index(name)), F.lit(MISSING))
