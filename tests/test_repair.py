"""Lines with separators in their values, values without a type, lenient dates."""

import contextlib
import io
import itertools
import json
import math
import random
import re

from pyspark.sql import functions as F

from leadpulse.functions.dates import lenient_date
from leadpulse.operators import repair
from leadpulse.operators.repair import (FREE, KINDS, MARGIN, PLACES, kind_of, learn_kinds,
                                        repair_lines)
from leadpulse.operators.untyped import reply_variant, unknown_fields, variant_value
from leadpulse.schema import LEAD_FIELDS
from leadpulse.session import scratch_dir
from leadpulse.sinks.archive import read_archive, recheck, write_archive


def a_lead(rng, name="Mueller & Co"):
    code = str(rng.randrange(1000, 9999))
    return [f"id-{rng.randrange(10 ** 6)}", "2024-03-01 10:00:00", code, name, code, "North County", code,
            "New Town", code, "East Province", code, "South Region", code, "Big Car", "ON", code,
            "phone", "web", "true", rng.choice(["false", "\\N"])]


def line(fields):
    return ";".join([*fields, "lead_center"])


def test_lines_are_put_right_or_reported(spark):
    rng = random.Random(1)
    regular = [line(a_lead(rng)) for _ in range(300)]
    shifted = [a_lead(rng, "Smith; Sons;Co"), a_lead(rng, ";"), a_lead(rng, "a;1")]
    vague = a_lead(rng)
    vague[16] = "phone;call"                                     # as well the next level's
    broken = ["", "a;b", line(a_lead(rng))[:-3], line(a_lead(rng)) + ";x", ";".join(["x"] * 20)]
    lines = regular + [line(f) for f in shifted] + [line(vague), line(a_lead(rng)) + "\t "] + broken
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(lines + [None])],
                               "n int, line string, status_ string")
    got = {r.n: r for r in repair_lines(df, learn_kinds(df)).collect()}
    for n in range(300):
        assert got[n].status == "whole" and got[n].fields == lines[n].split(";")[:-1]
    for n, fields in enumerate(shifted, 300):
        assert (got[n].status, got[n].fields) == ("repaired", fields)
    assert (got[303].status, got[303].fields) == ("ambiguous", None)
    assert got[304].status == "whole" and len(got[304].fields) == len(LEAD_FIELDS)
    assert {got[n].status for n in range(305, 311)} == {"broken"}
    none = df.where("n < 0")
    assert repair_lines(none, learn_kinds(none)).collect() == []
    unknown = repair_lines(df.where("n = 300"), learn_kinds(none)).first()
    assert unknown.status == "ambiguous"                         # nothing to learn from


def test_alignments_are_the_best_of_all(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(line(a_lead(rng)),) for _ in range(100)], "line string")
    table = learn_kinds(df)
    odd = [";".join(f[:4]) + ";" * (extra + 1) + ";".join(f[4:]) + ";lead_center"
           for extra in (1, 2, 3) for f in [a_lead(rng, rng.choice(("a b", "", "7", "x")))]
           for _ in range(4)]
    odd += [line(a_lead(rng, name)) for name in ("a;b", "1;2", "x y;z;;", "\\N;\\N", "true; ;9")]
    odd += [line(f[:16] + ["phone;call"] + f[17:]) for f in [a_lead(rng)]]  # as well the next level's
    several = [repair.JOINED + math.log(sum(math.exp(row[KINDS.index(k)]) for k in FREE)) for row in table]

    def best_two(text):
        pieces = text.split(";")
        ways = []
        for cuts in itertools.combinations_with_replacement(range(PLACES), len(pieces) - PLACES):
            takes = [1 + cuts.count(at) for at in range(PLACES)]
            at, gain = 0, 0.0
            for place, take in enumerate(takes):
                gain += table[place][kind(pieces[at])] if take == 1 else several[place]
                at += take
            ways.append((gain, takes))
        return sorted(ways, reverse=True)[:2]

    def fields(text):
        pieces, (best, after) = text.split(";"), best_two(text)
        if best[0] - after[0] < MARGIN:
            return "ambiguous", None
        ends = list(itertools.accumulate(best[1]))
        return "repaired", [";".join(pieces[e - t:e]) for e, t in zip(ends, best[1])][:-1]

    got = repair_lines(spark.createDataFrame([(t,) for t in odd], "line string"), table).collect()
    assert {r.line: (r.status, r.fields) for r in got} == {t: fields(t) for t in odd}
    assert {r.status for r in got} == {"ambiguous", "repaired"}


def kind(piece):
    tests = (piece == "\\N", re.match(r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", piece), piece in ("true", "false"),
             re.search(r"\A-?[0-9]+\n?\Z", piece), piece == "lead_center", piece == "",
             not re.search(r"[ \t\n\x0b\f\r]", piece))
    return next((n for n, t in enumerate(tests) if t), len(tests))


def test_kinds_of_odd_pieces(spark):
    pieces = ["", " ", "-", "--1", "-0", "12", "12\n", "\n12", "12 ", "1.5", "/", ":", "9:", "2024-1-1", "2024-03-011x",
              "2024-", "2024-03-01 10:00", "-2024-03-01", "\u0661\u0662", "\u2028", "a\u00a0b", "a\u2028b",
              "a\tb", "a\x0bb", "a\fb", "a\rb", "\\N", "\\n", "true", "True", "lead_center", "\u00e9", "~"]
    rows = spark.createDataFrame([(p,) for p in pieces], "p string").select("p", kind_of(F.col("p")).alias("k"))
    assert {r.p: r.k for r in rows.collect()} == {p: kind(p) for p in pieces}


def test_regular_lines_are_not_aligned(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(line(a_lead(rng)),) for _ in range(3)], "line string")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        repair_lines(df, learn_kinds(df)).explain()
    plan = out.getvalue()
    # kinds are computed where pieces are too many; a whole line is a slice of its pieces
    assert re.search(r"> 21\)\) THEN transform\(_pieces", plan) and "array_repeat" not in plan
    assert re.search(r"= whole\) THEN slice\(_pieces", plan) and "sort_array" not in plan


def test_variants_of_replies_and_unknown_fields(spark):
    texts = ['{"code":"x","data":{"a":[1,"b"]}}', '{"code":7,"data":null}', '{"code":7}', "", "[1]", None,
             '{"data":1.5,"status":3}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        reply_variant(F.col("t")).alias("r")).select("r.*", variant_value(
            F.col("r.data"), "$.a[1]", "string").alias("b")).drop("data").collect()
    assert [(r.code, r.status, r.data_type, r.b) for r in rows] == [
        (None, None, "OBJECT<a: ARRAY<VARIANT>>", "b"), (7, None, "VOID", None), (7, None, None, None),
        (None,) * 4, (None,) * 4, (None,) * 4, (None, "3", "DECIMAL(2,1)", None)]
    values = [{"leadId": 1, "x": 1}, {"x": 2, "y": {"z": True}}, {"x": None, "y": {"z": "t"}}, [1]]
    df = spark.createDataFrame([(json.dumps(v),) for v in values] + [("{",), (None,)], "value string")
    got = {(r.field, r.messages, r.kind) for r in unknown_fields(df).collect()}
    assert got == {("x", 3, "BIGINT"), ("y", 2, "OBJECT<z: VARIANT>")}


def test_lenient_dates_carry_over(spark):
    texts = ["2024-13-01", "2024-2-30 10:00", "2023-02-29", "2024-0-15", "2024-1-0", "2024-25-61x",
             "2024-03-01T00:00", "24-1-1", "", "soon", None, "2024-01", "9999-99999-99999"]
    got = [r.d for r in spark.createDataFrame([(t,) for t in texts], "t string").select(
        lenient_date(F.col("t")).cast("string").alias("d")).collect()]
    assert got[:8] == ["2025-01-01", "2024-03-01", "2023-03-01", "2023-12-15", "2023-12-31",
                       "2026-03-02", "2024-03-01", "0024-01-01"]
    assert got[8:12] == [None] * 4


def test_recheck_reads_the_days_that_differ_alone(spark):
    path = scratch_dir(spark, "recheck")
    leads = spark.createDataFrame([(f, "2024-03-0%d" % d) for d in (1, 2, 3) for f in "ab"],
                                  "leadId string, day string").select(
        *[F.col("leadId") if n == "leadId" else F.lit(None).cast("string").alias(n) for n in LEAD_FIELDS],
        F.to_date("day").alias("day"))
    write_archive(leads, path, "w-0000000000")
    counts = spark.createDataFrame([("2024-03-01", 2, 2), ("2024-03-02", 2, 1), ("2024-03-09", 1, 0)],
                                   "dt string, counted long, recorded long")
    again = recheck(read_archive(spark, path).withColumn("dt", F.col("dt").cast("string")), counts)
    assert sorted(map(tuple, again.collect())) == [("2024-03-02", 2, 1, 2), ("2024-03-09", 1, 0, 0)]
    counts.write.parquet(f"{path}-counts")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        recheck(read_archive(spark, path), spark.read.parquet(f"{path}-counts")).explain("formatted")
    assert "dynamicpruning" in out.getvalue()
