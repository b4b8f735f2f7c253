import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadpulse.llm import mixing, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes, weights=(5, 2, 1), most=3.0):
    """Targets by resharing the excess again and again."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def check(rows, near=0.02):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = reshared(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(near * t, 30), (s, taken[s], t)


def test_query(spark, small_dir):
    df = registry.QUERIES["op2_mix_sources"](spark, small_dir)
    rows = df.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet")
             .collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.size == len(WORD.findall(texts[r.doc_id] or "")) for r in rows)
    # Sources of ten documents: the error is what their small documents leave.
    check(rows, near=0.2)
    again = registry.QUERIES["op2_mix_sources"](spark, small_dir).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 20)
    monkeypatch.setattr(mixing, "FAN", 3)
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 97 + 1).cast("int"))
        .alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise(
            F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = mixing.mix(spark, docs).collect()
    assert len(rows) == 3000
    check(rows)
    copies = defaultdict(set)
    for r in rows:
        copies[r.source].add(r.copies)
    assert all(max(c) - min(c) <= 1 for c in copies.values())


def test_pivotal_pass_keeps_the_sum_and_the_expectation():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 50, 40).astype(float)
    p = rng.random(40)
    total = np.zeros(40)
    for _ in range(4000):
        q, at = mixing.pivotal_pass(size, p, rng.random(40))
        assert q @ size == pytest.approx(p @ size)
        assert sum(1 for x in q if 0 < x < 1) <= 1
        assert at == -1 or 0 < q[at] < 1
        total += q
    assert np.abs(total / 4000 - p).max() < 0.05


def test_odd_documents(spark, odd_docs, no_docs):
    rows = mixing.mix(spark, odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check(rows, near=1)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix(spark, no_docs).count() == 0
    taken = defaultdict(int)
    for r in rows:
        taken[r.doc_id] += r.copies
    out = mixing.mixed_documents(spark, odd_docs)
    assert out.columns == odd_docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert got == {k: n for k, n in taken.items() if n}
    assert mixing.mixed_documents(spark, no_docs).count() == 0
