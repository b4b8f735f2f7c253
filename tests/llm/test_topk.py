import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadpulse.llm import registry, topk


def test_query_matches_oracle(spark, duck, small_dir):
    df = registry.QUERIES["op1_pivot_topk"](spark, small_dir)
    got = sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score"))
                 for r in df.collect())
    want = sorted(duck.execute(registry.ORACLE_SQL["op1_pivot_topk"]).fetchall())
    assert got == want and len(got) > 0


def brute(rows, k):
    """Of (vec_id, vector) rows; every second id is a query."""
    out = []
    for n, (qid, q) in enumerate(rows):
        if qid % 2:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, v)), i) for m, (i, v) in enumerate(rows)
                       if m != n and len(v) == len(q))
        out += [(qid, rank + 1, i, -s) for rank, (s, i) in enumerate(found[:k])]
    return sorted(out)


VECTORS = "vec_id long, v array<long>"


@pytest.mark.parametrize("block, pivots", [(4096, 256), (7, 4)])
def test_against_brute_force_with_ties_blocks_and_repeated_ids(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "CHUNK", 3)
    rng = np.random.default_rng(1)
    rows = [(i % 50, rng.integers(-3, 4, 4).tolist()) for i in range(60)]  # many ties
    rows += [(60 + i, rng.integers(-9, 9, 2).tolist()) for i in range(6)] + [(70, [0] * 4)] * 2
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.top_k(spark, df, F.col("vec_id") % 2 == 0, k=5, pivots=pivots)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_sql_on_repeated_ids(spark, duck):
    rows = [(7, [1.0, 1.0]), (7, [5.0, 5.0]), (0, [1.0, 2.0]), (0, [2.0, 1.0]), (100, [0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(spark, topk.integer_vectors(df, "vec_id", "embedding"), F.col("vec_id") % 100 == 0)
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding double[])")
    con.executemany("insert into embeddings values (?, ?)", rows)
    want = sorted(con.execute(registry.ORACLE_SQL["op1_pivot_topk"]).fetchall())
    assert sorted(map(tuple, got.collect())) == want and len(want) == 12


def share(x, queries, pivots, k=10):
    """Share of the candidates that the bounds let through, and of rows in the cells that a
    query is sent to, after its own cell."""
    p = topk.choose_pivots(x[: topk.PIVOT_SAMPLE].astype(float), pivots)
    angles, lengths = topk.pivot_angles(x.astype(float), p)
    cell, ids = angles.argmin(axis=1), np.arange(len(x))

    class Row(dict):
        __getattr__ = dict.__getitem__
    cells = topk.Cells([Row(cell=c, low=angles[cell == c].min(axis=0).tobytes(),
                            high=angles[cell == c].max(axis=0).tobytes(),
                            length=lengths[cell == c].max()) for c in np.unique(cell)])
    evaluated, sent = [], 0
    for q in queries:
        one = [q], [q], x[[q]], angles[[q]], lengths[[q]]
        own = cell == cell[q]
        first = list(topk.search_block((*one, [-np.inf]), (
            ids[own], ids[own], x[own], angles[own], lengths[own]), k, evaluated))
        least = sorted(r[3] for r in first)[-k] if len(first) >= k else -np.inf
        go = np.isin(cell, cells.worth(angles[q], lengths[q], least)) & ~own
        sent += go.sum()
        found = first + list(topk.search_block((*one, [least]), (
            ids[go], ids[go], x[go], angles[go], lengths[go]), k, evaluated))
        order = sorted((-int(x[q] @ x[i]), int(i)) for i in ids if i != q)[:k]
        assert sorted((-r[3], r[2]) for r in found)[:k] == order
    return sum(evaluated) / len(queries) / len(x), sent / len(queries) / len(x)


def test_bounds_skip_cells_and_candidates_and_keep_the_best():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 4000
    x = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(2000, 16)) * 300).astype(int)
    x = x[rng.permutation(len(x))]
    evaluated, sent = share(x, range(20), 64)
    assert evaluated < 0.15 and sent < 0.3
    units = rng.normal(size=(2000, 24))
    units = np.floor(1024 * units / np.linalg.norm(units, axis=1)[:, None]).astype(int)
    evaluated, _ = share(units, range(10), 256)
    assert evaluated < 0.6


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], "x"), (2, [1.0, None], "x"), (4, None, "x"), (6, [nan, 1.0], "x"),
            (8, [inf, 1.0], "x"), (None, [1.0, 1.0], "x"), (10, [1.0, 2.0, 3.0], "x"),
            (1, [0.5, -0.0005], "x"), (1, [0.5, -0.0005], "x"), (3, [1e15, 1e15], "x"), (5, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    ints = topk.integer_vectors(df, "vec_id", "embedding")
    got = sorted(map(tuple, topk.top_k(spark, ints, F.col("vec_id") % 2 == 0).collect()))
    big = int(np.floor(np.float64(np.float32(1e15)) * 1024))
    assert 3072 * big >= 1 << 63  # clipped
    small = 1024 * 512 - 2048
    assert got == [(0, 1, 3, (1 << 63) - 1), (0, 2, 1, small), (0, 3, 1, small)]
    assert topk.top_k(spark, ints.limit(0), F.col("vec_id") % 2 == 0).count() == 0
