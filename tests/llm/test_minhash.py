import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadpulse.llm import minhash, registry

SF = "/root/testdata/sf0.01"


def plain(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute(rows):
    """Sorted (doc_id, n_shingles, component_id, kept) of (doc_id, text) rows, by an
    inverted index and union-find."""
    sets = [plain(t) for _, t in rows]
    to = list(range(len(rows)))

    def find(x):
        while to[x] != x:
            x = to[x]
        return x
    having = {}
    for i, s in enumerate(sets):
        common = {}
        for shingle in s:
            for j in having.setdefault(shingle, []):
                common[j] = common.get(j, 0) + 1
            having[shingle].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                x, y = find(i), find(j)
                to[max(x, y)] = min(x, y)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        root = low.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), root, doc_id is not None and doc_id == root))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.QUERIES["op11_minhash"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert result(got) == want
    assert any(r[0] != r[2] for r in want)


def near_copies(n, seed=3):
    """Copies of one text with 2 to 16 of its 120 words changed: a dense group with
    links, near misses and single texts; and texts that share a long passage alone."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(2, 16)):
            words[at] = f"x{rng.randrange(10 ** 9)}"
        rows.append((i, " ".join(words)))
    for i in range(n, n + n // 4):
        own = [f"y{rng.randrange(10 ** 9)}" for _ in range(60)]
        rows.append((i, " ".join(base[:90] + own)))
    return rows


@pytest.mark.parametrize("rows", [64, 512])
def test_dense_groups_lose_no_link(spark, monkeypatch, rows):
    texts = near_copies(400)
    monkeypatch.setattr(minhash, "TILE_ROWS", rows)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    want = brute(texts)
    assert result(minhash.near_duplicates(spark, docs)) == want
    groups = [r[2] for r in want]
    assert max(map(groups.count, set(groups))) > 50 and len(set(groups)) > 100


def test_estimates_and_pruning():
    rng = random.Random(5)
    for shared in (300, 500, 700, 900):
        both = [rng.getrandbits(64) for _ in range(shared)]
        a = np.sort(np.array(both + [rng.getrandbits(64) for _ in range(1000 - shared)], np.uint64))
        b = np.sort(np.array(both + [rng.getrandbits(64) for _ in range(1000 - shared)], np.uint64))
        similar = shared / (2000 - shared)
        equal = (minhash.minima(a) == minhash.minima(b)).mean()
        assert abs(equal - similar) < 0.12
    # A pair at the threshold goes on through all batches; what is far away is dropped early.
    draws = np.random.default_rng(1).random((20000, minhash.HASHES))
    for similar, most in ((0.8, 0), (0.3, 1)):
        match = draws < similar + (1 - similar) / 4
        alive = np.ones(len(draws), bool)
        for nth, least in enumerate(minhash.LEAST):
            alive &= match[:, :(nth + 1) * minhash.BATCH].sum(axis=1) >= least
        assert (~alive).mean() == most
    assert 1 - (1 - 0.8 ** minhash.BAND_ROWS) ** minhash.BANDS > 1 - 1e-9


def test_signature_columns_survive_like_arrays(spark):
    rng = np.random.default_rng(4)
    words = minhash.HASHES * minhash.BITS // 64
    a = rng.integers(-2 ** 63, 2 ** 63, (3000, words))
    b = a.copy()
    for row, changed in zip(b, np.linspace(0, 300, len(b)).astype(int)):
        for at in rng.integers(0, 64 * words, changed):
            row[at // 64] ^= np.int64(-2 ** 63) if at % 64 == 63 else np.int64(1 << at % 64)
    want = minhash.plausible(a.view(np.uint8), b.view(np.uint8))
    rows = spark.createDataFrame([(i, x.tolist(), y.tolist()) for i, (x, y) in enumerate(zip(a, b))],
                                 "i int, a array<long>, b array<long>")
    got = rows.select("i", minhash.survives(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.s for r in sorted(got)] == want.tolist() and 0 < want.sum() < len(want)


def test_intersections_of_blocks():
    rng = np.random.default_rng(2)
    left, right = ([np.unique(rng.integers(0, 9000, rng.integers(1, 3000))) for _ in range(n)]
                   for n in (7, 5))
    got = minhash._intersections(left, right)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = minhash.near_duplicates(spark, odd_docs)
    assert result(got) == brute(rows)
    assert minhash.near_duplicates(spark, no_docs).collect() == []
    some = odd_docs.select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert {r.component_id for r in minhash.near_duplicates(spark, some).collect()} == {None}


def test_repeated_rows_with_one_id(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "p q r s t u"), (2, "a b c d e f g"),
            (None, "a b c d e f"), (None, "a b c d e f"), (3, None), (3, ""), (3, "one"),
            (4, "ONE")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(spark, docs)) == brute(rows)
