import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from leadpulse.llm import registry, sharding


def check(rows, docs, shards=24):
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
                  for d, t in docs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[i]) for i in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    # The row number follows the ids, and shard and slot follow from it.
    by_row = sorted(rows, key=lambda r: r.row)
    assert [r.row for r in by_row] == list(range(len(rows)))
    ids = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in by_row]
    assert ids == sorted(ids)
    shard, slot = sharding.place(np.arange(len(rows)), len(rows), shards)
    assert [(r.shard, r.slot) for r in by_row] == list(zip(shard.tolist(), slot.tolist()))


def test_query(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    rows = registry.QUERIES["op10_sharding"](spark, small_dir).collect()
    check(rows, map(tuple, docs.collect()))
    again = registry.QUERIES["op10_sharding"](spark, small_dir).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_odd_documents(spark, odd_docs, no_docs):
    check(sharding.shard_documents(spark, odd_docs).collect(),
          map(tuple, odd_docs.select("doc_id", "text").collect()))
    assert sharding.shard_documents(spark, no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 100, 1000, 4097, 70000])
def test_permutation_and_its_inverse(n):
    p = sharding.Permutation(n, 7)
    at = p.position(np.arange(n))
    assert sorted(at.tolist()) == list(range(n))
    assert (p.row(at) == np.arange(n)).all()
    assert sharding.row_at(int(at[n // 2] % 24), int(at[n // 2] // 24), n, seed=7) == n // 2


def test_shuffle_spreads_neighbours():
    shard, _ = sharding.place(np.arange(24000), 24000)
    follow = Counter(zip(shard[:-1].tolist(), shard[1:].tolist()))
    assert len(follow) > 560 and max(follow.values()) < 100
