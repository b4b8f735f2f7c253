import random

import xxhash
from pyspark.sql import functions as F

from leadpulse.llm import registry, simhash
from leadpulse.llm.common import components


def plain(text, n=3):
    words = (text or "").encode().lower().split()
    parts = [words[i:i + n] for i in range(max(1, len(words) - n + 1))] if words else []
    h = [xxhash.xxh64_intdigest(b" ".join(p), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(pairs, nodes):
    to = {n: n for n in nodes}

    def find(x):
        while to[x] != x:
            to[x] = to[to[x]]
            x = to[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        to[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, bits=2):
    """(doc_id, fingerprint, component) of (doc_id, text) rows."""
    prints = [plain(t) for _, t in rows]
    distinct = sorted(set(prints))
    pairs = [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1:]
             if (a ^ b).bit_count() <= bits]
    of = roots(pairs, distinct)
    low = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            low[of[p]] = min(doc_id, low.get(of[p], doc_id))
    return sorted((str(d), f"{p:016x}", str(low.get(of[p]))) for (d, _), p in zip(rows, prints))


def test_query_against_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = registry.QUERIES["op4_simhash"](spark, small_dir).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(spark, odd_docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == brute(rows)
    assert simhash.near_duplicates(spark, no_docs).count() == 0
    kept = simhash.deduplicated(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(c for _, _, c in brute(rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(set(ids))
    assert simhash.deduplicated(spark, no_docs).count() == 0


def test_links_reach_what_all_pairs_reach(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):  # chains with steps of one to four bits
            prints.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    for bits in (0, 1, 2, 3):
        found = {tuple(sorted(r)) for r in simhash.links(df, bits).collect()}
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= bits for a, b in found)
        every = [(signed[a], signed[b]) for a in prints for b in prints
                 if a < b and (a ^ b).bit_count() <= bits]
        nodes = sorted(signed.values())
        assert roots(found, nodes) == roots(every, nodes)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 260)]            # a chain
    pairs += [(1000, i) for i in range(1001, 1200)]          # a star
    pairs += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(spark, df, "test").collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert got == roots([p for p in pairs if p[0] != p[1]], sorted(nodes))
    assert components(spark, df.where(F.lit(False)), "none").count() == 0
