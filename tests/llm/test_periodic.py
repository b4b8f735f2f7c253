import hashlib
import random
import re
import zlib
from fractions import Fraction

from leadpulse.llm import periodic, registry

SF = "/root/testdata/sf0.01"


def brute_runs(words):
    """Every period by itself: stretches of equal words so far apart, by start, then
    period; those whose smallest period is another one left out."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                part = words[i:i + length]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, runs_of=brute_runs):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_of(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    text_runs = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(text_runs.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_equal_brute_force():
    rng = random.Random(1)
    seen = 0
    for _ in range(1500):
        kinds, words = rng.choice([1, 2, 3, 5, 50]), []
        for _ in range(rng.randint(0, 8)):
            if rng.random() < 0.6:
                root = [rng.randrange(kinds) for _ in range(rng.randint(1, 20))]
                words += (root * 100)[:rng.randint(1, 90)]
            else:
                words += [rng.randrange(kinds) for _ in range(rng.randint(1, 30))]
        want = brute_runs(words)
        assert periodic.word_runs([b"%d" % w for w in words]) == want
        seen += len(want)
    assert seen > 1000
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    assert periodic.word_runs(fib[-1]) == brute_runs(fib[-1]) != []


def test_suffix_tree_orders_and_extensions():
    rng = random.Random(2)
    for _ in range(200):
        codes = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 40))]
        tree = periodic.SuffixTree(codes)
        text = codes + [0]
        for inverse in (False, True):
            suffixes, _ = tree.tour(inverse)
            sign = -1 if inverse else 1
            want = sorted(range(len(text)), key=lambda i: [
                c and 10 + sign * c for c in text[i:]])
            assert suffixes.tolist() == want
        ahead = periodic.Extensions(*tree.tour())
        for i in range(len(codes)):
            for j in range(i):
                k = 0
                while text[i + k] == text[j + k]:
                    k += 1
                assert ahead.of(periodic.np.array([i]), periodic.np.array([j]))[0] == k


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in registry.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)

    def short(words):  # runs lie where eight words repeat; elsewhere brute force is not needed
        return brute_runs(words) if len(words) < 1500 else periodic.word_runs(words)
    some = 0
    for r in docs:
        want = brute_row(r.doc_id, r.text, short)
        assert got[r.doc_id] == want
        some += want[1]
    assert some > 50


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, periodic.report(spark, odd_docs).collect()), key=repr)
    want = sorted((brute_row(i, t, lambda w: brute_runs(w) if len(w) < 5000
                             else [(0, len(w), 3)]) for i, t in rows), key=repr)
    assert got == want and any(r[1] for r in got)
    assert periodic.report(spark, no_docs).collect() == []
    wide = periodic.with_runs(spark, odd_docs)
    assert wide.columns == odd_docs.columns + ["runs", "collapsed"]
    assert wide.where("doc_id = 6").select("collapsed").first()[0] == "lorem ipsum dolor"
