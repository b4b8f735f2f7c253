import hashlib

import numpy as np
import pytest

from leadpulse.llm import fingerprints as fp
from leadpulse.llm import registry


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        yield doc_id, text, text[:len(text) - half] + after[:half], after


def test_query_against_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = {r.doc_id: r for r in registry.QUERIES["op3_fingerprints"](spark, small_dir).collect()}
    errors = []
    for doc_id, text, edited, after in expected([(r.doc_id, r.text) for r in docs.collect()]):
        r = got.pop(doc_id)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fp.encode(fp.sketch(text))
        assert r.edited_fingerprint == fp.encode(fp.sketch(edited))
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, after)]
    assert not got
    assert np.abs(errors).max() < 0.2 and abs(np.mean(errors)) < 0.01


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    want = sorted((str(d), len(t), hashlib.sha256(e.encode()).hexdigest(),
                   fp.encode(fp.sketch(t))) for d, t, e, _ in expected(rows))
    got = fp.with_next(spark, odd_docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint)
                  for r in got) == want
    one = fp.with_next(spark, odd_docs.where("doc_id = 4")).collect()
    assert [r.near_next for r in one] == [1.0]
    assert fp.with_next(spark, no_docs).count() == 0


def test_every_range_split_gives_the_same_rows(spark, small_dir, monkeypatch):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    want = sorted(map(tuple, fp.with_next(spark, docs).collect()))
    monkeypatch.setattr(fp, "RANGES_PER_PARTITION", 60)
    assert sorted(map(tuple, fp.with_next(spark, docs).collect())) == want


def test_sketches_merge_and_estimate():
    words = [f"w{i}" for i in range(9000)]
    a, b = " ".join(words[:6000]), " ".join(words[3000:])
    sa, sb = fp.sketch(a), fp.sketch(b)
    assert fp.distinct(sa) == pytest.approx(5996, rel=0.25)
    assert fp.resemblance(sa, sb) == pytest.approx(1 / 3, abs=0.12)
    assert fp.containment(sa, sb) == pytest.approx(0.5, abs=0.2)
    parts = [" ".join(words[i:i + 504]) for i in range(0, 9000, 500)]
    whole = fp.EMPTY
    for part in parts:
        whole = fp.merge(whole, fp.sketch(part))
    assert (whole == fp.sketch(" ".join(words))).all()
    assert (fp.decode(fp.encode(sa)) == sa).all()
    assert fp.distinct(fp.sketch("a b c d e f")) == 2 and len(fp.sketch("")) == 0
    long = "x y z " * 200_000  # in several pieces, all repeats
    assert len(fp.sketch(long)) == 3


def test_parts_merge_in_spark(spark):
    words = [f"w{i}" for i in range(700)]
    rows = [("a", " ".join(words[i:i + 104])) for i in range(0, 700, 100)] + [("b", ""), ("b", None)]
    parts = fp.fingerprint(spark, spark.createDataFrame(rows, "key string, text string"))
    got = {r["key"]: r.sketch for r in fp.merge_parts(parts, "key").collect()}
    assert got["b"] == []
    assert (np.array(got["a"], dtype=np.int64).view(np.uint64) == fp.sketch(" ".join(words))).all()
