import base64
import gzip
import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from leadpulse.llm import registry, warc

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
PAGES = "page_id long, url string, html string, payload string"


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def expected(pages, least=0):
    top = {}
    for page, html in pages:
        if page is not None:
            top[html or ""] = max(page, top.get(html or "", page))
    for page, html in pages:
        raw = (html or "").encode()
        own = top.get(html or "")
        revisit = len(raw) >= least and own is not None and page != own
        yield (page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
               "revisit" if revisit else "response", own if revisit else None)


def test_query_matches_oracle(spark, duck, small_dir):
    got = rows_of(registry.QUERIES["op9_warc"](spark, small_dir))
    res = duck.execute(registry.ORACLE_SQL["op9_warc"])
    names = [d[0] for d in res.description]
    want = sorted((tuple(r[names.index(c)] for c in COLUMNS) for r in res.fetchall()), key=str)
    assert got == want and got


def odd_pages():
    record = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    bodies = [None, "", "x", "same", "same", "same", record, record * 3, "a\r\n\r\nb\r\n\r\n",
              "WARC/1.0\r\n", "\r\n\r\n" + record[:-4], "é\U0001f600" * 3000, "big " * 200000]
    pages = [(i, f"http://h/{i}\r\nX: y", b, "p") for i, b in enumerate(bodies)]
    pages += [(60, "u", "aaaa", "p"), (60, "u", "zzzzzzzz", "p"), (59, "u", "aaaa", "p"),
              (58, "u", "zzzzzzzz", "p")]
    pages += [(5, None, "same", "p"), (None, None, "same", "p"), (None, None, "alone", None),
              (-7, "", "x", "p"), (40, "u", "same2" + record * 2, "p"),
              (41, "u", "same2" + record * 2, "p"),
              (50, "http://h/?" + "q" * 200000 + " WARC/1.1", "after a long address", "p"),
              (51, "data:" + " " * 100000 + "x", "after a long address", "p")]
    return pages


def test_odd_pages_and_magic_inside_payloads(spark):
    pages = odd_pages()
    df = spark.createDataFrame(pages, PAGES)
    assert rows_of(warc.round_trip(spark, df)) == sorted(
        expected([(p, h) for p, _, h, _ in pages]), key=str)
    assert rows_of(warc.round_trip(spark, df, least_bytes=4)) == sorted(
        expected([(p, h) for p, _, h, _ in pages], 4), key=str)
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_archives_are_bounded_gzip_files_of_records(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"page {i % 40}", "") for i in range(95)], PAGES)
    path = str(tmp_path / "archives")
    warc.write_archives(spark, df.coalesce(1), path, records_per_file=10)
    files = [gzip.decompress(f.read_bytes()) for f in (tmp_path / "archives").glob("*.gz")]
    assert sum(len(re.findall(rb"^WARC/1\.1\r$", f, re.M)) for f in files) == 95
    assert all(1 <= f.count(b"WARC/1.1\r\n") <= 10 for f in files)
    kinds = Counter(r.type for r in warc.read_archives(spark, path).collect())
    assert kinds == {"response": 40, "revisit": 55}
    members = b"".join(gzip.compress(x) for x in (b"a", b"bc", b""))
    assert warc.unpacked(members) == b"abc" and warc.unpacked(b"raw") == b"raw"


def test_archives_roll_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 5000)
    df = spark.createDataFrame([(i, "u", f"{i} " + "x" * 1000, "") for i in range(40)], PAGES)
    warc.write_archives(spark, df.coalesce(1), str(tmp_path / "a"))
    sizes = [gzip.decompress(f.read_bytes()).count(b"WARC-Type") for f in (tmp_path / "a").glob("*.gz")]
    assert sum(sizes) == 40 and max(sizes) <= 4


def test_pointer_jumping_equals_a_walk():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 50, 333):
        for _ in range(20):
            offset = rng.permutation(np.unique(np.append(rng.integers(0, 2000, n), [0] * (n > 0))))
            after = offset + rng.integers(1, 60, len(offset))
            snap = rng.random(len(offset)) < 0.9
            for i in np.flatnonzero(snap):  # most point to a candidate
                later = offset[offset > offset[i]]
                if len(later):
                    after[i] = later.min() if rng.random() < 0.8 else rng.choice(later)
            to, want, at = dict(zip(offset.tolist(), after.tolist())), set(), 0
            while at in to:
                want.add(at)
                at = to[at]
            assert set(offset[warc.reachable(offset, after)].tolist()) == want


def test_damage_ends_the_chain():
    def record(body):
        return b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (
            len(body), body)
    good = record(b"H\r\n\r\none") + record(b"H\r\n\r\ntwo")
    found = list(warc.candidates(good + good[:-5] + record(b"H\r\n\r\nlost")))
    keep = warc.reachable(np.array([c[0] for c in found]), np.array([c[1] for c in found]))
    assert [c[6] for c, k in zip(found, keep) if k] == [3, 3, 3]
    assert list(warc.candidates(b"WARC/1.1\r\nContent-Length: x\r\n\r\n")) == []


def test_many_starts_before_one_blank_line():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    body = b"WARC/1.1\r\n" * 300000  # no header ends inside
    data = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body) + record
    found = list(warc.candidates(data))
    assert [c[0] for c in found] == [0, len(data) - len(record)]
    inner = b"WARC/1.1\r\nA: b\r\n" + record  # both starts have the length after them
    assert [(c[0], c[2]) for c in warc.candidates(inner)] == [(0, "response"), (16, "response")]
    late = b"WARC/1.1\r\nContent-Length: 2\r\nX: WARC/1.1\r\n\r\nab\r\n\r\n"
    assert [c[0] for c in warc.candidates(late)] == [0]


def test_a_broken_chain_is_an_error(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    for name, data in (("cut", record * 2 + record[:-3]), ("none", b"text"), ("gap", b"x" + record)):
        (tmp_path / name).write_bytes(gzip.compress(data))
        with pytest.raises(Exception, match="chain of records|no record"):
            warc.read_archives(spark, str(tmp_path / name)).collect()
    (tmp_path / "good").write_bytes(gzip.compress(record * 3))
    assert warc.read_archives(spark, str(tmp_path / "good")).count() == 3
