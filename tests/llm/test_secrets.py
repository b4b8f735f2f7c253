import base64
import hashlib
import re

from leadpulse.llm import registry, secret_scan

SF = "/root/testdata/sf0.01"
KINDS = [("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                               r"""([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
         ("hex", re.compile(r"[0-9a-f]+"), 0, 16)]


def base(text):
    found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}")
             for k, (name, pattern, group, least) in enumerate(KINDS)
             for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [(k, t) for _, k, t in sorted(found)]


def check(rows, docs):
    want = []
    for doc_id, text in docs:
        spans = base(text)
        want.append((str(doc_id), *(sum(k == i for k, _ in spans) for i in range(3)),
                     hashlib.sha256(",".join(t for _, t in spans).encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows]
    assert sorted(got) == sorted(want)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = registry.QUERIES["op7_secret_scan"](spark, SF).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert any(r.n_live for r in rows)
    for r in rows:
        every = set(filter(None, r.spans.split(",")))
        assert set(filter(None, r.live_spans.split(","))) <= every


def test_odd_documents(spark, odd_docs, no_docs):
    check(secret_scan.report(spark, odd_docs).collect(),
          map(tuple, odd_docs.select("doc_id", "text").collect()))
    assert secret_scan.report(spark, no_docs).count() == 0
    assert secret_scan.redacted(spark, no_docs).count() == 0
    assert secret_scan.redacted(spark, odd_docs).columns == odd_docs.columns


def test_positions_in_code_points_and_long_texts(spark):
    key = "token=a1b2c3d4e5f6g7"
    texts = ["\U0001f600é " + key + " " + key, key, "x" * 200000 + " " + key, "token=" * 500 + "z" * 20,
             "ghp_" + "a1B2" * 10 + " eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.abc",
             "-----BEGIN RSA PRIVATE KEY-----", "ABCDEF" + "0a" * 400]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)],
                               "doc_id long, text string, source string")
    rows = secret_scan.report(spark, df).collect()
    check(rows, list(enumerate(texts)))
    spans = {r.doc_id: r.spans for r in rows}
    assert spans[0] == "assign:3:23,assign:24:44"
    assert spans[4] == "github:0:44,jwt:45:92".replace("92", str(len(texts[4])))
    assert spans[5] == "pem:0:31"


def test_ownership_separates_examples_from_live_values(spark):
    live, example = "a1b2c3d4e5f6g7h8", "q9w8e7r6t5y4u3i2"
    rows = [(0, f"password = {live} and {live} again token:{live}", "me")]
    rows += [(i, f"see token={example} here", f"s{i}") for i in range(1, 9)]
    rows += [(20, "api_key=your_api_key_0001", "you"), (21, "token=0000000000000000", "you"),
             (22, "plain", "you"), (23, f"token={live[::-1]} token='{live[::-1]}x'", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn(
        "n_chars", __import__("pyspark").sql.functions.length("text").cast("long"))
    got = {r.doc_id: r for r in secret_scan.report(spark, df).collect()}
    assert got[0].n_live == 2 and got[23].n_live == 2
    assert all(got[i].n_live == 0 for i in (*range(1, 9), 20, 21, 22))
    out = {r.doc_id: r for r in secret_scan.redacted(spark, df).collect()}
    assert out[0].text == f"password = [REDACTED] and {live} again token:[REDACTED]"
    assert out[23].text == "token=[REDACTED] token='[REDACTED]'"
    assert out[0].n_chars == len(out[0].text)
    assert all(out[i].text == t for i, t, _ in rows if i not in (0, 23))


def test_private_keys_and_passwords_of_letters_are_redacted(spark):
    def lines(name):
        return "\n".join(base64.b64encode(hashlib.sha512(f"{name}{i}".encode()).digest()[:48]).decode()
                         for i in range(20))

    body, other, wide = map(lines, ("a", "b", "c"))

    def pem(body, head=""):
        return f"-----BEGIN RSA PRIVATE KEY-----\n{head}{body}\n-----END RSA PRIVATE KEY-----"

    frame = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,AB12\n\n"
    rows = [(0, f"a {pem(body)} z {pem(other, frame)}.", "me"), (1, f"{pem(other, frame)}", "me"),
            (2, "secret=correcthorsebattery ok", "me"), (3, f"x {pem(body)[:800]}", "you"),
            (4, "-----BEGIN PRIVATE KEY----- and text", "me"), (5, "no 1234567890123456 hex", "me"),
            (6, pem("your key here"), "me"), (7, f"k {pem(body)}".replace("\n", "\\n"), "me"),
            (8, "-----BEGIN PRIVATE KEY-----" * 3000 + "-" * 200000, "me"),
            (9, "big " + pem("aB3/" * 100000 + "defgh"), "me")]
    rows += [(20 + i, pem(wide), f"s{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r.text for r in secret_scan.redacted(spark, df).collect()}
    assert out[0] == "a [REDACTED] z [REDACTED]." and out[1] == "[REDACTED]"
    assert out[2] == "secret=[REDACTED] ok" and out[7] == "k [REDACTED]"
    assert out[9] == "big [REDACTED]"
    assert out[3].startswith("x [REDACTED]") and body[:200] not in out[3]
    assert all(out[i] == t for i, t, _ in rows if i in (4, 5, 6, 8) or i >= 20)
    got = {r.doc_id: r for r in secret_scan.report(spark, df).collect()}
    assert got[0].n_live == 2 and got[2].n_live == 1 and got[4].n_live == 0


def test_one_owner_may_repeat_a_value_in_any_number_of_documents(spark):
    key, copied = "token=a1b2c3d4e5f6g7h8", "token=q9w8e7r6t5y4u3i2"
    rows = [(i, f"{key} {i % 1500}", "hot") for i in range(3000)] + [(3000, key, "fork")]
    rows += [(4000 + i, copied, f"s{i % 3}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.n_live for r in secret_scan.report(spark, df).collect()}
    assert all(got[i] == 1 for i in range(3001)) and not any(got[4000 + i] for i in range(9))
    out = {r.doc_id: r.text for r in secret_scan.redacted(spark, df).collect()}
    assert out[2999] == "token=[REDACTED] 1499" and out[4000] == copied


def test_repositories_and_owners_decide_not_a_word(spark):
    vendor, spread, lone = "token=Zx9Kq2LmT1v8", "token=Hy7Gr4BnU5c2", "token=your8Kq2LmZx91Tv"
    rows = [(i, f"{vendor} {i}", f"s{i % 4 if i < 8 else 0}") for i in range(300)]
    rows += [(1000 + i, f"{spread} {i}", f"s{i % 4}") for i in range(40)]   # ten an owner
    rows += [(2000, lone, "me"), (2001, "token=your_secret_token_key", "me")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.n_live for r in secret_scan.report(spark, df).collect()}
    assert all(got[i] == 1 for i in range(300)) and not any(got[1000 + i] for i in range(40))
    assert got[2000] == 1 and got[2001] == 0
    copies = spark.createDataFrame([(i, vendor, f"s{i % 4}") for i in range(300)],
                                   "doc_id long, text string, source string")
    assert not any(r.n_live for r in secret_scan.report(spark, copies).collect())  # one text


def test_main_path_is_native(spark, small_dir):
    df = registry.QUERIES["op7_secret_scan"](spark, small_dir)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
