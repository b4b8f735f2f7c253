import importlib.util
import os
import subprocess
import sys

import corpus_pipeline
import test_simhash
from leadpulse.llm import mixing, toxicity


def test_stages_in_order_and_their_columns(spark, tmp_path):
    small_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        path = str(tmp_path / name)
        step(spark, docs, small_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs
        if name != "pack":
            assert docs.columns == names
        if name == "toxicity":
            model = toxicity.fit(spark, before, spark.read.parquet(f"{small_dir}/labels.parquet"))
            want = [r for r in before.collect() if model.score(r.text) < 0.5]
            assert sorted(docs.collect()) == sorted(want)
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            roots = {int(c) for _, _, c in test_simhash.brute(rows)}
            assert sorted(docs.collect()) == sorted(r for r in before.collect()
                                                    if r.doc_id in roots)
        if name == "secrets":
            assert docs.count() == before.count()
            changed = {r.doc_id for r in docs.collect() if "[REDACTED]" in r.text}
            assert changed and len(changed) < 0.1 * docs.count()
        if name == "mix":
            plan = mixing.mix(spark, before).where("copies > 0").collect()
            assert docs.count() == sum(r.copies for r in plan)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(kept)
    assert sum(r.length for r in docs.collect()) == sum(
        r.doc_tokens for r in docs.where("start = 0").collect())


def test_odd_documents(spark, odd_docs, no_docs, small_dir):
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, odd_docs, small_dir)
        assert out.count() > 0 and (name == "pack" or out.columns == odd_docs.columns)
        assert step(spark, no_docs, small_dir).count() == 0


def test_the_rest_works_without_the_folder(repo_dir):
    code = """
import importlib.util as u, sys
real = u.find_spec
u.find_spec = lambda n, *a: None if n in ("leadpulse.llm.registry", "corpus_pipeline") else real(n, *a)
import __spark_entry__ as e
names = set(e.queries()) | set(e.oracle_sql())
assert names and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)
assert not any("leadpulse.llm" in m for m in sys.modules)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=repo_dir, timeout=120)


def test_nothing_else_imports_the_folder(repo_dir):
    assert importlib.util.find_spec("leadpulse.llm")
    for top, _, files in os.walk(os.path.join(repo_dir, "leadpulse")):
        if os.path.basename(top) != "llm":
            for f in files:
                if f.endswith(".py"):
                    text = open(os.path.join(top, f), encoding="utf-8").read()
                    assert "leadpulse.llm" not in text and "from .llm" not in text
