import random
import zlib

import pytest

import corpus_pipeline
from leadpulse.llm import registry, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = registry.QUERIES["op6_toxicity"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == docs
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / len(toxic) / len(clean)
    right = sum((s >= 0.5) == y for s, y in held) / len(held)
    assert len(toxic) > 50 and auc > 0.96 and right > 0.98
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.01


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark, spark.read.parquet(f"{SF}/documents.parquet"),
                        spark.read.parquet(f"{SF}/labels.parquet"))


def test_misspelt_and_quoted_terms(model):
    words = "the of and therhean onting ereon thnt ".split()
    rng = random.Random(1)
    terms = sorted(w for w in model.lexicon.words if len(w) >= 5)[:6]
    assert len(terms) >= 5

    def text(mark):
        out = [rng.choice(words) for _ in range(150)]
        for i, t in enumerate(terms):
            out[20 * i + 7] = mark(t)
        return " ".join(out)

    assert model.score(text(lambda t: "the")) < 0.1
    assert model.score(text(lambda t: t.upper() + "!!")) > 0.9
    assert model.score(text(lambda t: t[:2] + t[2] + t[2:])) > 0.5   # a letter twice
    assert model.score(text(lambda t: t.replace("i", "1").replace("o", "0"))) > 0.9
    hit = f'x y {terms[0]} z'
    plain = toxicity.features(hit, model.lexicon)
    quote = toxicity.features(f'x "y {terms[0]}" z', model.lexicon)
    assert quote[2] < plain[2] and quote[5] == 1 and plain[5] == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [0, 1, 2])
def test_automaton_and_trie_against_edit_distance(most):
    rng = random.Random(most)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(30)}
    trie = toxicity.Trie(terms)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 7)))
        found = trie.near(toxicity.LevenshteinAutomaton(word, most))
        near = {t for t in terms if edits(word, t) <= most}
        assert (found in near) if near else found is None


def test_near_hits_equal_brute_force():
    terms = {"worthless", "moron", "trash"}
    lexicon = toxicity.Lexicon(terms, {"achl"}, {"oron"})
    rng = random.Random(0)
    for t in sorted(terms):
        for _ in range(300):
            w = list(t)
            for _ in range(rng.randint(1, 2)):
                i = rng.randrange(len(w))
                w[i:i + 1] = rng.choice([[], [rng.choice("abt")], [w[i], "e"]])
            word = "".join(w)
            want = word in terms or word != "oron" and any(edits(word, x) <= 1 for x in terms)
            assert bool(lexicon[word]) == want, word
    assert lexicon["achlich"] == toxicity.STEM and lexicon["oron"] == toxicity.NONE
    assert lexicon["tr@sh"] == toxicity.NEAR or lexicon["tr@sh"] == toxicity.EXACT


def test_misspelt_stems_and_short_terms():
    stem, letters = "achlich", "abcxü"
    lexicon = toxicity.Lexicon({"scum"}, {stem, "boc"}, {"scam", "chlich"}, {"bocoe"})
    for rest in ("", "keit", "ung"):
        for i in range(len(stem)):
            spelt = [stem[:i] + x + stem[i + 1:] for x in letters]
            spelt += [stem[:i] + x + stem[i:] for x in letters] + [stem[:i] + stem[i + 1:]]
            for word in {w + rest for w in spelt}:
                near = any(edits(word[:n], stem) <= 1 and word[:n] != "chlich"
                           for n in range(len(word) + 1))
                assert bool(lexicon[word]) == near, word
    assert lexicon["achxichkeit"] == lexicon["scun"] == lexicon["bxcoe"] == toxicity.NEAR
    assert not any(lexicon[w] for w in ("scam", "chlichkeit", "bxc", "sam", "axhxichkeit"))


def test_tokens_of_any_length(model):
    lexicon = toxicity.Lexicon({"worthless"}, {"achlich"}, ())
    assert lexicon["achlich" + "keit" * 10] == toxicity.STEM
    assert lexicon["achxich" + "keit" * 10] == lexicon["achich" + "e" * 10 ** 6] == toxicity.NEAR
    assert lexicon["worthless" + "s" * 40] == toxicity.NONE and lexicon["e" * 10 ** 6] == toxicity.NONE
    assert all(len(t) <= toxicity.KEPT_LETTERS for t in lexicon)
    stem = sorted(model.lexicon.stems, key=len)[-1]
    assert model.score(f"so {stem}{'e' * (40 - len(stem))} it") == model.score(f"so {stem} it")


def test_cut_words_tell_near_ones():
    rng = random.Random(8)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
        if edits(a, b) <= 1:
            assert set(toxicity.cut(a)) & set(toxicity.cut(b))


def test_ordinary_spellings_too_many_to_ship(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 3000")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = {}
    for most in (100_000, 0):
        monkeypatch.setattr(toxicity, "ORDINARY_ROWS", most)
        model = toxicity.fit(spark, docs, labels)
        assert (model.ordinary is None) == bool(most)
        rows = toxicity.with_score(spark, docs, model, "s").select("doc_id", "s").collect()
        score[most] = {r.doc_id: round(r.s, 9) for r in rows}
    assert score[0] == score[100_000] and len(score[0]) == docs.count()


def test_a_hundred_thousand_ordinary_spellings(spark):
    rng = random.Random(6)
    ends = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(100_000)]
    texts = [(" ".join(f"achxich{e}" for e in ends[i:i + 500]) + f" {n}",)
             for n in range(3) for i in range(0, len(ends), 500)]
    docs = spark.createDataFrame(texts, "text string").repartition(8)
    draft = toxicity.Lexicon({"clown"}, {"achlich"}, ())
    assert toxicity.ordinary(spark, docs, draft).count() > 99_000


def test_ordinary_spellings_of_the_whole_corpus(spark):
    draft = toxicity.Lexicon({"clown"}, {"achlich"}, ())
    texts = [f"the crown of king {i}" for i in range(5)] + ["a clowm again"] * 5
    texts += [f"a clwn and a clown {i}" for i in range(5)]
    texts += ["one chlichbe", "two chlichau", "three chlichen", None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.spelling for r in toxicity.ordinary(spark, docs, draft).collect()} == {
        "crown", "chlich"}
    assert toxicity.ordinary(spark, docs.limit(0), draft).count() == 0


def test_odd_documents(spark, model, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, None), (4, None, 0), (None, 1, 1), (7, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity.score_documents(spark, odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.score < 0.5 and r.predicted == 0 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.score_documents(spark, no_docs, labels.limit(0)).count() == 0
    assert model.score(None) == model.score("") < 0.5
    out = toxicity.with_score(spark, odd_docs, model, "_toxic")
    assert out.columns == odd_docs.columns + ["_toxic"]


def test_stage_drops_toxic_documents_alone(spark, small_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.toxic_out(spark, docs, SF)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - {
        r.doc_id for r in kept.select("doc_id").collect()}
    want = {r.doc_id for r in registry.QUERIES["op6_toxicity"](spark, SF)
            .where("predicted = 1").collect()}
    assert gone == want and gone
