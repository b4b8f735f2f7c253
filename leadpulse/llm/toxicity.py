"""Toxicity by a learned lexicon, misspellings included.

Fitting, on a bounded sample of labelled rows (``FIT_ROWS``): words and word
stems that stand in many different contexts of toxic texts and in few of clean
ones form the lexicon. Counting distinct contexts (the words beside it) keeps
what copies of one text repeat from passing for a lexicon entry. A logistic
regression weighs what the lexicon finds in a text.

Scoring: a word is looked up as it is, with letters in place of look-alike
signs, by stem, and by the intersection of its Levenshtein automaton with the
lexicon's trie, which finds words one edit away, and words that begin one edit away from
a stem. A misspelling that is itself a word of clean texts is none, nor is a
spelling, of a word or its beginning, that many texts without sure hits have:
these are counted over the whole corpus, and where they are too many to ship
(``ORDINARY_ROWS``) they are joined to the texts that hold them. Tokens of any
length are looked up. Each hit has a context-window score: inside
quotation marks or after a word of reporting it counts less, as quotation
rather than abuse.

Defined cases: null and empty texts have no hits and get the score of such
texts. Rows with a null id or label are not learned from; a row with several
labels counts as toxic if one says so. Without a toxic and a clean labelled row
the score is the smoothed share of toxic labels, and at most 0.49. An empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm.common import free_name, prepare, stage

FIT_ROWS = 10000     # labelled rows that the model is fitted on, at most
LEAST_CONTEXTS = 8   # contexts in toxic texts that an entry needs
LEAST_ODDS = 2.5     # log odds of these that it needs
STEMS = (3, 8)       # lengths of stems
FUZZY = 4            # words and stems of so many letters may be misspelt
LEAST_TEXTS = 3      # texts without a sure hit that an ordinary spelling needs
LEAST_SHARE = 0.8    # share of its texts that these are
WINDOW = 20          # tokens in which hits are counted together
QUOTE_WINDOW = 80    # characters searched for quotation marks on either side
KEPT_TOKENS = 400_000  # tokens whose lookup a worker remembers
KEPT_LETTERS = 64    # longer tokens are looked up each time
ORDINARY_ROWS = 100_000  # ordinary spellings that may be shipped to all tasks
FOLDS = 5            # rows whose crc32(doc_id) mod 5 is 0 are held out

TOKEN = re.compile(r"[^\W_]+(?:[*@$!]+[^\W_]+)*")

# Letters that signs stand for, words of reporting.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t",
                           "@": "a", "$": "s", "!": "i"})
REPORTING = frozenset({"said", "says", "called", "quote", "quoted", "word", "term", "wrote",
                       "dit", "mot", "sagte", "wort", "dijo", "palabra"})


class LevenshteinAutomaton:
    """Accepts the words within ``most`` edits of ``word``. A state holds, for
    each prefix of the word that is still near enough, its edit count."""

    def __init__(self, word: str, most: int = 1):
        self.word, self.most = word, most

    def start(self) -> dict[int, int]:
        return {i: i for i in range(min(self.most, len(self.word)) + 1)}

    def step(self, state: dict[int, int], letter: str) -> dict[int, int]:
        after: dict[int, int] = {}
        for i in sorted(state):
            edits = state[i]
            for j, cost in ((i, edits + 1),
                            (i + 1, edits + (i >= len(self.word) or self.word[i] != letter))):
                if j <= len(self.word) and cost < after.get(j, self.most + 1):
                    after[j] = cost
        for i in sorted(after):  # letters of the word left out
            while i < len(self.word) and after[i] + 1 < after.get(i + 1, self.most + 1):
                after[i + 1] = after[i] + 1
                i += 1
        return after

    def accepts(self, state: dict[int, int]) -> bool:
        return len(self.word) in state


class Trie:
    """Words and stems by letters; a node is a dict, "" marks the end of a word
    and None that of a stem."""

    def __init__(self, words, stems=()):
        self.root: dict = {}
        for mark, entries in (("", words), (None, stems)):
            for entry in entries:
                node = self.root
                for letter in entry:
                    node = node.setdefault(letter, {})
                node[mark] = entry

    def matches(self, automaton: LevenshteinAutomaton) -> Iterator[tuple[str, str]]:
        """(entry, its spelling in the automaton's word) of the words that the
        automaton accepts, and of the stems that are near enough to a beginning
        of its word: trie and automaton are walked together."""
        todo = [(self.root, automaton.start())]
        while todo:
            node, state = todo.pop()
            for letter, child in node.items():
                if letter is None:
                    yield from ((child, automaton.word[:i]) for i in state)
                elif letter == "":
                    if automaton.accepts(state):
                        yield child, automaton.word
                elif after := automaton.step(state, letter):
                    todo.append((child, after))

    def near(self, automaton: LevenshteinAutomaton, benign=frozenset()) -> str | None:
        """An entry that matches by a spelling that is not in ``benign``."""
        return next((entry for entry, spelling in self.matches(automaton)
                     if spelling not in benign), None)


def cut(word: str) -> Iterator[str]:
    """The word, and the word without each of its letters. Words one edit apart have one
    of these in common, which tells most words apart without an automaton."""
    yield word
    for i in range(len(word)):
        yield word[:i] + word[i + 1:]


NONE, EXACT, STEM, NEAR = 0, 1, 2, 3


class Lexicon(dict):
    """Kind of hit by token, looked up once per token and worker. ``covered``
    are words that a stem stands for; misspelt, they need not begin with it.
    ``benign`` are words, and beginnings of words, that are no misspellings."""

    def __init__(self, words, stems, benign, covered=()):
        super().__init__()
        self.words, self.stems = frozenset(words), frozenset(stems)
        self.benign, self.covered = frozenset(benign), frozenset(covered)
        self.stem_lengths = sorted({len(s) for s in self.stems})
        long = [w for w in self.words | self.covered if len(w) >= FUZZY]
        stems = [s for s in self.stems if len(s) >= FUZZY]
        self.trie = Trie(long, stems)
        # One edit leaves the first or the second half of an entry as it is. The
        # second half of a stem then begins at most one letter from its place.
        self.heads = {e[:len(e) // 2] for e in long + stems}
        self.tails = {w[len(w) // 2:] for w in long}
        self.inner = {(len(s) // 2 + shift, s[len(s) // 2:]) for s in stems
                      for shift in (-1, 0, 1)}
        self.head_lengths = sorted({len(h) for h in self.heads})
        self.tail_lengths = sorted({len(t) for t in self.tails})
        self.places = [(at, to, {t for a, t in self.inner if a == at and len(t) == to - at})
                       for at, to in sorted({(at, at + len(t)) for at, t in self.inner})]
        self.cut_words = {c for w in long for c in cut(w)}
        self.cut_stems = {c for s in stems for c in cut(s)}
        self.longest = max(map(len, long), default=-2) + 1
        self.beginnings = sorted({len(s) + d for s in stems for d in (-1, 0, 1)})

    def __reduce__(self):
        return Lexicon, (self.words, self.stems, self.benign, self.covered)

    def __missing__(self, token: str) -> int:
        if len(self) >= KEPT_TOKENS:
            self.clear()
        kind = self.kind(token)
        if not kind and (word := plain(token)) != token:
            kind = self.kind(word)
        if len(token) <= KEPT_LETTERS:
            self[token] = kind
        return kind

    def spellings(self, token: str) -> set[str]:
        """What must not be ordinary for a token to count as a misspelling: the word as it
        is written and read, and its beginnings that are near a stem."""
        out = {token, plain(token)}
        for word in out.copy():
            if self.may_be_near(word):
                out.update(s for _, s in self.trie.matches(LevenshteinAutomaton(word)))
        return out

    def near_beyond(self, token: str, ordinary) -> bool:
        """Whether a misspelling stays one beside further ordinary spellings."""
        benign = self.benign.union(ordinary)
        return any(word not in benign and self.may_be_near(word)
                   and self.trie.near(LevenshteinAutomaton(word), benign)
                   for word in {token, plain(token)})

    def kind(self, word: str) -> int:
        if word in self.words:
            return EXACT
        for n in self.stem_lengths:
            if word[:n] in self.stems:
                return STEM
        if word not in self.benign and self.may_be_near(word):
            if self.trie.near(LevenshteinAutomaton(word), self.benign):
                return NEAR
        return NONE

    def may_be_near(self, word: str) -> bool:
        return len(word) >= FUZZY - 1 and self._has_half(word) and (
            (len(word) <= self.longest and any(c in self.cut_words for c in cut(word)))
            or any(c in self.cut_stems for n in self.beginnings if n <= len(word)
                   for c in cut(word[:n])))

    def _has_half(self, word: str) -> bool:
        for n in self.head_lengths:
            if word[:n] in self.heads:
                return True
        for n in self.tail_lengths:
            if word[-n:] in self.tails:
                return True
        for at, to, halves in self.places:
            if word[at:to] in halves:
                return True
        return False


def plain(token: str) -> str:
    """A token with letters in place of look-alike signs, if it has letters at all."""
    if token.isalpha() or not any(map(str.isalpha, token)):
        return token
    return token.translate(LOOKALIKE)


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a hit stands between quotation marks of its line."""
    line = text.rfind("\n", 0, start) + 1
    before, after = text[max(line, start - QUOTE_WINDOW):start], text[end:end + QUOTE_WINDOW]
    for opening, closing in (("“", "”"), ("«", "»"), ("„", "“")):
        if before.rfind(opening) > before.rfind(closing) and closing in after:
            return True
    return before.count('"') % 2 == 1 and '"' in after


FEATURES = 7


def features(text: str | None, lexicon: Lexicon, ordinary=()) -> np.ndarray:
    """What the lexicon finds in a text. All kinds of hits count alike, but for
    their context, so what is learned of exact ones holds for misspelt ones.
    ``ordinary`` are spellings of the text that are ordinary ones, beside the
    lexicon's own."""
    low = (text or "").lower()
    tokens = TOKEN.findall(low)
    kinds = list(map(lexicon.__getitem__, tokens))
    if len(ordinary):
        kinds = [NONE if kind == NEAR and not lexicon.near_beyond(t, ordinary) else kind
                 for t, kind in zip(tokens, kinds)]
    out = np.zeros(FEATURES)
    out[0] = math.log1p(len(tokens))
    if not any(kinds):
        return out
    score = np.zeros(len(tokens))
    in_quotes = 0
    for i, (kind, found) in enumerate(zip(kinds, TOKEN.finditer(low))):
        if kind:
            score[i] = 1.0
            if quoted(low, *found.span()):
                score[i], in_quotes = 0.3, in_quotes + 1
            elif REPORTING.intersection(tokens[max(0, i - 4):i]):
                score[i] = 0.5
    sums = np.concatenate([[0.0], np.cumsum(score)])
    width = min(WINDOW, len(tokens))
    hits = np.bincount(kinds, minlength=4)
    out[1] = 1.0
    out[2] = math.log1p(sums[-1])
    out[3] = min((sums[width:] - sums[:len(sums) - width]).max(), 6.0)
    out[4] = min(sums[-1] / len(tokens), 0.1) * 100
    out[5] = in_quotes / hits[1:].sum()
    out[6] = hits[STEM] / hits[1:].sum()
    return out


class Model:
    """A lexicon and the weights of what it finds. ``ordinary`` is a table of further
    ordinary spellings, where they are too many for the lexicon."""

    def __init__(self, lexicon: Lexicon, mean, scale, weights, bias: float,
                 ordinary: DataFrame | None = None):
        self.lexicon, self.mean, self.scale = lexicon, mean, scale
        self.weights, self.bias, self.ordinary = weights, bias, ordinary

    def alone(self) -> Model:
        """The model without its table, as tasks need it."""
        return Model(self.lexicon, self.mean, self.scale, self.weights, self.bias)

    def score(self, text: str | None, ordinary=()) -> float:
        x = (features(text, self.lexicon, ordinary) - self.mean) / self.scale
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, x @ self.weights + self.bias)))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple:
    """Ridge logistic regression by Newton's method: weights, bias."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + penalty
        step = np.linalg.solve(hessian, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows that may be learned from."""
    doc_id = F.col("doc_id").cast("long")
    return (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                         & ~held_out(doc_id))
            .groupBy(doc_id.alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))


CONTEXT = "word string, context long, toxic int"


def _contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words of the texts with a hash of the words beside them."""
    for frame in frames:
        rows: set = set()
        for text, toxic in zip(frame.text, frame.toxic):
            tokens = ["", *TOKEN.findall((text or "").lower()), ""]
            rows.update((b, xxhash.xxh64_intdigest(f"{a} {b} {c}") >> 1, toxic)
                        for a, b, c in zip(tokens, tokens[1:], tokens[2:]))
        yield pd.DataFrame(list(rows), columns=["word", "context", "toxic"])


def log_odds(a, b, total_a: float, total_b: float):
    return F.log((a + 0.5) / (total_a + 1)) - F.log((b + 0.5) / (total_b + 1))


def choose(stems: dict[str, int], words: dict[str, int]) -> tuple[set, set]:
    """Stems and words of the lexicon, from candidates with their contexts.

    A stem that one longer stem or one word accounts for gives way to it; a
    stem or word that a shorter stem covers is not needed.
    """
    longest = STEMS[1]

    def explained(stem: str) -> bool:
        most = 0.9 * stems[stem]
        return any(len(s) > len(stem) and s.startswith(stem) and n >= most
                   for s, n in stems.items()) or any(
            w.startswith(stem) and n >= most for w, n in words.items())

    kept: set = set()
    for stem in sorted((s for s in stems if len(s) <= longest and not explained(s)), key=len):
        if not any(stem.startswith(s) for s in kept):
            kept.add(stem)
    return kept, {w for w in words if not any(w.startswith(s) for s in kept)}


def near_spellings(spark: SparkSession, docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(spelling, high, low, sure): the spellings near an entry that each text has, the
    text's hash, and whether it has a sure hit."""
    shared = spark.sparkContext.broadcast(lexicon)

    def spellings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, known = shared.value, {}
        for frame in frames:
            rows: set = set()
            for text, high, low in zip(frame.text, frame.high, frame.low):
                kinds = {t: lexicon[t] for t in set(TOKEN.findall((text or "").lower()))}
                near = [t for t, kind in kinds.items() if kind == NEAR]
                if not near:
                    continue
                sure = any(kind in (EXACT, STEM) for kind in kinds.values())
                if len(known) >= KEPT_TOKENS:
                    known.clear()
                for token in near:
                    if token not in known:
                        known[token] = lexicon.spellings(token)
                    rows.update((s, high, low, sure) for s in known[token])
            yield pd.DataFrame(list(rows), columns=["spelling", "high", "low", "sure"])

    return docs.select("text", *text_key(F.col("text"))).mapInPandas(
        spellings, "spelling string, high long, low long, sure boolean")


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64(text).alias("high"), F.xxhash64(F.lit("low"), text).alias("low")


def ordinary(spark: SparkSession, docs: DataFrame, draft: Lexicon) -> DataFrame:
    """(spelling): those near an entry of ``draft`` that are ordinary ones: they stand in
    different texts of the whole corpus, most of which have no sure hit."""
    seen = near_spellings(spark, docs, draft).distinct()
    texts = seen.groupBy("spelling").agg(
        F.count_if(~F.col("sure")).alias("without"), F.count(F.lit(1)).alias("n"))
    common = ((F.col("without") >= LEAST_TEXTS)
              & (F.col("without") >= LEAST_SHARE * F.col("n")))
    return stage(spark, texts.where(common).select("spelling"), "toxic-ordinary")


def with_ordinary(spark: SparkSession, docs: DataFrame, model: Model, out: str) -> DataFrame:
    """``docs`` with the ordinary spellings of each text that only the model's table has:
    null for nearly all texts."""
    own = "array<string>"
    if model.ordinary is None:
        return docs.withColumn(out, F.lit(None).cast(own))
    key = [free_name(docs, c) for c in ("_text_high", "_text_low")]
    held = (near_spellings(spark, docs, model.lexicon).select("spelling", "high", "low").distinct()
            .join(model.ordinary, "spelling").groupBy("high", "low")
            .agg(F.collect_set("spelling").alias(out)).toDF(*key, out))
    named = docs.withColumns(dict(zip(key, text_key(F.col("text")))))
    return named.join(stage(spark, held, "toxic-held"), key, "left").drop(*key)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Model of the training labels' documents: of the ``rows`` of them that a
    hash of the id puts first."""
    prepare(spark)
    known = training_labels(labels)
    first = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    first = stage(spark, first.coalesce(1), "toxic-sample")
    # At most FIT_ROWS ids with their labels.
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
              .join(F.broadcast(first), "doc_id").select("text", "toxic")
              .where(F.col("text").isNotNull()))
    seen = sample.mapInPandas(_contexts, CONTEXT).distinct().groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    seen = stage(spark, seen.where(F.length("word") > 0), "toxic-words")
    totals = seen.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    size = first.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    none = np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES)
    if not totals.a or not totals.b:
        share = ((size.t or 0) + 0.5) / (size.n + 1) if size.n else 0.1
        share = min(share, 0.49)
        return Model(Lexicon((), (), ()), *none, math.log(share / (1 - share)))

    def telling(df: DataFrame, name: str) -> dict[str, int]:
        odds = log_odds(F.col("a"), F.col("b"), totals.a, totals.b)
        found = df.where((F.col("a") >= LEAST_CONTEXTS) & (odds >= LEAST_ODDS))
        return {r[name]: r.a for r in found.select(name, "a").collect()}

    prefix = F.explode(F.transform(F.sequence(F.lit(STEMS[0]), F.least(
        F.length("word"), F.lit(STEMS[1]))), lambda n: F.substring("word", F.lit(1), n)))
    by_stem = (seen.where(F.length("word") >= STEMS[0]).select(prefix.alias("stem"), "a", "b")
               .groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    words = telling(seen, "word")
    every = set(words)
    stems, words = choose(telling(by_stem, "stem"), words)
    drafted = Lexicon(words, stems, (), every - words)
    draft = spark.sparkContext.broadcast(drafted)

    @F.pandas_udf("boolean")
    def near(names: pd.Series) -> pd.Series:
        return names.map(lambda w: draft.value.kind(w) == NEAR)

    benign = {r.word for r in seen.where(F.col("b") >= 2).where(near("word"))
              .select("word").collect()}
    more = ordinary(spark, docs, drafted)
    few = [r.spelling for r in more.limit(ORDINARY_ROWS + 1).collect()]
    table = None if len(few) <= ORDINARY_ROWS else more
    lexicon = Lexicon(words, stems, benign if table else benign.union(few), every - words)
    shared = spark.sparkContext.broadcast(lexicon)
    sample = with_ordinary(spark, sample, Model(lexicon, *none, 0.0, table), "ordinary")

    @F.pandas_udf("array<double>")
    def found(texts: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([features(t, shared.value, () if o is None else o)
                          for t, o in zip(texts, own)], dtype=object)

    got = sample.select(found("text", "ordinary").alias("x"), "toxic").collect()  # FIT_ROWS short rows
    x = np.array([r.x for r in got])
    y = np.array([r.toxic for r in got], dtype=float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    return Model(lexicon, mean, scale, *logistic((x - mean) / scale, y), table)


def with_score(spark: SparkSession, docs: DataFrame, model: Model, out: str) -> DataFrame:
    """``docs`` with the score of their text."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(model.alone())

    @F.pandas_udf("double")
    def score(texts: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t, () if o is None else o)
                          for t, o in zip(texts, own)], dtype="float64")

    own = free_name(docs, "_ordinary")
    return with_ordinary(spark, docs, model, own).withColumn(out, score("text", own)).drop(own)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(spark, docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_score(spark, rows, model, "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
