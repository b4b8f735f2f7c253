"""Periodic runs of words: maximal stretches that repeat a root three times or more.

A run is a stretch of consecutive words with smallest period q (words q apart are
the same), of ``LEAST_LENGTH`` words and ``LEAST_EXPONENT`` periods at least, that
no neighbouring word extends.

Every word of a run lies in a sequence of ``GRAM`` words that the document holds
more than once. So a document is first cut down to the stretches that such
sequences cover; most have none. For each stretch, Ukkonen's suffix trees of its
words and of their reversal are built. The tours of the tree give the order of
the suffixes under an order of the words and its inverse, and with it the longest
Lyndon word from each position; by the runs theorem, these hold a root of every
run. Each root is extended to both sides by the longest common extensions of its
two ends, which are the depths of lowest common ancestors: the least depth at
which the tour turns between two leaves, in constant time from a table.

Documents are worked on one by one, with no shuffle. A task needs memory for the
longest repeated stretch of a document: some 700 bytes a word.

Defined cases: a null text has no words, no runs, and an empty collapsed text.
Words are what is between \\x20 and \\x09-\\x0D, in any script; a collapsed text
joins the kept words by one space. Rows that repeat come out each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm.common import prepare

LEAST_LENGTH = 24   # words of a run
LEAST_EXPONENT = 3  # its length in periods
# With this many words, sequences that occur again cover every word of a run:
# its length is at least 2 * period + GRAM - 1, whatever the period.
GRAM = 8

_RANDOM = np.random.default_rng(20240502)
_WEIGHTS = _RANDOM.integers(0, 1 << 63, GRAM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_stretches(words: list) -> list[tuple[int, int]]:
    """(start, end) of the stretches covered by sequences of ``GRAM`` words that
    occur more than once (or share a hash with another: one more to look at)."""
    count = len(words) - GRAM + 1
    if len(words) < LEAST_LENGTH:
        return []
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    grams = np.zeros(count, np.uint64)
    for j, weight in enumerate(_WEIGHTS):
        grams += codes[j:j + count] * weight
    ordered = np.sort(grams)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return []
    starts = np.nonzero(np.isin(grams, again))[0]
    breaks = np.nonzero(np.diff(starts) > GRAM)[0]
    first = starts[np.concatenate([[0], breaks + 1])]
    last = starts[np.concatenate([breaks, [len(starts) - 1]])]
    return [(int(a), int(b) + GRAM) for a, b in zip(first, last) if b + GRAM - a >= LEAST_LENGTH]


class SuffixTree:
    """Ukkonen's suffix tree of ``codes`` (numbers from 1) and an end mark of 0."""

    def __init__(self, codes: list[int]):
        text = [*codes, 0]
        size = len(text)
        width = max(text) + 1
        start, end, up, link, leaf = [0], [0], [0], [0], [-1]
        child: dict[int, int] = {}
        node = edge = length = waiting = leaves = 0
        for at, code in enumerate(text):
            fresh = 0  # an inner node that still needs its suffix link
            waiting += 1
            while waiting:
                if not length:
                    edge = at
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(at), end.append(size), up.append(node), link.append(0)
                    leaf.append(leaves)
                    leaves += 1
                    if fresh:
                        link[fresh] = node
                    fresh = node
                else:
                    span = min(end[below], at + 1) - start[below]
                    if length >= span:
                        edge, length, node = edge + span, length - span, below
                        continue
                    middle = start[below] + length
                    if text[middle] == code:
                        if fresh:
                            link[fresh] = node
                        length += 1
                        break
                    split = len(start)
                    child[key] = split
                    start.append(start[below]), end.append(middle), up.append(node)
                    link.append(0), leaf.append(-1)
                    child[split * width + code] = split + 1
                    start.append(at), end.append(size), up.append(split), link.append(0)
                    leaf.append(leaves)
                    leaves += 1
                    start[below], up[below] = middle, split
                    child[split * width + text[middle]] = below
                    if fresh:
                        link[fresh] = split
                    fresh = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length, edge = length - 1, at - waiting + 1
        self.size, self.up, self.leaf = size, up, leaf
        self.spans = [b - a for a, b in zip(start, end)]
        self.first = np.array([text[a] for a in start])

    def tour(self, inverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order that a tour from the root meets them, and the depth
        at which it turns before each. Children go by their first word, or by the
        inverse order; the end mark comes first in both."""
        rank = np.where(self.first == 0, 0, self.first.max() + 1 - self.first) if inverse \
            else self.first
        up = np.array(self.up)
        order = np.lexsort((-rank[1:], up[1:])) + 1  # last child first: a stack turns it round
        cuts = np.searchsorted(up[order], np.arange(len(up) + 1)).tolist()
        order, up, leaf, spans = order.tolist(), self.up, self.leaf, self.spans
        depth = [0] * len(up)
        suffixes, turns = [], []
        stack, turn, turned = order[:cuts[1]], 0, False
        while stack:
            node = stack.pop()
            above = depth[up[node]]
            if turned:
                turn, turned = above, False
            if leaf[node] >= 0:
                suffixes.append(leaf[node])
                turns.append(turn)
                turned = True
            else:
                depth[node] = above + spans[node]
                stack += order[cuts[node]:cuts[node + 1]]
        return np.array(suffixes), np.array(turns, np.int32)


class Extensions:
    """Longest common prefixes of two suffixes, from a tour of their tree."""

    def __init__(self, suffixes: np.ndarray, turns: np.ndarray):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.least = [turns]  # least turn among 2^k neighbours
        while 2 << len(self.least) - 1 <= len(turns):
            half = 1 << len(self.least) - 1
            last = self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For suffixes from ``a`` and ``b``, pairwise different."""
        left, right = self.rank[a], self.rank[b]
        left, right = np.minimum(left, right) + 1, np.maximum(left, right)
        level = np.frexp(right - left + 1)[1] - 1
        out = np.empty(len(left), np.int64)
        for k in np.unique(level):
            at = level == k
            table = self.least[k]
            out[at] = np.minimum(table[left[at]], table[right[at] - (1 << k) + 1])
        return out


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each position: up to the next suffix
    that is smaller. ``rank`` ends with the end mark, the smallest of all."""
    rank = rank.tolist()
    out = np.empty(len(rank) - 1, np.int64)
    stack: list[int] = []
    for at, value in enumerate(rank):
        while stack and rank[stack[-1]] > value:
            before = stack.pop()
            out[before] = at - before
        stack.append(at)
    return out


def runs_of(codes: list[int]) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of numbers from 1."""
    n = len(codes)
    tree = SuffixTree(codes)
    ahead = Extensions(*tree.tour())
    back = Extensions(*SuffixTree(codes[::-1]).tour())
    inverse = np.empty(n + 1, np.int64)
    inverse[tree.tour(inverse=True)[0]] = np.arange(n + 1)
    found = []
    for rank in (ahead.rank, inverse):
        period = lyndon_lengths(rank)
        start = np.nonzero(np.arange(n) + 2 * period <= n)[0]
        period = period[start]
        right = ahead.of(start, start + period)
        left = np.zeros(len(start), np.int64)
        inner = start > 0
        left[inner] = back.of(n - start[inner], n - start[inner] - period[inner])
        length = left + period + right
        kept = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
        found.append(np.stack([start - left, length, period], axis=1)[kept])
    return np.unique(np.concatenate(found), axis=0)


def word_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text's words, by start, then period."""
    out = []
    for start, end in repeated_stretches(words):
        numbers: dict = {}
        codes = [numbers.setdefault(w, len(numbers) + 1) for w in words[start:end]]
        rows = runs_of(codes)
        rows[:, 0] += start
        out += map(tuple, rows.tolist())
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapsed_words(words: list, runs: list) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [w for w, kept in zip(words, keep.tolist()) if kept]


RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def with_runs(spark: SparkSession, docs: DataFrame, text: str = "text", runs: str = "runs",
              collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of the text, and the text without what they repeat."""
    prepare(spark)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for value in batch.column(text).cast(pa.binary()).to_pylist():
                words = (value or b"").split()  # of bytes: at \x20\x09-\x0D alone
                rows = word_runs(words)
                found.append([dict(zip(("start", "length", "period"), row)) for row in rows])
                kept.append(b" ".join(collapsed_words(words, rows)))
            yield (batch.append_column(runs, pa.array(found, RUNS))
                   .append_column(collapsed, pa.array(kept, pa.binary()).cast(pa.string())))

    wide = docs.withColumns({runs: F.lit(None).cast(
        "array<struct<start: long, length: long, period: long>>"), collapsed: F.lit("")})
    return docs.mapInArrow(of, wide.schema)


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """The text whose words are periodic from a place on, for a tenth of the ids."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)

    def edited(row: Column) -> Column:
        w, a = row["words"], row["a"]
        p = 1 + F.floor((F.size(w) - a) / (3 + g % 8))
        tail = F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.when(
            i < a, F.get(w, i)).otherwise(F.get(w, (a + (i - a) % p).cast("int"))))
        return F.array_join(tail, " ")

    row = F.struct(words.alias("words"), F.when(n > 0, g % n).alias("a"))
    return F.when((h % 10 == 0) & (n > 0),
                  F.transform(F.array(row), edited)[0]).otherwise(text)


def strongest(runs: Column) -> Column:
    """The run of the greatest exponent; the first of equals. Null without runs."""
    return F.aggregate(runs, F.get(runs, 0), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: its runs, counted and digested, and its collapsed text's
    digest, after :func:`periodic_tail`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", periodic_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = with_runs(spark, rows)
    line = F.transform("runs", lambda r: F.format_string(
        "%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return (found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
