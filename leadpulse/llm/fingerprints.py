"""Document fingerprints: bottom-k sketches of hashed word shingles.

A text is lower-cased (A-Z) and cut into words; each run of five words is a
shingle (fewer words: the whole sequence; none: no shingle). The sketch is the
``k`` smallest distinct 64-bit shingle hashes, ascending. Sketches of parts
merge into the sketch of the whole, and estimate the resemblance (Jaccard) and
containment of shingle sets and the number of distinct shingles. Up to k
shingles all of these are exact.

Defined cases: a null text counts as empty; empty texts have the empty sketch,
whose likeness to itself is 1 and to any other 0. Very long texts are hashed
whole, in pieces. Rows of equal id follow one another in the order of their
texts; rows without an id come first. In a table of one row, the row is its own
successor. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadpulse.llm.common import prepare

K = 128
WORDS = 5
PIECE = 1 << 18    # words hashed at a time
RANGES_PER_PARTITION = 4
EMPTY = np.empty(0, dtype=np.uint64)

# Odd multipliers of a shingle's words; derived from a seed, not tuned.
_MULTIPLIERS = [xxhash.xxh64_intdigest(b"word", i) | 1 for i in range(64)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _smallest(h: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, ascending."""
    if len(h) > 16 * k:
        # Repeats may hide among the smallest, so the cut widens until there
        # are k distinct ones or all are in.
        cut = 4 * k
        while cut < len(h):
            low = np.unique(np.partition(h, cut)[:cut])
            if len(low) > k:  # the largest may have equals beyond the cut
                return low[:k]
            cut *= 4
    return np.unique(h)[:k]


def sketch(text: str | None, k: int = K, words: int = WORDS) -> np.ndarray:
    """Bottom-k sketch of a text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return EMPTY
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    low = EMPTY
    for at in range(0, len(h) - width + 1, PIECE):
        part = h[at:at + PIECE + width - 1]
        n = len(part) - width + 1
        total = np.full(n, width, dtype=np.uint64)
        for j in range(width):
            total += part[j:j + n] * np.uint64(_MULTIPLIERS[j % 64])
        low = _smallest(np.concatenate([low, _smallest(_mixed(total), k)]), k)
    return low


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two shingle sets."""
    return np.union1d(a, b)[:k]


def _common(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """Size of the union's sketch, and how much of it both sets hold."""
    both = merge(a, b, k)
    return len(both), int(np.count_nonzero(np.isin(both, a, assume_unique=True)
                                           & np.isin(both, b, assume_unique=True)))


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the union's shingles that both have."""
    size, common = _common(a, b, k)
    return common / size if size else 1.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0 ** 64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has as well."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return min(1.0, shared / distinct(a, k))


def encode(a: np.ndarray) -> str:
    """A sketch as text: its hashes in order, big-endian, in base64."""
    return base64.b64encode(a.astype(">u8").tobytes()).decode("ascii")


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=">u8").astype(np.uint64)


def fingerprint(spark: SparkSession, docs: DataFrame, text: str = "text",
                out: str = "sketch", k: int = K, words: int = WORDS) -> DataFrame:
    """``docs`` with ``out``: the sketch as array<long>, in unsigned order."""
    prepare(spark)

    @F.pandas_udf("array<long>")
    def of(texts):
        return texts.map(lambda t: sketch(t, k, words).view(np.int64))

    return docs.withColumn(out, of(F.col(text)))


def merge_parts(parts: DataFrame, key: str, sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """(key, sketch): the sketch of each key's parts together.

    The hashes are exploded, made distinct and cut to the k smallest per key,
    before the shuffle as well as after it, so no key gathers more than that.
    A key of empty sketches keeps an empty one.
    """
    # Flipping the top bit turns the order of longs into that of unsigned ones.
    top = F.lit(-(1 << 63))
    rows = parts.select(key, F.explode_outer(sketch_col).alias("h")).distinct()
    order = Window.partitionBy(key).orderBy(F.col("h").bitwiseXOR(top).asc_nulls_last())
    low = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    pairs = F.array_sort(F.collect_list(F.when(F.col("h").isNotNull(), F.struct("n", "h"))))
    return low.groupBy(key).agg(F.transform(pairs, lambda x: x["h"]).alias("sketch"))


def edited(text: str, after: str) -> str:
    """The text with its second half replaced by the start of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def _spread(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, text, guest, part): documents dealt to ranges of ids.

    The first documents of a range also go, as guests, to the range before it
    (those of the first to the last), where they end the order. Splits come
    from approximate quantiles of the ids: a few per shuffle partition.
    """
    ids = F.col("doc_id").cast("long")
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx(ids, [i / n for i in range(1, n)], 10 * n)
                    .alias("q")).first().q
    splits = np.unique(np.array(cuts or [], dtype=np.int64))

    def part_of(known: pd.Series) -> np.ndarray:
        null = known.isna()
        numbers = known.where(~null, "0").map(int).to_numpy(dtype=np.int64)
        return np.where(null, 0, np.searchsorted(splits, numbers, side="right") + 1)

    # Ids travel as text: pandas would turn longs that may be null into floats.
    @F.pandas_udf("int")
    def part(known: pd.Series) -> pd.Series:
        return pd.Series(part_of(known))

    text_id = ids.cast("string")
    # One row per range, so bounded by the number of splits.
    firsts = (docs.select(ids.alias("id"), part(text_id).alias("part")).groupBy("part")
              .agg(F.min("id").cast("string").alias("first")).orderBy("part").collect())
    first = {r.part: r["first"] for r in firsts}
    before = {r.part: firsts[i - 1].part for i, r in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def places(known: pd.Series) -> pd.Series:
        return pd.Series([[p, before[p]] if first[p] == (None if null else i) else [p]
                          for p, i, null in zip(part_of(known), known, known.isna())],
                         dtype=object)

    dealt = docs.select(ids.alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                        places(text_id).alias("places"))
    return dealt.select("doc_id", "text", F.posexplode("places").alias("guest", "part"))


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double")


def with_next(spark: SparkSession, docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to
    each other and to the next document's, in the order of ids.

    Texts move once, to the range of their id; within a range they stream
    through Python in order, each needing only its successor.
    """
    prepare(spark)
    dealt = _spread(spark, docs).repartition("part").sortWithinPartitions(
        "part", "guest", "doc_id", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last = None  # the document that waits for its successor
        for batch in batches:
            for part, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in
                                                   ("part", "guest", "doc_id", "text"))):
                if last is not None and last[0] != part:
                    last = None
                if guest and last is None:
                    continue  # the successor's equals in id
                low = sketch(text, k)
                if last is not None:
                    yield compare(last, text, low)
                last = None if guest else (part, doc_id, text, low)

    def compare(one: tuple, after: str, after_low: np.ndarray) -> tuple:
        _, doc_id, text, low = one
        changed = edited(text, after)
        changed_low = low if changed == text else sketch(changed, k)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return (doc_id, len(text), digest, encode(low), encode(changed_low),
                resemblance(low, changed_low, k), resemblance(low, after_low, k))

    names = [c.split()[0] for c in OUT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for row in rows(batches):
            kept.append(row)
            if len(kept) == 256:
                yield record(kept)
                kept = []
        yield record(kept)

    def record(kept: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*kept)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          names=names)

    return dealt.mapInArrow(run, OUT)
