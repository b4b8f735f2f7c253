"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds the distinct two-word shingles of its lower-cased text.
Equal sets form one class, so exact copies are compared once. Each class has
``HASHES`` minima; the first of them make up ``BANDS`` bands, and classes that
share a band meet in a bucket. A pair at the threshold shares no band with
probability (1 - 0.8^4)^40, below 1e-9.

Candidates come in two steps, and neither lists the pairs of a bucket that many
share:

* every bucket compares each member with its smallest one; what this links leaves
  most buckets with members that are all linked, and they need no more work;
* the members of the other buckets are dealt to blocks of bounded size, and blocks
  that share a bucket meet in one task.

A candidate's signatures, two bits of each minimum, are compared batch by batch,
and a pair is dropped as soon as the posterior probability that its similarity
reaches the threshold falls below ``MISS``. All that survive are confirmed on the
full sets.

Defined cases: null and empty texts have empty sets and link with nothing. A
text of one word has that word as its set. Rows without an id take part;
``component_id`` is the smallest id reachable, null only where no member has
one, and ``kept`` is false on rows without an id. Rows that repeat an id each
come out, and all of them are kept where the id is their component's. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm.common import components, prepare, stage

WORDS = 2
PERCENT = 80            # least similarity of a link, in percent
HASHES = 256
BANDS, BAND_ROWS = 40, 4
BITS = 2                # of each minimum that a signature keeps
BATCH = 64              # minima that are compared at a time
MISS = 1e-9             # chance of dropping a pair at the threshold, per batch
TILE_BYTES = 4 << 20    # shingles and signatures of a block, about
TILE_ROWS = 1024        # members of a block, about
BROADCAST_ROWS = 250_000    # ids that may be shipped to all tasks (40 bytes each)
PIECE = 2048            # shingles, or columns, that are worked on at a time

_RANDOM = np.random.default_rng(20240501)
FACTORS = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
MASKS = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
MIX = np.uint32(0x9E3779B1)


def shingle_hashes(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a UTF-8 text."""
    tokens = (text or b"").lower().split()  # of bytes: A-Z and \x20\x09-\x0D alone
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        shingles = {b" ".join(tokens)}
    else:
        last = len(tokens) - words + 1
        shingles = set(map(b" ".join, zip(*(tokens[j:j + last] for j in range(words)))))
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, shingles), np.uint64, len(shingles)))


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed numbers."""
    high, low = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), ">i8")
    return int(high), int(low)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    short = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), PIECE):
        values = (short[None, at:at + PIECE] ^ MASKS[:, None]) * FACTORS[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def signature(least: np.ndarray) -> np.ndarray:
    """``BITS`` mixed bits of each minimum, 32 minima to a long."""
    mixed = ((least ^ (least >> np.uint32(15))) * MIX) >> np.uint32(32 - BITS)
    parts = mixed.astype(np.uint8).reshape(-1, 4)
    return (parts[:, 0] | parts[:, 1] << 2 | parts[:, 2] << 4 | parts[:, 3] << 6).view("<i8")


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band."""
    rows = least[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    return np.fromiter((xxhash.xxh3_64_intdigest(row.tobytes(), seed=band)
                        for band, row in enumerate(rows)), np.uint64, BANDS).view(np.int64)


def least_matches() -> list[int]:
    """For each batch, the fewest matching minima so far with which a pair goes on.

    Two minima match if their bits do: with probability s + (1 - s) / 2^BITS at
    similarity s. The similarity has a uniform prior.
    """
    chance = 1 / (1 << BITS)
    s = np.linspace(0.0005, 0.9995, 4000)
    p = s + (1 - s) * chance
    near = s >= PERCENT / 100
    out = []
    for seen in range(BATCH, HASHES + 1, BATCH):
        for matches in range(seen + 1):
            log = matches * np.log(p) + (seen - matches) * np.log1p(-p)
            weight = np.exp(log - log.max())
            if weight[near].sum() >= MISS * weight.sum():
                out.append(matches)
                break
    return out


LEAST = least_matches()
_EQUAL = np.array([sum((x >> shift & 3) == 0 for shift in (0, 2, 4, 6)) for x in range(256)],
                  np.uint8)


def plausible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of signatures (rows of bytes) survive all batches."""
    width = BATCH * BITS // 8
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for nth, least in enumerate(LEAST):
        part = slice(nth * width, (nth + 1) * width)
        matches[alive] += _EQUAL[a[alive, part] ^ b[alive, part]].sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def survives(a: Column, b: Column) -> Column:
    """:func:`plausible` for two signature columns; ``and`` stops at the first batch that fails."""
    matches, out = F.lit(0), F.lit(True)
    for nth, least in enumerate(LEAST):
        for at in range(nth * BATCH // 32, (nth + 1) * BATCH // 32):
            odd = F.get(a, at).bitwiseXOR(F.get(b, at))
            odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 1))
            matches = matches + 32 - F.bit_count(odd.bitwiseAND(F.lit(0x5555555555555555)))
        out = out & (matches >= least)
    return out


PRINT = "doc_id long, text_hash long, n_shingles long, high long, low long, signature array<long>, bands array<long>"


def prints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row per document: set size, digest of the set, signature and bands."""
    prepare(spark)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, high, low, signatures, bands = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(text)
                sizes.append(len(hashes))
                if not len(hashes):
                    for column in (high, low, signatures, bands):
                        column.append(None)
                    continue
                least = minima(hashes)
                top, bottom = digest(hashes)
                high.append(top)
                low.append(bottom)
                signatures.append(signature(least))
                bands.append(band_keys(least))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(signatures, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n_shingles", "high", "low", "signature", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"),
                       F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(of, PRINT).withColumn("row", F.monotonically_increasing_id())


def _sets(spark: SparkSession, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles): the full sets of the wanted classes, read anew from the text of
    one document of each."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"), "text")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found = rows.join(F.broadcast(wanted) if few else wanted,
                      (wanted.text_hash == rows.text_hash)
                      & wanted.doc_id.eqNullSafe(rows.doc_id))
    found = found.select("node", "high", "low", F.col("text").cast("binary").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            columns = (batch.column(c).to_pylist() for c in ("node", "high", "low", "text"))
            for node, high, low, text in zip(*columns):
                hashes = shingle_hashes(text)
                if digest(hashes) == (high, low):  # the class's set, not another text
                    nodes.append(node)
                    sets.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["node", "shingles"])

    sets = stage(spark, found.mapInArrow(of, "node long, shingles array<long>"), "minhash-sets")
    if sets.count() == wanted.count():
        return sets
    # Rows that repeat an id with its text.
    return stage(spark, sets.dropDuplicates(["node"]), "minhash-sets")


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that survive the batches and are similar on their full sets."""
    signed, full = classes.select("node", "signature"), sets.select("node", "shingles")
    for side in ("b", "a"):
        pairs = pairs.join(signed.toDF(side, f"sign_{side}"), side)
    pairs = pairs.where(survives(F.col("sign_a"), F.col("sign_b"))).select("a", "b")
    for side in ("b", "a"):
        pairs = pairs.join(full.toDF(side, f"set_{side}"), side)
    inter = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.where(100 * inter >= PERCENT * (F.size("set_a") + F.size("set_b") - inter)
                       ).select("a", "b")


def block_links(nodes, labels, signatures, sets, first: np.ndarray, second: np.ndarray) -> list:
    """Links between members ``first`` and ``second`` (positions) that join different
    labels; of links that join what others have joined, one is enough."""
    a, b = np.meshgrid(first, second, indexing="ij")
    a, b = a.ravel(), b.ravel()
    sizes = np.array([len(s) for s in sets], np.int64)
    small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    fits = (labels[a] != labels[b]) & (100 * small >= PERCENT * large)
    if first is second:
        fits &= a < b
    a, b = a[fits], b[fits]
    keep = [plausible(signatures[a[at:at + 65536]], signatures[b[at:at + 65536]])
            for at in range(0, len(a), 65536)]
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    a, b = a[keep], b[keep]
    if not len(a):
        return []
    left, at_left = np.unique(a, return_inverse=True)
    right, at_right = np.unique(b, return_inverse=True)
    inter = _intersections([sets[i] for i in left], [sets[i] for i in right])[at_left, at_right]
    linked = 100 * inter >= PERCENT * (sizes[a] + sizes[b] - inter)
    out, to = [], {}

    def find(x):
        while (up := to.setdefault(x, x)) != x:
            to[x] = x = to[up]
        return x

    for i, j in zip(a[linked], b[linked]):
        x, y = find(labels[i]), find(labels[j])
        if x != y:
            to[max(x, y)] = min(x, y)
            out.append((nodes[i], nodes[j]))
    return out


def _intersections(left: list, right: list) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        inside = np.isin(values, shared)
        place, owner = np.searchsorted(shared, values[inside]), owner[inside]
        order = np.argsort(place, kind="stable")
        sides.append((len(sets), place[order], owner[order]))
    out = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(shared), PIECE):
        parts = []
        for count, place, owner in sides:
            of = slice(*np.searchsorted(place, [at, at + PIECE]))
            part = np.zeros((count, PIECE), np.float32)
            part[owner[of], place[of] - at] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def _block_links(spark: SparkSession, members: DataFrame, classes: DataFrame,
                 sets: DataFrame) -> DataFrame:
    """Links between different labels among members (key, node, low, label) of buckets
    whose smallest node is ``low``.

    A node's home is the smallest node of all its buckets, which those of a dense group
    largely share, and the nodes of a home are dealt to blocks. Two blocks meet, once, if
    a bucket holds nodes of both: so any two nodes of a bucket meet, in one task of at
    most two blocks.
    """
    homes = members.groupBy("node").agg(F.min("low").alias("home"),
                                        F.min("label").alias("label"))
    rows = stage(spark, homes.join(sets, "node").join(classes.select("node", "signature"), "node"),
                 "minhash-homes")
    tiles = rows.groupBy("home").agg(F.greatest(
        F.ceil(F.sum(8 * F.size("shingles") + 128) / TILE_BYTES),
        F.ceil(F.count(F.lit(1)) / TILE_ROWS)).alias("tiles"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("tiles")))
    placed = stage(spark, rows.select("node", "home").join(tiles, "home").select(
        "node", block.alias("block")), "minhash-blocks")
    held = stage(spark, members.select("key", "node").join(placed, "node")
                 .select("key", "block").distinct(), "minhash-held")
    meetings = held.select("key", F.col("block").alias("i")).join(
        held.select("key", F.col("block").alias("j")), "key").where("i <= j")
    meetings = meetings.select("i", "j").distinct()
    sides = meetings.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    dealt = rows.join(placed, "node").join(sides, "block")

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        own, i, j = frame.block.to_numpy(), frame.i.iat[0], frame.j.iat[0]
        first = np.nonzero(own == i)[0]
        second = first if i == j else np.nonzero(own == j)[0]
        found = block_links(frame.node.to_numpy(), frame.label.to_numpy(),
                            np.stack(frame.signature).view(np.uint8),
                            [np.asarray(s, np.int64) for s in frame.shingles], first, second)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (dealt.select("i", "j", "block", "node", "label", "signature", "shingles")
            .groupBy("i", "j").applyInPandas(meet, "a long, b long"))


def links(spark: SparkSession, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between classes that leave reachable what similarity links.

    ``classes`` is a staged table (node, doc_id, text_hash, high, low, signature,
    bands) with a row per class.
    """
    banded = classes.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("top"))
    members = stage(spark, banded.join(buckets.where("low < top"), "key").select(
        "key", "node", "low"), "minhash-members")
    wanted = stage(spark, members.select("node").distinct().join(
        classes.select("node", "doc_id", "text_hash", "high", "low"), "node"), "minhash-wanted")
    sets = _sets(spark, docs, wanted)

    star = members.where("node > low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    first = stage(spark, _verified(star.distinct(), classes, sets), "minhash-star")
    # Nodes of one label are linked: the smallest linked node of the smallest linked one.
    once = first.groupBy("b").agg(F.min("a").alias("a"))
    twice = once.select(F.col("b").alias("node"), F.col("a").alias("b")).join(
        once.select("b", F.col("a").alias("up")), "b", "left").select(
        "node", F.coalesce("up", "b").alias("label"))
    # What is left: members but the smallest, of buckets that hold several labels.
    rest = (members.where("node > low").join(twice, "node", "left")
            .withColumn("label", F.coalesce("label", "node")))
    rest = stage(spark, rest, "minhash-rest")
    mixed = rest.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    rest = stage(spark, rest.join(mixed.where("least < most").select("key"), "key"), "minhash-mixed")
    return first.union(stage(spark, _block_links(spark, rest, classes, sets), "minhash-met"))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    seen = stage(spark, prints(spark, docs), "minhash-prints")
    filled = seen.where(F.col("n_shingles") > 0)
    same = stage(spark, filled.groupBy("high", "low").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("first_id")), "minhash-same")
    classes = stage(spark, filled.join(same.select("node"), F.col("row") == F.col("node")).select(
        "node", "doc_id", "text_hash", "n_shingles", "high", "low", "signature", "bands"),
        "minhash-classes")
    found = components(spark, links(spark, docs, classes), "minhash")
    rooted = same.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    placed = stage(spark, rooted.join(ids, "root").select("high", "low", "component_id"),
                   "minhash-placed")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (seen.select("doc_id", "n_shingles", "high", "low").join(placed, ["high", "low"], "left")
            .select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
