"""Trie of conversations by their turns, with sums over subtrees.

A node is a distinct sequence of first turns; the root is the empty one. Turns
carry a 128-bit hash of their place, role and text, and a prefix is named by the
exclusive or of its turns' hashes, so that long conversations are cut into
pieces and scanned in parallel. Nodes are the distinct names, counted over all
conversations with partial aggregates; that the conversations of a node agree in
depth, parent and the turn's MD5 is verified for each.

Sums over subtrees are made in shards. ``SHARD_ROWS`` bounds the turns below a
node of the lowest level; the next level takes what is below the square of it,
and so on, so that a subtree of one level is never large, however many
conversations begin alike. Subtrees are dealt to shards by their top. In a
shard, a minimal perfect hash gives each name a slot, which a comparison with
the name kept there verifies. Counts are scattered into flat arrays by slot, and
subtree sums run through the array of parents' slots, from the deepest nodes up.
What the tops of a level hold is added to their parents in the levels above.

Defined cases: conversations without an id take no part; a null role or text is
empty; turns that tie come by role, then text, in the order of their bytes;
repeated rows are turns each. An empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadpulse.llm.common import prepare, row_numbers, stage

PIECE = 1024          # turns of a conversation that one task scans
SHARD_ROWS = 4096     # turns below a node of the lowest level; nodes of a shard, about
ENDS = 4096           # ids of a piece of a node's list of ends
OPENING = 5           # turns that conversations share at most
BASE = 100            # ids whose conversations share an opening


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit names (two arrays of unsigned longs):
    levels of bits, each for the names that collided on the level before."""

    def __init__(self, high: np.ndarray, low: np.ndarray, spread: float = 2.0):
        self.size, self.levels, start = len(high), [], 0
        rest = np.arange(len(high))
        while len(rest):
            width = max(64, int(spread * len(rest)))
            place = self._place(high[rest], low[rest], len(self.levels), width)
            alone = np.bincount(place, minlength=width) == 1
            self.levels.append((alone, start + np.cumsum(alone) - 1))
            start += int(alone.sum())
            rest = rest[~alone[place]]

    @staticmethod
    def _place(high, low, level: int, width: int) -> np.ndarray:
        x = high ^ (low * np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * level + 1))
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(29)) ^ (low >> np.uint64(level % 17))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(width)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """A slot per name. A name that was not hashed gets any slot, or -1."""
        out = np.full(len(high), -1, np.int64)
        rest = np.arange(len(high))
        for level, (bits, rank) in enumerate(self.levels):
            place = self._place(high[rest], low[rest], level, len(bits))
            hit = bits[place]
            out[rest[hit]] = rank[place[hit]]
            rest = rest[~hit]
        return out


class NodeTable:
    """Names of nodes in the slots of a perfect hash."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.hash = PerfectHash(high, low)
        self.slot = self.hash.slots(high, low)
        self.high, self.low = np.empty_like(high), np.empty_like(low)
        self.high[self.slot], self.low[self.slot] = high, low

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slots of the names, -1 for a name that its slot does not hold."""
        if not len(self.high):
            return np.full(len(high), -1, np.int64)
        slot = self.hash.slots(high, low)
        same = (slot >= 0) & (self.high[slot] == high) & (self.low[slot] == low)
        return np.where(same, slot, -1)


def subtree_sums(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums of a shard's nodes. ``children``, ``leaves`` and ``saved`` hold what
    subtrees of lower levels bring; ``up_id`` is -1 where the parent is no node here."""
    names = [frame[c].to_numpy().view(np.uint64) for c in ("high", "low", "up_high", "up_low")]
    table = NodeTable(*names[:2])
    slot = table.slot

    def scattered(values) -> np.ndarray:
        out = np.empty(len(frame), np.int64)
        out[slot] = values
        return out

    is_root = frame.depth.to_numpy() == 0  # the root's own name is all it has above it
    parent = scattered(np.where(is_root, -1, table.find(*names[2:])))
    depth, ids = scattered(frame.depth), scattered(frame.conv_id)
    children = scattered(frame.children)
    inner = parent >= 0
    children += np.bincount(parent[inner], minlength=len(frame))
    leaves = scattered(frame.leaves) + (children == 0)
    saved = scattered(frame.saved + (frame.n_convs - 1) * frame.chars)
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.nonzero(np.diff(depth[order]))[0] + 1):
        level = level[inner[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return frame.assign(children=children[slot], leaves=leaves[slot], saved=saved[slot],
                        up_id=np.where(inner, ids[parent], 0)[slot], inner=inner[slot])[SUMS]


BROUGHT = ["children", "leaves", "saved"]
SUMS = ["high", "low", "up_high", "up_low", "depth", "conv_id", "n_convs", "children", "leaves",
        "saved", "up_id", "inner"]
SUMS_SCHEMA = ", ".join(f"{c} {'boolean' if c == 'inner' else 'long'}" for c in SUMS)


def _md5_long(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def ordered_turns(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, chars) per turn, from place 0, and (conv_id, n) per
    conversation; both staged."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("conv_id").isNotNull())
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # The bounds of the ranges are short, however long the texts.
    ranges = [*order[:2], F.substring("role", 1, 32), F.substring("text", 1, 32)]
    numbered = row_numbers(spark, rows, order, "turns", ranges=ranges)
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    turns = stage(spark, numbered.select("conv_id", "row", digest.alias("digest"),
                                         F.length("text").cast("long").alias("chars")), "digests")
    convs = stage(spark, turns.groupBy("conv_id").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("n")), "convs")
    placed = turns.join(convs.select("conv_id", "first"), "conv_id").select(
        "conv_id", (F.col("row") - F.col("first")).alias("pos"), "digest", "chars")
    return stage(spark, placed, "turns"), convs.select("conv_id", "n")


def shared_openings(spark: SparkSession, turns: DataFrame,
                    convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h = crc32(id) % 6 turns of the conversation of the
    hundred's first id, then the own turns after the first h. Same columns; ``pos``
    has no gaps, and a conversation may have no turns."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (OPENING + 1)
    base = F.col("conv_id") - F.col("conv_id") % BASE
    plan = convs.withColumns({"h": h, "base": base})
    bases = convs.where(F.col("conv_id") % BASE == 0).select(
        F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = plan.join(bases, "base", "left").withColumn(
        "k", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = stage(spark, plan.select("conv_id", "base", "h", "k", (
        F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), "openings")
    opening = turns.where((F.col("conv_id") % BASE == 0) & (F.col("pos") < OPENING))
    # At most 199 conversations share a base.
    given = (opening.withColumnRenamed("conv_id", "base")
             .join(plan.select("conv_id", "base", "h"), "base").where(F.col("pos") < F.col("h"))
             .select("conv_id", "pos", "digest", "chars"))
    own = (turns.join(plan.select("conv_id", "h", "k"), "conv_id")
           .where(F.col("pos") >= F.col("h"))
           .select("conv_id", (F.col("k") + F.col("pos") - F.col("h")).alias("pos"), "digest",
                   "chars"))
    return stage(spark, given.unionByName(own), "rebuilt"), plan.select("conv_id", "n")


def prefixes(spark: SparkSession, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and depth from 0: the names of the prefix (high, low) and of
    its parent, the last turn's check and length, and ``below``, the depths from here on."""
    depth = F.col("pos") + 1
    hashed = turns.select("conv_id", depth.alias("depth"), "chars",
                          F.floor(F.col("pos") / PIECE).alias("piece"),
                          F.xxhash64(depth, "digest").alias("x"),
                          F.xxhash64(F.lit("low"), "digest", depth).alias("y"),
                          _md5_long(F.col("digest")).alias("check"))
    pieces = hashed.groupBy("conv_id", "piece").agg(F.bit_xor("x").alias("x"),
                                                    F.bit_xor("y").alias("y"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "piece", *[
        F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("x", "y")])
    here = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    named = hashed.withColumns({"high": F.bit_xor("x").over(here), "low": F.bit_xor("y").over(here)})
    named = named.join(pieces, ["conv_id", "piece"]).join(convs, "conv_id").select(
        "conv_id", "depth", F.col("high").bitwiseXOR(F.col("x0")).alias("high"),
        F.col("low").bitwiseXOR(F.col("y0")).alias("low"), "x", "y", "check", "chars",
        (F.col("n") - F.col("depth") + 1).alias("below"))
    named = named.select("conv_id", "depth", "high", "low",
                         F.col("high").bitwiseXOR(F.col("x")).alias("up_high"),
                         F.col("low").bitwiseXOR(F.col("y")).alias("up_low"),
                         "check", "chars", "below")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", *[zero.alias(c) for c in (
        "depth", "high", "low", "up_high", "up_low", "check", "chars")],
        (F.col("n") + 1).alias("below"))
    return stage(spark, named.unionByName(roots), "prefixes")


def _nodes(spark: SparkSession, entries: DataFrame) -> DataFrame:
    same = ("depth", "up_high", "up_low", "check")
    nodes = entries.groupBy("high", "low").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("chars").alias("chars"), F.sum("below").alias("below"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_most") for c in same])
    clash = F.lit(False)
    for c in same:
        clash = clash | (F.col(c) != F.col(f"{c}_most"))
    checked = F.when(clash, F.raise_error(F.lit("two prefixes share a name")).cast("long"))
    return nodes.withColumn("depth", F.coalesce(checked, "depth")).drop(
        *[f"{c}_most" for c in same], "check")


def trie(spark: SparkSession, turns: DataFrame, convs: DataFrame,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of conversations: ``turns`` (conv_id, pos, digest, chars), ``pos`` without
    gaps from 0, and ``convs`` (conv_id, n) with all of them, those of no turns too."""
    prepare(spark)
    entries = prefixes(spark, turns, convs)
    nodes = stage(spark, _nodes(spark, entries), "nodes")
    total = nodes.agg(F.max("below").alias("most")).first().most or 0
    limits = [shard_rows]
    while limits[-1] < total:
        limits.append(limits[-1] * shard_rows)
    level = F.lit(0)
    for limit in limits[:-1]:
        level = level + (F.col("below") > limit).cast("int")
    nodes = nodes.withColumn("level", level)
    # The top of a level on a conversation's path: its first node there.
    tops = (entries.select("conv_id", "high", "low", "depth")
            .join(nodes.select("high", "low", "level"), ["high", "low"])
            .groupBy("conv_id", "level").agg(F.min_by("high", "depth").alias("top_high"),
                                             F.min_by("low", "depth").alias("top_low")))
    nodes = stage(spark, nodes.join(tops, ["conv_id", "level"]), "leveled")
    sizes = {r.level: r.n for r in nodes.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
             .collect()}
    done, brought = [], None
    for at in range(len(limits)):
        here = nodes.where(F.col("level") == at)
        if brought is None:
            here = here.withColumns({c: F.lit(0).cast("long") for c in BROUGHT})
        else:
            here = here.join(brought, ["high", "low"], "left").withColumns(
                {c: F.coalesce(c, F.lit(0)) for c in BROUGHT})
        shards = -(-sizes.get(at, 0) // shard_rows) or 1
        here = here.withColumn("shard", F.pmod(F.xxhash64("top_high", "top_low"), F.lit(shards)))
        sums = stage(spark, here.select("shard", "high", "low", "up_high", "up_low", "depth",
                                        "conv_id", "n_convs", "chars", *BROUGHT)
                     .groupBy("shard").applyInPandas(subtree_sums, SUMS_SCHEMA), f"sums-{at}")
        done.append(sums)
        up = sums.where(~F.col("inner") & (F.col("depth") > 0)).select(
            F.col("up_high").alias("high"), F.col("up_low").alias("low"),
            F.lit(1).cast("long").alias("children"), "leaves", "saved")
        both = up if brought is None else brought.unionByName(up)
        brought = stage(spark, both.groupBy("high", "low").agg(
            *[F.sum(c).alias(c) for c in BROUGHT]), f"brought-{at}")
    every = done[0]
    for sums in done[1:]:
        every = every.unionByName(sums)
    # Parents outside the shard.
    parents = nodes.select(F.col("high").alias("up_high"), F.col("low").alias("up_low"),
                           F.col("conv_id").alias("far_id"))
    outer = every.where(~F.col("inner")).join(parents, ["up_high", "up_low"]).withColumn(
        "up_id", F.when(F.col("depth") > 0, F.col("far_id")))
    every = every.where("inner").unionByName(outer.drop("far_id"))
    ends = ends_of(spark, entries.where("below = 1").select("high", "low", "conv_id"))
    return every.join(ends, ["high", "low"], "left").select(
        "conv_id", "depth", F.col("up_id").alias("parent_conv_id"), "n_convs",
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def ends_of(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """(high, low, ends_sha256): the digest of the ids that end in each node, in ascending
    order and joined by commas.

    Ranges of the sorted ids are joined in pieces of ``ENDS`` ids where they lie, so
    that a node where very many end sends few rows to the task that digests them, one
    piece at a time.
    """
    key = ["high", "low", "conv_id"]
    ranged = ends.repartitionByRange(*key).sortWithinPartitions(*key)

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            name = frame.high.diff().ne(0) | frame.low.diff().ne(0)
            groups = frame.groupby([name.cumsum(), frame.groupby(name.cumsum()).cumcount() // ENDS])
            yield groups.agg(high=("high", "first"), low=("low", "first"),
                             first=("conv_id", "first"),
                             ids=("conv_id", lambda ids: ",".join(map(str, ids))))

    cut = stage(spark, ranged.mapInPandas(pieces, "high long, low long, first long, ids string"),
                "ends")

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, sha = None, None
        for frame in frames:
            out = []
            for high, low, ids in zip(frame.high, frame.low, frame.ids):
                if name != (high, low):
                    if name is not None:
                        out.append((*name, sha.hexdigest()))
                    name, sha = (high, low), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["high", "low", "ends_sha256"])
        if name is not None:
            yield pd.DataFrame([(*name, sha.hexdigest())], columns=["high", "low", "ends_sha256"])

    gathered = cut.repartition("high", "low").sortWithinPartitions("high", "low", "first")
    return gathered.mapInPandas(digests, "high long, low long, ends_sha256 string")


def opening_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt by :func:`shared_openings`."""
    turns, convs = ordered_turns(spark, conversations)
    return trie(spark, *shared_openings(spark, turns, convs))
