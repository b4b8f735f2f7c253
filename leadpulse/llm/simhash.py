"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of a
text's word shingles. Two fingerprints within ``max_bits`` bits share a variant
that lies within half the distance of each. So every distinct fingerprint
emits all variants within half the radius, and the shuffle on variants brings
together all that can link. (For an odd radius a second, wider ball probes.)
The narrow balls of a variant are within ``max_bits`` of one another, so a link
from each member to the smallest keeps what is reachable and never lists
pairs; each link's bit distance is verified.

Defined cases: a null or empty text has the fingerprint zero and links like any
other. Texts of fewer words than a shingle count as one shingle. Exact copies
share one fingerprint and are linked once. ``component_id`` is the smallest id
reachable; it is null only where no member has an id. An empty table gives no
rows.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadpulse.llm.common import components, free_name, prepare, stage

WORDS = 3
MAX_BITS = 2
SEED = 42
PIECE = 1 << 16  # shingles whose bits are counted at a time


def simhash(text: bytes | None, words: int = WORDS) -> int:
    """Fingerprint of a UTF-8 text, as a signed 64-bit number."""
    tokens = (text or b"").lower().split()  # of bytes: A-Z and \x20\x09-\x0D alone
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles, n = [b" ".join(tokens)], 1
    else:
        n = len(tokens) - words + 1
        shingles = map(b" ".join, zip(*(tokens[j:j + n] for j in range(words))))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, PIECE):
        bits = np.unpackbits(h[at:at + PIECE].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def with_fingerprint(spark: SparkSession, docs: DataFrame, out: str, text: str = "text",
                     words: int = WORDS) -> DataFrame:
    """``docs`` with the fingerprint ``out``, a long."""
    prepare(spark)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, words) for t in texts], dtype="int64")

    return docs.withColumn(out, of(F.col(text).cast("binary")))


def hex_of(fingerprint: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def masks(radius: int) -> list[int]:
    """All 64-bit numbers of at most ``radius`` ones, as signed longs."""
    found = [sum(1 << b for b in bits) for r in range(radius + 1)
             for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that leave reachable
    what is within ``max_bits`` steps."""
    narrow, wide = masks(max_bits // 2), masks(max_bits - max_bits // 2)
    ball = F.array(*[F.lit(m).cast("long") for m in wide])
    at = F.posexplode(ball).alias("nth", "mask")
    variants = prints.select("fp", at).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"),
        (F.col("nth") < len(narrow)).alias("is_base"))
    low = F.min(F.when(F.col("is_base"), F.col("fp"))).over(Window.partitionBy("variant"))
    met = variants.withColumn("low", low).where(F.col("low") != F.col("fp"))
    near = F.bit_count(F.col("low").bitwiseXOR(F.col("fp"))) <= max_bits
    return met.where(near).select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct()


def groups(spark: SparkSession, prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id, root): each distinct fingerprint's component.

    ``prints`` has (doc_id, fp), a row per document; should be a staged table.
    """
    distinct = stage(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    found = components(spark, links(distinct, max_bits), "simhash")
    placed = (distinct.join(found, distinct.fp == found.node, "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    placed = stage(spark, placed, "simhash-roots")
    ids = stage(spark, placed.groupBy("root").agg(F.min("first_id").alias("component_id")),
                "simhash-ids")
    return stage(spark, placed.join(ids, "root").select("fp", "component_id", "root"),
                 "simhash-groups")


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = stage(spark, with_fingerprint(spark, texts, "fp", words=words)
                   .select("doc_id", "fp"), "simhash-docs")
    return (prints.join(groups(spark, prints, max_bits).drop("root"), "fp")
            .select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id"))


def deduplicated(spark: SparkSession, docs: DataFrame, words: int = WORDS,
                 max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group: that of the smallest id (rows without an id
    come last), of equal ids one by a hash of its text, of equal rows any one.

    Fingerprints are computed once; the rows that stay are found by id and text
    hash, so that the documents move once and copies of a text do not meet.
    """
    def keys(df: DataFrame) -> dict[str, Column]:
        known = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
        return {"no_id": F.col("doc_id").isNull(), "id": known, "high": F.xxhash64("text"),
                "low": F.xxhash64(F.lit("low"), "text")}

    texts = with_fingerprint(spark, docs.select("doc_id", "text"), "fp", words=words)
    prints = stage(spark, texts.select(F.col("doc_id").cast("long").alias("doc_id"), "fp",
                                       *[c.alias(n) for n, c in keys(docs).items()]), "simhash-docs")
    placed = prints.join(groups(spark, prints, max_bits).select("fp", "root"), "fp")
    first = F.struct(*keys(docs))
    kept = placed.groupBy("root").agg(F.min(first).alias("first")).select("first.*")
    kept = stage(spark, kept, "simhash-kept")
    names = [free_name(docs, f"_key_{c}") for c in kept.columns]
    wide = docs.withColumns(dict(zip(names, keys(docs).values())))
    return wide.join(kept.toDF(*names), names).dropDuplicates(names).select(
        *[F.col(f"`{c}`") for c in docs.columns])
