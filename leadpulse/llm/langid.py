"""Language identification by Bayesian evidence fusion.

The evidence of a row: its text (naive Bayes over hashed character trigrams),
the language that its markup declares, the suffix of its address, and the
languages of its host. Host priors come from grouped aggregation: the expected
language counts of a host, smoothed towards those of its domain, smoothed
towards those of all rows, each without the row itself.

The text model is fitted on a bounded sample of labelled rows (``FIT_ROWS``);
host, domain and global counts cover all rows.

Defined cases: a null text has no text evidence, a null address no host (rows
without one share the empty host). Without any evidence the prior decides. Ties
go to the language first in the alphabet. Without labelled rows the language is
null and its probability 0. An empty table gives no rows.
"""

from __future__ import annotations

import html as markup
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm.common import free_name, prepare, stage

FIT_ROWS = 8000      # labelled rows that the text model is fitted on, at most
BUCKETS = 1 << 15
EFFECTIVE = 40       # a text weighs as so many independent trigrams, at most
PIECE = 1 << 20      # characters looked at at a time
MARKUP_TRUST = 0.9   # probability that a declared language is right
SUFFIX_TRUST = 0.8   # probability that an address suffix is right
STRENGTH = 4.0       # rows that a prior one level up counts as

# Languages of country suffixes.
SUFFIX_LANG = {
    "ar": "es", "at": "de", "au": "en", "cl": "es", "co": "es", "de": "de", "es": "es",
    "fr": "fr", "gb": "en", "ie": "en", "it": "it", "li": "de", "mx": "es", "nl": "nl",
    "nz": "en", "pe": "es", "pl": "pl", "pt": "pt", "uk": "en", "us": "en", "ve": "es",
}

_SKIP = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*>")
_DECLARED = re.compile(r"(?is)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b")

# Letters a-z and everything beyond ASCII stay; the rest separates words.
_CLASS = np.array([c if chr(c).isalpha() else 32 for c in range(128)], dtype=np.uint32)


def visible_text(html: str | None) -> str:
    """Text of a page without scripts, styles, comments and tags."""
    return markup.unescape(_SKIP.sub(" ", html or ""))


def declared_lang(html: str | None) -> str | None:
    found = _DECLARED.search(html or "")
    return found[1].lower() if found else None


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the trigrams of a text, piece by piece."""
    text = text or ""
    for at in range(0, len(text), PIECE):
        raw = text[at:at + PIECE + 2].lower().encode("utf-32-le", "surrogatepass")
        c = np.frombuffer(raw, dtype="<u4")
        c = np.where(c < 128, _CLASS[np.minimum(c, 127)], c)
        if len(c) < 3:
            continue
        keep = (c[1:-1] != 32) | ((c[:-2] != 32) & (c[2:] != 32))
        h = (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77)
             ^ c[2:] * np.uint32(0xC2B2AE3D))
        yield ((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1))[keep]


class TextModel:
    """Log probabilities of the buckets by language."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        rows = [np.log((counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS)) for x in self.langs]
        self.table = np.array(rows, dtype=np.float32).reshape(len(rows), BUCKETS)

    def evidence(self, text: str | None) -> np.ndarray:
        """Log likelihood by language, as of ``EFFECTIVE`` trigrams at most."""
        total, n = np.zeros(len(self.langs)), 0
        for buckets in trigrams(text):
            total += self.table[:, buckets].sum(axis=1, dtype=np.float64)
            n += len(buckets)
        return total * (min(n, EFFECTIVE) / n) if n else total

    def said(self, lang: str | None, trust: float) -> np.ndarray:
        """Log likelihood of a language being named, by language."""
        if lang not in self.langs or len(self.langs) < 2:
            return np.zeros(len(self.langs))
        other = math.log((1 - trust) / (len(self.langs) - 1))
        return np.array([math.log(trust) if x == lang else other for x in self.langs])


def fit(spark: SparkSession, labelled: DataFrame, rows: int = FIT_ROWS) -> TextModel:
    """Text model of ``labelled`` (doc_id, text, lang): of the ``rows`` of them
    that a hash of the id puts first."""
    prepare(spark)
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    first = (usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(rows))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame.lang, frame.text):
                mine = sums.setdefault(lang, np.zeros(BUCKETS))
                for buckets in trigrams(text):
                    mine += np.bincount(buckets, minlength=BUCKETS)
        for lang, mine in sums.items():
            at = np.flatnonzero(mine)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": mine[at].astype("int64")})

    # At most FIT_ROWS ids.
    sample = usable.join(F.broadcast(first), "doc_id", "left_semi").select("lang", "text")
    sums = (sample.mapInPandas(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = {}
    for lang, part in sums.groupby("lang"):
        counts[lang] = np.zeros(BUCKETS)
        counts[lang][part.bucket.to_numpy()] = part.n.to_numpy()
    return TextModel(counts)


def host_of(address: Column) -> Column:
    """Lower-case host of an address; empty if it has none."""
    host = F.regexp_extract(F.lower(address), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.when(address.contains("//"), host).otherwise(F.lower(address)), F.lit(""))


def _array_sum(name: str, n: int) -> Column:
    return F.array(*[F.sum(F.col(name)[i]) for i in range(n)])


def _smoothed(counts: Column, own: Column, prior: Column) -> Column:
    """Expected counts without the row itself, smoothed towards a prior."""
    left = F.zip_with(counts, own, lambda c, o: F.greatest(c - o, F.lit(0.0)))
    total = F.aggregate(left, F.lit(0.0), lambda s, x: s + x) + STRENGTH
    return F.zip_with(left, prior, lambda c, p: (c + STRENGTH * p) / total)


def identify(spark: SparkSession, rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows`` (any columns, of which text, html and address are evidence)
    without these three, with lang, prob, text_lang, declared_lang, suffix_lang.
    """
    prepare(spark)
    n = len(model.langs)
    keys = [c for c in rows.columns if c not in ("text", "html", "address")]
    if not n:
        none = F.lit(None).cast("string")
        return rows.select(*keys, none.alias("lang"), F.lit(0.0).alias("prob"),
                           none.alias("text_lang"), none.alias("declared_lang"),
                           none.alias("suffix_lang"))
    shared = spark.sparkContext.broadcast(model)
    langs = model.langs

    @F.pandas_udf("log array<double>, p array<double>, text_lang string, declared string, "
                  "suffix string")
    def look(text: pd.Series, html: pd.Series, host: pd.Series) -> pd.DataFrame:
        m, out = shared.value, []
        for t, h, where in zip(text, html, host):
            of_text = m.evidence(t if h is None else visible_text(h))
            declared = declared_lang(h)
            suffix = SUFFIX_LANG.get(where.rpartition(".")[2]) if "." in where else None
            log = of_text + m.said(declared, MARKUP_TRUST) + m.said(suffix, SUFFIX_TRUST)
            p = np.exp(log - log.max())
            out.append((log - log.max(), p / p.sum(),
                        m.langs[int(of_text.argmax())] if of_text.any() else None,
                        declared, suffix))
        return pd.DataFrame(out, columns=["log", "p", "text_lang", "declared", "suffix"])

    at, zone, e, by_host, by_zone, post = (free_name(rows, f"_lang_{c}") for c in (
        "host", "domain", "evidence", "of_host", "of_domain", "posterior"))
    host = host_of(F.col("address"))
    seen = rows.select(*keys, host.alias(at), look("text", "html", host).alias(e))
    seen = stage(spark, seen.withColumn(zone, F.substring_index(at, ".", -2)), "lang-evidence")
    hosts = stage(spark, seen.select(at, zone, F.col(f"{e}.p").alias("p")).groupBy(at, zone)
                  .agg(_array_sum("p", n).alias(by_host)), "lang-hosts")
    zones = hosts.groupBy(zone).agg(_array_sum(by_host, n).alias(by_zone))
    total = hosts.agg(_array_sum(by_host, n).alias("all")).first()["all"]
    everywhere = np.array([x or 0.0 for x in total]) + 1
    base = F.array(*[F.lit(float(x)) for x in everywhere / everywhere.sum()])
    # Staged, so that Spark can split the join's partition of a hot host.
    priors = stage(spark, hosts.join(zones, zone).drop(zone), "lang-priors")
    own = F.col(f"{e}.p")
    prior = _smoothed(F.col(by_host), own, _smoothed(F.col(by_zone), own, base))
    scored = seen.join(priors, at).withColumn(post, F.zip_with(
        F.col(f"{e}.log"), prior, lambda x, p: F.exp(x) * p))
    best = F.array_max(post)
    names = F.array(*[F.lit(x) for x in langs])
    return scored.select(
        *keys, F.element_at(names, F.array_position(post, best).cast("int")).alias("lang"),
        (best / F.aggregate(post, F.lit(0.0), lambda s, x: s + x)).alias("prob"),
        F.col(f"{e}.text_lang").alias("text_lang"), F.col(f"{e}.declared").alias("declared_lang"),
        F.col(f"{e}.suffix").alias("suffix_lang"))


def evidence_rows(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents (their source as host) and pages as rows for ``identify``."""
    none = F.lit(None)
    text = none.cast("string")
    of_docs = docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long")
                          .alias("doc_id"), none.cast("long").alias("page_id"), "text",
                          text.alias("html"), F.col("source").alias("address"))
    of_pages = pages.select(F.lit("page").alias("kind"), none.cast("long").alias("doc_id"),
                            F.col("page_id").cast("long").alias("page_id"), text.alias("text"),
                            F.coalesce("html", F.lit("")).alias("html"),
                            F.col("url").alias("address"))
    return of_docs.unionByName(of_pages)
