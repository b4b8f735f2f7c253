"""Secret scans by corpus-wide ownership frequency.

Every whole text is searched for candidates: assignments of secrets, access
keys, long hex strings, and (added to these) tokens of known shapes and private
keys. A candidate's value, of a private key its body, is hashed at once. The distinct owners
(sources) and repositories (an owner's different texts) of each hash, counted over the
whole corpus, separate widely copied examples from owner-specific values, which look
live: those of few owners, however many repositories these have, and those of some
owners that repeat them in very many repositories each.

DataFrame functions only. A text's matches and the gaps between them come from
one pattern by ``regexp_extract_all`` and ``split``; positions, in code points,
are running sums over them.

Defined cases: a null text has no spans. Equal rows are rows of their own in
the result. A null owner counts as one owner. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadpulse.llm.common import free_name, stage

# kind, pattern, group of the value, least length of it, what the text must
# hold for the pattern to be tried. The order is that of ties.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
     r"""([A-Za-z0-9+/_.=-]+)""", 2, 12, r"(?i:passw|secret|token|api_?key)"),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA"),
    ("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)
ADDED = (
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*", 0, 20, r"eyJ"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{30,}", 0, 34, r"gh[pousr]_"),
    # With its body and END line where it has one; else with the lines that are a key's.
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+"
     r"-----END [A-Z ]*PRIVATE KEY-----|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{32,}+)*+)", 0, 20,
     r"PRIVATE KEY"),
)
KINDS = BASE + ADDED
MAX_OWNERS = 2   # values of so many owners are their own
MAX_FORKS = 4    # so are those of so many owners, with this many repositories an owner
OWN_REPOSITORIES = 50
# What placeholders are made of; a value counts by what it holds beside it.
PLACEHOLDER = (r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|0{8}|1234567"
               r"|password|passwd|secret|token|api|key|here")
PEM_FRAME = r"-----(?:BEGIN|END) [A-Z ]*-----|\s|\\[nr]"
PEM_BODY = 64  # letters of the shortest private key in use
MARK = "[REDACTED]"


def _secret(value: Column, kind: str) -> Column:
    """What makes a value one of its own: of a private key its body alone."""
    return F.regexp_replace(value, PEM_FRAME, "") if kind == "pem" else value


def _plausible(secret: Column, kind: str) -> Column:
    """Eight different characters beside the words of placeholders; in hex, which
    numbers and words may look like, letters and digits as well."""
    plain = F.regexp_replace(secret, PLACEHOLDER, "")
    if kind == "pem":  # a body is long enough to hold any short word by chance
        plain = F.when(F.length(secret) >= PEM_BODY, secret).otherwise(plain)
    out = F.size(F.array_distinct(F.split(plain, ""))) >= 8
    if kind == "hex":
        out &= secret.rlike(r"[a-f]") & secret.rlike(r"[0-9]")
    return out


def _found(text: Column, rank: int) -> Column:
    """Matches of one kind in order, with the gap before each."""
    kind, pattern, group, least, needs = KINDS[rank]
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def one(x: Column) -> Column:
        value = x["values"]
        secret = _secret(value, kind)
        return F.struct(F.length(x["gaps"]).alias("gap"), F.length(x["hits"]).alias("len"),
                        F.length(value).alias("value_len"), (F.length(value) >= least).alias("ok"),
                        F.sha2(secret, 256).alias("hash"),
                        _plausible(secret, kind).alias("plausible"))

    zipped = F.arrays_zip(gaps.alias("gaps"), hits.alias("hits"), values.alias("values"))
    matched = F.filter(F.transform(zipped, one), lambda x: x["len"].isNotNull())
    return F.when(text.rlike(needs), F.struct(F.lit(rank).alias("rank"), matched.alias("found")))


def scan(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans), both staged: a row per document with a number of its own;
    its spans, with how many owners have their value."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("owner"), F.xxhash64(text).alias("text_hash"),
        F.filter(F.array(*[_found(text, i) for i in range(len(KINDS))]),
                 lambda x: x.isNotNull()).alias("kinds"))
    rows = stage(spark, raw, "secret-rows")
    each = rows.select("row", "doc_id", "owner", "text_hash", F.inline("kinds")).select(
        "row", "doc_id", "owner", "text_hash", "rank", F.posexplode("found").alias("nth", "hit"))
    order = Window.partitionBy("row", "rank").orderBy("nth")
    end = F.sum(F.col("hit.gap") + F.col("hit.len")).over(order)
    spans = each.withColumn("end", end).where("hit.ok").select(
        "row", "doc_id", "owner", "text_hash", "rank", (F.col("end") - F.col("hit.len"))
        .alias("start"), "end", "hit.value_len", "hit.hash", "hit.plausible")
    spans = stage(spark, spans, "secret-spans")
    # Repositories per owner first, so that a value in very many texts meets as few rows.
    seen = (spans.select("hash", "owner", "text_hash").distinct()
            .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"),
                                 F.sum("n").alias("repositories")))
    seen = stage(spark, seen, "secret-owners")
    own = (F.col("owners") <= MAX_OWNERS) | (
        (F.col("owners") <= MAX_FORKS)
        & (F.col("repositories") >= OWN_REPOSITORIES * F.col("owners")))
    live = F.col("plausible") & own
    return rows, stage(spark, spans.join(seen, "hash").withColumn("live", live), "secret-live")


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of their spans,
    all spans, and how many of these look live or like examples."""
    rows, spans = scan(spark, docs)
    kinds = F.array(*[F.lit(k[0]) for k in KINDS])
    item = F.struct("start", "rank", F.concat_ws(
        ":", F.element_at(kinds, F.col("rank") + 1), "start", "end").alias("text"), "live")
    per_row = spans.groupBy("row").agg(F.array_sort(F.collect_list(item)).alias("all"))
    both = rows.select("row", "doc_id").join(per_row, "row", "left")
    every = F.coalesce(F.col("all"), F.filter(F.array(F.struct(
        F.lit(0).cast("long").alias("start"), F.lit(0).alias("rank"), F.lit("").alias("text"),
        F.lit(False).alias("live"))), lambda x: F.lit(False)))
    both = both.select("doc_id", every.alias("all"))

    def count(kind: int) -> Column:
        return F.size(F.filter("all", lambda x: x["rank"] == kind)).cast("long")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: x["text"]), ",")

    base = F.filter("all", lambda x: x["rank"] < len(BASE))
    live = F.filter("all", lambda x: x["live"])
    return both.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"), F.size(live).cast("long").alias("n_live"),
        joined(live).alias("live_spans"))


def redacted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with the values that look live replaced by a mark; n_chars
    follows where the text changes."""
    _, spans = scan(spark, docs)
    key, cuts = free_name(docs, "_secret_key"), free_name(docs, "_secret_cuts")
    cut = spans.where("live").select(
        F.struct("doc_id", "text_hash").alias(key),
        (F.col("end") - F.col("value_len")).alias("start"), "end").distinct()
    by = Window.partitionBy(key).orderBy("start", "end")
    past = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (past.isNull() | (F.col("start") > past)).cast("int")
    merged = (cut.withColumn("fresh", fresh).withColumn("at", F.sum("fresh").over(by))
              .groupBy(key, "at").agg(F.min("start").alias("start"), F.max("end").alias("end"))
              .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end")))
                                .alias(cuts)))
    merged = stage(spark, merged, "secret-cuts")
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                   F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))
    both = docs.withColumn(key, own).join(merged, key, "left")
    spot, text = F.col(cuts), F.col("text")

    def between(i: Column) -> Column:
        at = F.when(i > 0, F.get(spot, i - 1)["end"]).otherwise(F.lit(0))
        to = F.coalesce(F.get(spot, i)["start"], F.length(text).cast("long"))
        return F.substring(text, (at + 1).cast("int"), (to - at).cast("int"))

    clean = F.array_join(F.transform(F.sequence(F.lit(0), F.size(spot)), between), MARK)
    columns = []
    for name in docs.columns:
        value = F.col(f"`{name}`")
        if name == "text":
            value = F.when(spot.isNotNull(), clean).otherwise(text)
        elif name == "n_chars":
            value = F.when(spot.isNotNull(), F.length(clean).cast("long")).otherwise(value)
        columns.append(value.alias(name))
    return both.select(*columns)
