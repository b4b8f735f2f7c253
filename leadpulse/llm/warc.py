"""WARC archives: write records with revisits, read them back by
boundary-chain verification.

Writing: equal payloads share one response record, that of the largest page id;
the others are revisit records that refer to it. Records are text rows with the
record end as line separator, so Spark's text writer makes the archives, gzip
files of a bounded number of records.

Reading: a task looks through an archive for everything that looks like the
start of a record, also inside payloads, and emits each candidate's offset and
that of its successor, which its Content-Length implies. Pointer jumping from
the start of the file then marks the candidates that the chain of records
reaches; all others are text inside payloads and are rejected.

Defined cases: a null html is an empty payload. A page without an id is written
without one, and reads back as null. Rows of equal id and payload that hold the
largest id are all responses. Line breaks in addresses are percent-encoded. An
empty table gives no rows. Headers may be of any length. A damaged record ends
its file's chain, which is an error: what follows it could not be read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm.common import prepare, stage
from leadpulse.session import scratch_dir

RECORDS_PER_FILE = 1000
FILE_BYTES = 32 << 20  # payloads of an archive, about; a task reads an archive whole
LEAST_BYTES = 0  # payloads of fewer bytes are never revisits
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END


def base32(digest: Column) -> Column:
    """Base32 of a SHA-1 in hex: each five hex digits give four letters."""
    letters = []
    for at in range(0, 40, 5):
        bits = F.conv(F.substring(digest, at + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            five = F.shiftright(bits, shift).bitwiseAND(F.lit(31))
            letters.append(F.substring(F.lit(BASE32), five + 1, F.lit(1)))
    return F.concat(*letters)


def _pages(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"))


def records(spark: SparkSession, pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The records' text, one row per page, without the end of the record."""
    rows = _pages(pages)
    # One small row per distinct payload. Staged, so that Spark can split the
    # partition of a payload that very many pages share.
    owners = stage(spark, rows.groupBy("digest", "payload_bytes").agg(
        F.max("page_id").alias("owner")), "payloads")
    both = rows.join(owners, ["digest", "payload_bytes"])
    revisit = (F.col("payload_bytes") >= least_bytes) & F.col("owner").isNotNull() & ~F.col(
        "owner").eqNullSafe(F.col("page_id"))
    body = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "payload"))
    length = F.when(revisit, 0).otherwise(F.col("payload_bytes")) + len(HTTP)
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"),
                           "\n", "%0A")

    def line(name: str, *value) -> Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit("\r\n"))

    known = F.col("page_id").isNotNull()
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.when(known, line("WARC-Record-ID", F.lit("<urn:x-page:"), "page_id", F.lit(">")))
        .otherwise(""),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.lit("sha1:"), base32(F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", F.lit("<urn:x-page:"), "owner", F.lit(">")),
            line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit("\r\n"))
    return both.select(F.concat(head, body).alias("value"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str,
                   least_bytes: int = LEAST_BYTES, records_per_file: int | None = None) -> None:
    """Archives of all pages under ``path``, as gzip files.

    A file holds at most ``RECORDS_PER_FILE`` records, or as many of average size as
    make ``FILE_BYTES``.
    """
    if records_per_file is None:
        mean = pages.agg(F.avg(F.octet_length("html")).alias("bytes")).first()["bytes"] or 0
        records_per_file = max(1, min(RECORDS_PER_FILE, int(FILE_BYTES // max(mean, 1))))
    (records(spark, pages, least_bytes).write.option("lineSep", END)
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def unpacked(raw: bytes) -> bytes:
    """Bytes of a file that may be gzip, in one member or many."""
    out = []
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(raw) + member.flush())
        raw = member.unused_data
    return b"".join(out) + raw


MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
FIELD = re.compile(rb"^([A-Za-z0-9-]+):(.*)$", re.M)


def candidates(data: bytes) -> Iterator[tuple]:
    """(offset, next, type, page_id, refers_to, uri, payload_bytes, digest, named) of
    everything in an archive that looks like a record; ``named`` is the digest that
    its header names.

    The payload is measured only where the successor is an end or looks like a
    record too; elsewhere the candidate cannot be on the chain. Candidates
    before the same blank line share the end of their header, which is read once.
    """
    end = END.encode()
    head_end = -1
    for found in MAGIC.finditer(data):
        at = found.start()
        if at > head_end:
            head_end = data.find(end, at)
            if head_end < 0:
                return
            # The last line of a name counts; a candidate has those after its start.
            lines = {m[1].lower(): (m.start(), m[2].strip(b" \t").rstrip(b"\r"))
                     for m in FIELD.finditer(data, found.end(), head_end + 2)}
            length_at, length = lines.get(b"content-length", (-1, b""))
            body = head_end + len(end)
            stop = body + int(length) if re.fullmatch(rb"\d{1,18}", length) else len(data)
            after = stop + len(end)
            whole = data[stop:after] == end and (after == len(data)
                                                 or MAGIC.match(data, after) is not None)
            if whole:
                http_end = data.find(end, body, stop)
                payload = data[http_end + len(end):stop] if http_end >= 0 else b""
                size = len(payload)
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if not whole or length_at < found.end():
            continue
        fields = {k: v for k, (line, v) in lines.items() if line >= found.end()}

        def page(name: bytes) -> int | None:
            number = re.search(rb"urn:x-page:(-?\d+)", fields.get(name, b""))
            return int(number[1]) if number else None

        yield (at, after, fields.get(b"warc-type", b"").decode("utf-8", "replace"),
               page(b"warc-record-id"), page(b"warc-refers-to"),
               fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), size, digest,
               fields.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode(
                   "utf-8", "replace"))


def reachable(offset: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which candidates of a file the chain from offset 0 reaches, by pointer
    jumping: each round doubles the steps that a pointer spans."""
    order = np.argsort(offset)
    starts = offset[order]
    n = len(starts)
    to = np.searchsorted(starts, after[order])
    known = (to < n) & (starts[np.minimum(to, n - 1)] == after[order]) if n else to < n
    jump = np.append(np.where(known, to, n), n)  # n: no successor
    mark = np.zeros(n + 1, dtype=bool)
    mark[:n] = starts == 0
    while True:
        reached = mark.copy()
        reached[jump[mark]] = True
        if (jump == n).all():
            break
        mark, jump = reached, jump[jump]
    out = np.zeros(n, dtype=bool)
    out[order] = reached[:n]
    return out


FOUND = ("path string, offset long, after long, type string, page_id string, refers_to string, "
         "uri string, payload_bytes long, payload_digest string, named_digest string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records on the chains of all archives under ``path``."""
    prepare(spark)
    names = [c.split()[0] for c in FOUND.split(", ")]

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, raw in zip(frame.path, frame.content):
                data = unpacked(raw)
                # Ids as text: pandas would turn longs that may be null into floats.
                rows = [(name, at, after, kind, None if p is None else str(p),
                         None if r is None else str(r), *rest, len(data))
                        for at, after, kind, p, r, *rest in candidates(data)]
                if data and not rows:
                    raise ValueError(f"{name}: no record in {len(data)} bytes")
                yield pd.DataFrame(rows, columns=[*names, "file_bytes"])

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        kept = frame[reachable(frame.offset.to_numpy(), frame.after.to_numpy())]
        read, whole = int(kept.after.max()) if len(kept) else 0, int(frame.file_bytes.iloc[0])
        if read != whole:
            raise ValueError(f"{frame.path.iloc[0]}: the chain of records ends at byte {read} "
                             f"of {whole}")
        return kept.drop(columns="file_bytes")

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.mapInPandas(scan, FOUND + ", file_bytes long")
    # A group is one file's candidates, which the writer's file size bounds.
    kept = found.groupBy("path").applyInPandas(chain, FOUND)
    return kept.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the pages, read the archives back: one row per page."""
    path = scratch_dir(spark, "llm-warc")
    write_archives(spark, pages, path, least_bytes)
    got = stage(spark, read_archives(spark, path), "warc-records")
    # Pages that share an id may differ in payload: a revisit is of the one it names.
    responses = stage(spark, got.where(F.col("type") == "response").groupBy(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("full_digest")).agg(
            F.max("payload_bytes").alias("full_bytes")), "warc-responses")
    revisit = F.col("type") == "revisit"
    named = got.withColumn("full_digest", F.when(revisit, F.col("named_digest")))
    both = named.join(responses, ["refers_to", "full_digest"], "left")
    return both.select(
        "page_id",
        F.when(revisit, F.col("full_bytes")).otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(revisit, F.col("full_digest")).otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
