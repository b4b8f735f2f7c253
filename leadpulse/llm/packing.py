"""Vector bin packing of tokenized examples into sequences.

An example has tokens, takes one segment per sequence that it is in, and bears
loss on its tokens after a prompt. A sequence has a limit on each of the three.
An open sequence takes, among the examples that fit whole, the one whose vector
has the largest dot product with the room that is left. Where none fits, the
longest example is cut to fill the gap. A sequence that stays short (the last
of its group, or one at its segment or loss limit) is cut into sequences whose
lengths are powers of two, which need no padding.

Examples are dealt to groups of a bounded number, each packed in a task.

Defined cases: a null text counts as empty and has the end token alone. Equal
rows are documents of their own. A text longer than a sequence is cut. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm.common import prepare, row_numbers, stage

MAX_TOKENS = 4096
MAX_SEGMENTS = 128
MAX_LOSS = 4096
END_ID = 2
GROUP = 512            # documents in a group, on average
KEPT_WORDS = 400_000   # words of a generation; a worker remembers two of them


def _byte_symbols() -> dict[int, int]:
    """Code points that byte-level tokenizers write bytes as: printable Latin-1
    as it is, the others in order from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(others)}


BYTES = _byte_symbols()


class Encoder:
    """Ids of a tokenizer of lower-case words, by word.

    Such a tokenizer cuts a text into words and encodes each on its own, so the
    ids of words can be remembered. That holds for texts whose characters its
    normalizer maps one by one (``PLAIN``); others are encoded whole.
    """

    PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-įı-ſ]*")
    LETTERS, NUMBERS = "a-zªµºß-öø-ÿĀ-ſ", "0-9²³¹¼½¾"
    WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]"
                       rf"|[^\s{LETTERS}{NUMBERS}]+")

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                        dtype=self.kind).tobytes()

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of words, straight from the model: its symbols are
        the characters that stand for a word's bytes."""
        if len(self.known) > KEPT_WORDS:
            self.known, self.older = {}, self.known
        words = words - self.known.keys()
        back = words & self.older.keys()
        self.known.update((word, self.older[word]) for word in back)
        model = self.tokenizer.model
        for word in words - back:
            symbols = word if word.isascii() else word.encode().decode("latin-1").translate(BYTES)
            ids = array(self.kind.char, [token.id for token in model.tokenize(symbols)])
            self.known[word] = ids.tobytes() if sys.byteorder == "little" else self._ids(word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, little-endian."""
        words = [self.WORDS.findall(t.lower()) if self.PLAIN.fullmatch(t)
                 and not any(s in t for s in self.special) else None for t in texts]
        self._learn(set().union(*filter(None, words)))
        return [self._ids(t) if w is None else b"".join(map(self.known.__getitem__, w))
                for t, w in zip(texts, words)]


_ENCODERS: dict[str, Encoder] = {}  # per worker, by definition


def encoder(definition: str) -> Encoder:
    key = hashlib.md5(definition.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


Piece = tuple[int, int, int]  # example, its start there, length


def pack(lengths, free, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss: int = MAX_LOSS) -> list[list[Piece]]:
    """Sequences of pieces. The first ``free`` tokens of an example bear no loss."""
    start = np.zeros(len(lengths), dtype=np.int64)
    left = np.array(lengths, dtype=np.int64)
    unpaid = np.array(free, dtype=np.int64)  # tokens still to come without loss
    sequences: list[list[Piece]] = []
    while (open_ := np.flatnonzero(left > 0)).size:
        tokens, segments, loss = max_tokens, max_segments, max_loss
        sequence: list[Piece] = []
        while tokens and segments and open_.size:
            rest = left[open_]
            bears = np.maximum(rest - unpaid[open_], 0)
            fits = (rest <= tokens) & (bears <= loss)
            if fits.any():
                value = (rest * (tokens / max_tokens ** 2) + segments / max_segments ** 2
                         + bears * (loss / max(max_loss, 1) ** 2))
                at = int(np.where(fits, value, -1.0).argmax())
                n = int(rest[at])
            else:
                room = np.minimum(np.minimum(tokens, rest), unpaid[open_] + loss)
                if room.max() <= 0:
                    if not sequence:
                        raise ValueError("the limits admit no token")
                    break
                best = room == room.max()
                at = int(np.where(best, rest, -1).argmax())
                n = int(room[at])
            i = open_[at]
            sequence.append((int(i), int(start[i]), n))
            tokens, segments = tokens - n, segments - 1
            loss -= max(0, n - int(unpaid[i]))
            start[i] += n
            left[i] -= n
            unpaid[i] = max(0, unpaid[i] - n)
            # One piece of an example per sequence: what is left of it waits.
            open_ = np.delete(open_, at)
        sequences.extend([sequence] if tokens == 0 else powers(sequence))
    return sequences


def powers(sequence: list[Piece]) -> list[list[Piece]]:
    """A short sequence cut into sequences with powers of two as lengths."""
    total = sum(n for _, _, n in sequence)
    out: list[list[Piece]] = []
    pieces = list(sequence)
    for bit in range(total.bit_length() - 1, -1, -1):
        need = total & (1 << bit)
        if not need:
            continue
        part: list[Piece] = []
        while need:
            i, s, n = pieces.pop(0)
            take = min(n, need)
            part.append((i, s, take))
            if take < n:
                pieces.insert(0, (i, s + take, n - take))
            need -= take
        out.append(part)
    return out


def tokenized(spark: SparkSession, docs: DataFrame, definition: str,
              end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, free): ids as binary, little-endian, with the end token.
    A document's first token has nothing before it to be predicted from."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(definition)

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        enc = encoder(shared.value)
        end = np.array([end_id], dtype=enc.kind).tobytes()
        return pd.Series([x + end for x in enc.encode([t or "" for t in texts])], dtype=object)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), ids("text").alias("ids"),
                       F.lit(1).cast("long").alias("free"))


PIECES = ("doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long")


def group_of(groups: int) -> Column:
    """Group of a row, by a hash of its place: neither equal ids nor equal texts
    meet. The place itself would not do, as it starts anew in each partition, at
    multiples of 2^33, which may all leave one remainder."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups).cast("long"))


def pack_examples(spark: SparkSession, examples: DataFrame, id_bytes: int, n: int,
                  max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                  max_loss: int = MAX_LOSS) -> DataFrame:
    """Pieces of ``n`` examples (doc_id, ids, free), whose ids take ``id_bytes``
    bytes each: one row per piece, with its sequence and offset there."""
    prepare(spark)
    groups = max(1, math.ceil(n / GROUP))
    kind = f"<u{id_bytes}"
    dealt = examples.select(F.col("doc_id").cast("string").alias("doc_id"), "ids", "free",
                            group_of(groups).alias("group"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids = [np.frombuffer(x, dtype=kind).astype("<u4") for x in frame.ids]
        free = frame.free.to_numpy()
        doc_id = frame.doc_id.to_list()
        rows = []
        sequences = pack([len(x) for x in ids], free, max_tokens, max_segments, max_loss)
        for number, sequence in enumerate(sequences):
            offset = 0
            for i, start, length in sequence:
                crc = zlib.crc32(ids[i][start:start + length].tobytes())
                bears = max(0, start + length - max(start, int(free[i])))
                rows.append((doc_id[i], start, length, crc, len(ids[i]),
                             (int(key[0]) << 32) + number, offset, bears))
                offset += length
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])

    return dealt.groupBy("group").applyInPandas(run, PIECES).withColumn(
        "doc_id", F.col("doc_id").cast("long"))


TURNS = 64          # turns of a conversation in one example, at most
CHAT_SEGMENTS = 4   # limits of a sequence of conversations
CHAT_LOSS = 768


def conversation_examples(spark: SparkSession, conversations: DataFrame, definition: str,
                          end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, free) of conversations (doc_id is their id): the turns in order, as role
    and text, and the end token. What comes before the last answer bears no loss. A
    conversation of more than ``TURNS`` turns gives several examples, one after the other;
    one without an answer bears none at all."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(definition)
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranges = [*order[:2], F.substring("role", 1, 32), F.substring("text", 1, 32)]
    placed = stage(spark, row_numbers(spark, turns, order, "chat-turns", ranges=ranges), "chat-rows")
    known = stage(spark, placed.groupBy("conv_id").agg(
        F.min("row").alias("first"), F.max("row").alias("last"),
        F.max(F.when(F.col("role") == "assistant", F.col("row"))).alias("answer")), "chat-ends")
    both = placed.alias("t").join(known.alias("k"), F.col("t.conv_id").eqNullSafe(F.col("k.conv_id")))
    said = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    part = F.floor((F.col("row") - F.col("first")) / TURNS)
    parts = both.select("t.conv_id", part.alias("part"), (F.col("row") == F.col("last")).alias("ends"),
                        F.struct("row", said.alias("said"), F.coalesce(
                            F.col("row") < F.col("answer"), F.lit(True)).alias("prompt")).alias("turn"))
    # At most TURNS turns a group.
    parts = parts.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("turn")).alias("turns"),
                                                 F.max("ends").alias("ends"))

    def text(prompt: bool) -> Column:
        return F.array_join(F.transform(F.filter("turns", lambda t: t["prompt"] == prompt),
                                        lambda t: t["said"]), "")

    @F.pandas_udf("ids binary, free long")
    def ids(prompts: pd.Series, answers: pd.Series, ends: pd.Series) -> pd.DataFrame:
        enc = encoder(shared.value)
        end = np.array([end_id], dtype=enc.kind).tobytes()
        rows = []
        for before, after, last in zip(enc.encode(list(prompts)), enc.encode(list(answers)), ends):
            whole = before + after + (end if last else b"")
            # The end token is part of an answer, if there is one.
            free = len(before) if after or not last else len(whole)
            rows.append((whole, free // enc.kind.itemsize))
        return pd.DataFrame(rows, columns=["ids", "free"])

    return parts.select(F.col("conv_id").alias("doc_id"), ids(text(True), text(False), "ends")
                        .alias("e")).select("doc_id", "e.ids", "e.free")


def pack_conversations(spark: SparkSession, conversations: DataFrame, tokenizer_path: str,
                       max_segments: int = CHAT_SEGMENTS, max_loss: int = CHAT_LOSS) -> DataFrame:
    """Pieces of all conversations under limits of tokens, segments and loss-bearing tokens,
    each of which closes sequences."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    examples = stage(spark, conversation_examples(spark, conversations, definition), "chat-examples")
    return pack_examples(spark, examples, encoder(definition).kind.itemsize, examples.count(),
                         max_segments=max_segments, max_loss=max_loss
                         ).withColumnRenamed("doc_id", "conv_id")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str,
                   **limits) -> DataFrame:
    """Pieces of all documents under a tokenizer's ids."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    return pack_examples(spark, tokenized(spark, docs, definition),
                         encoder(definition).kind.itemsize, docs.count(), **limits)
