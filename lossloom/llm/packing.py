"""Mixture-controlled packing: deficit round-robin over source queues fills fixed windows with token slices."""

from __future__ import annotations

import functools
import math
import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes
from lossloom.session import scratch_path

END = 1
CACHE = 500_000
# What the tokenizer's own pattern cuts a word into, for words of ASCII and of the small letters from U+00DF to U+00FF. The bar is
# left out: only the two special tokens hold it, and words with it go to the tokenizer whole, as do words with any other character.
LETTER_RUN = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+"
PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|" + LETTER_RUN + rb"|[0-9]|[!-/:-@\[-`{}~]+")
SPECIAL = b"<|"
# A run of these, at the end of a word of letters, is one piece.
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"


def byte_letters() -> dict[int, int]:
    """The code point that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others from 256 on."""
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: 256 + k for k, b in enumerate(others)}


# The bytes of PIECES that do not stand for themselves.
MOVED = [(chr(b), chr(c)) for b, c in byte_letters().items() if 0x9f <= b <= 0xbf]


@functools.cache
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds(dict):
    """Token ids (16-bit numbers) of lower-case words; a word that is not there yet is encoded from its pieces, and so are they once.

    Once CACHE words are held they become the older half, from which words come back when they are met again, so that
    frequent words stay and at most 2 * CACHE are kept.
    """

    def __init__(self, model):
        super().__init__()
        self.model, self.merge = model, model.model.tokenize
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.merged(word.decode()) if word.isalpha() else self.from_pieces(word)
        self[word] = ids
        return ids

    def from_pieces(self, word: bytes) -> bytes:
        core = word.rstrip(MARKS)
        if core.isalpha():
            return self[core] + self[word[len(core):]]
        pieces = PIECES.findall(word)
        if len(pieces) == 1 and len(pieces[0]) == len(word):
            letters = word.decode("latin-1")
            for byte, letter in MOVED:
                letters = letters.replace(byte, letter)
            return self.merged(letters)
        if sum(map(len, pieces)) < len(word):
            return self.whole(word)
        return b"".join(map(self.__getitem__, pieces))

    def merged(self, piece: str) -> bytes:
        return array("H", [t.id for t in self.merge(piece)]).tobytes()

    def whole(self, text: bytes) -> bytes:
        return array("H", self.model.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids).tobytes()

    def age(self) -> None:
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Token ids of whole texts as 16-bit numbers, from the ids of their words.

    The tokenizer never joins characters across the six white-space bytes, so a text's ids are the ids of its
    words one after the other, in either case of letters; each distinct word is encoded once while it is cached.
    Special tokens are the exception, they are known in lower case alone: a word that may hold one keeps its case.
    """

    def __init__(self, path: str):
        self.model = tokenizer(path)
        if self.model.get_vocab_size() > 1 << 16:
            raise ValueError("a vocabulary of more than 65,536 ids does not fit two bytes")
        self.words = WordIds(self.model)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return [self.ids(t) for t in texts]

    def ids(self, text: bytes) -> bytes:
        self.words.age()
        if SPECIAL in text:
            return b"".join([self.words.whole(w) if SPECIAL in w else self.words[w.lower()] for w in text.split()])
        return b"".join(map(self.words.__getitem__, text.lower().split()))


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a Python worker: words that one task has met are known to the next tasks of the worker."""
    return WordEncoder(path)


def encode_documents(docs: DataFrame, vocabulary: str, keep_words: bool = True) -> DataFrame:
    """(doc_id, source, ids binary of 16-bit numbers, n) with the end id appended."""

    def make():
        encoder = word_encoder(vocabulary) if keep_words else WordEncoder(vocabulary)
        end = np.array([END], "<u2").tobytes()

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            ids = [e + end for e in encoder.encode(batch["text"])]
            return {"doc_id": batch["doc_id"], "source": batch["source"], "ids": ids, "n": [len(i) // 2 for i in ids]}

        return step

    return arrow_pass(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                  as_bytes(F.col("text")).alias("text")), "doc_id long, source string, ids binary, n long", make)


class Packer:
    """Packs one part: every window's room is credited to the sources by their shares and spent where credit has gathered."""

    def __init__(self, part: int, window: int, quantum: int, shares: dict, deficits: dict):
        self.part, self.window, self.quantum = part, window, quantum
        self.shares, self.deficit = shares, deficits
        self.queues: dict[str | None, deque] = {}
        self.left: dict[str | None, int] = {}
        self.rows: list[list] = [[] for _ in range(8)]
        self.count = 0

    def add(self, source: str | None, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 2
        self.queues.setdefault(source, deque()).append([doc_id, np.frombuffer(ids, "<u2").astype("<u4").tobytes(), n, 0])
        self.left[source] = self.left.get(source, 0) + n

    def serve(self, source: str | None, room: int, offset: int) -> int:
        """Move `room` tokens of a source into the window; returns the next offset."""
        queue, sequence = self.queues[source], (self.part << 32) | self.count
        self.left[source] -= room
        while room:
            doc = queue[0]
            doc_id, ids, n, start = doc
            length = min(room, n - start)
            piece = (doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n, sequence, offset, source)
            for column, value in zip(self.rows, piece):
                column.append(value)
            doc[3] += length
            offset += length
            room -= length
            if doc[3] == n:
                queue.popleft()
        return offset

    def pack(self) -> None:
        """Fill windows until every queue is empty; only the last one is short."""
        active = sorted(self.queues, key=lambda s: (s is None, s or ""))
        for s in active:
            self.deficit.setdefault(s, 0.0)
        while active:
            total = sum(self.left[s] for s in active)
            room = min(self.window, total)
            share = sum(self.shares.get(s, 0.0) for s in active) or 1.0
            take = dict.fromkeys(active, 0)
            quota = {s: room * self.shares.get(s, 0.0) / share for s in active}
            for s in active:
                self.deficit[s] += quota[s]
            by_credit = sorted(active, key=lambda s: -self.deficit[s])
            # First everyone's own share of this window, then what credit is left over, then whoever still has tokens.
            for most in (lambda s: min(int(self.deficit[s]), max(math.ceil(quota[s]), self.quantum)), lambda s: int(self.deficit[s]) - take[s], lambda s: room):
                for s in by_credit:
                    n = min(most(s), self.left[s] - take[s], room)
                    if n > 0 and (take[s] or n >= min(self.quantum, self.left[s], room)):
                        take[s] += n
                        room -= n
            offset = 0
            for s in active:
                if take[s] > 0:
                    self.deficit[s] -= take[s]
                    offset = self.serve(s, take[s], offset)
            self.count += 1
            active = [s for s in active if self.left[s]]


def pack(docs: DataFrame, vocabulary: str | None = None, shares: dict[str | None, float] | None = None, window: int = 2048,
         quantum: int = 16, part_tokens: int = 4_000_000, keep_words: bool = True) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source) of every row of `docs(doc_id, text, source)`.

    Documents are dealt by a hash to parts of about `part_tokens` tokens, so that every part holds the mix of the
    corpus; parts are packed independently and each ends with at most one short window. `shares` are the target
    proportions of the sources (default: their shares of all tokens). The deficit that the parts before leave to a
    source, tokens it should have had less tokens it had, is its credit when the part begins; within a part it is
    carried from window to window. A source that runs out leaves its room to the others, so every token is packed once.
    With `keep_words` a Python worker keeps the words it met after its task, and their memory.
    A null or empty text is its end id alone, a null source is a source, rows with one id are documents of their own.
    """
    spark = docs.sparkSession
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = scratch_path(spark, "ids")
    encoded = encode_documents(docs, vocabulary, keep_words)
    encoded.write.option("compression", "zstd").parquet(path)
    ids = spark.read.schema(encoded.schema).parquet(path)
    total = ids.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // part_tokens))
    ids = ids.withColumn("draw", F.xxhash64("doc_id", F.crc32("ids"), "source"))
    ids = ids.withColumn("part", F.pmod("draw", F.lit(parts)).cast("long"))
    held = ids.groupBy("part", "source").agg(F.sum("n").alias("n"))
    per_source = held.groupBy(F.col("source").alias("name")).agg(F.sum("n").alias("all"))
    if shares is None:
        target = per_source.select("name", (F.col("all") / F.lit(max(1, total))).alias("share"))
    else:
        weight = sum(shares.values()) or 1.0
        target = spark.createDataFrame([(k, float(v) / weight) for k, v in shares.items()], "name string, share double")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Parts are dealt by a hash, so the parts before number k hold k / parts of all tokens.
    carried = held.join(target, F.col("source").eqNullSafe(F.col("name")), "left").select(
        "part", "source", F.coalesce("share", F.lit(0.0)).alias("share"),
        (F.coalesce("share", F.lit(0.0)) * F.col("part") * F.lit(total / parts) - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("deficit"))
    rows = carried.select("part", F.lit(0).alias("kind"), "source", "share", "deficit", F.lit(None).cast("long").alias("doc_id"),
                          F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("long").alias("draw")).unionByName(
        ids.select("part", F.lit(1).alias("kind"), "source", F.lit(None).cast("double").alias("share"),
                   F.lit(None).cast("double").alias("deficit"), "doc_id", "ids", "draw"))
    dealt = rows.repartition(int(min(parts, 20_000)), "part").sortWithinPartitions("part", "kind", "draw", "doc_id")
    columns = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
               ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("source", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None

        def flush() -> Iterator[pa.RecordBatch]:
            if packer is not None:
                packer.pack()
                for s in range(0, len(packer.rows[0]), 50_000):
                    yield pa.RecordBatch.from_pydict({name: pa.array(c[s:s + 50_000], kind) for c, (name, kind) in zip(packer.rows, columns)})

        for batch in batches:
            for part, kind, source, share, deficit, doc_id, ids in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if packer is None or packer.part != part:
                    yield from flush()
                    packer = Packer(part, window, quantum, {}, {})
                if kind == 0:
                    packer.shares[source] = share
                    # More than some windows of credit would fill windows with one source.
                    packer.deficit[source] = min(max(deficit, -float(window)), float(window)) * share
                else:
                    packer.add(source, doc_id, ids)
        yield from flush()

    return dealt.drop("draw").mapInArrow(run, ", ".join(f"`{n}` {'string' if n == 'source' else 'long'}" for n, _ in columns))
