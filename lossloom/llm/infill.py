"""Fill-in-middle over seekable compressed texts: independent zstandard frames with cumulative unit counts, cut and put together again."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes
from lossloom.session import materialise

FRAME_BYTES = 1 << 16
LEVEL = 1
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
STORE = "data binary, ends array<long>, units array<long>"


def count_units(text: bytes) -> int:
    """Code points: bytes that do not continue one."""
    if text.isascii():
        return len(text)
    return int(np.count_nonzero(np.frombuffer(text, np.int8) >= -64))


def byte_of(text: bytes, unit: int) -> int:
    """Place of the byte where code point number `unit` begins (the length at the end)."""
    if text.isascii():
        return unit
    starts = np.flatnonzero(np.frombuffer(text, np.int8) >= -64)
    return int(starts[unit]) if unit < len(starts) else len(text)


class Writer:
    """Collects a text as frames: ready ones are taken as they are, loose bytes are compressed a frame at a time."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        if frame_bytes < 4:
            raise ValueError("a frame holds whole code points: 4 bytes at least")
        self.frame_bytes = frame_bytes
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.clear()

    def clear(self) -> None:
        self.frames: list[bytes] = []
        self.ends: list[int] = []
        self.units: list[int] = []
        self.loose = bytearray()

    def frame(self, data: bytes, units: int) -> None:
        self.flush()
        self.append(data, units)

    def append(self, data: bytes, units: int) -> None:
        self.frames.append(data)
        self.ends.append((self.ends[-1] if self.ends else 0) + len(data))
        self.units.append((self.units[-1] if self.units else 0) + units)

    def text(self, piece: bytes) -> None:
        """Whole code points."""
        for start in range(0, len(piece), self.frame_bytes):
            self.loose += piece[start:start + self.frame_bytes]
            while len(self.loose) > self.frame_bytes:
                self.cut(self.frame_bytes)

    def cut(self, at: int) -> None:
        while 0 < at < len(self.loose) and self.loose[at] & 0xC0 == 0x80:
            at -= 1
        head = bytes(self.loose[:at or len(self.loose)])
        del self.loose[:len(head)]
        self.append(self.pack(head), count_units(head))

    def flush(self) -> None:
        if self.loose:
            self.cut(len(self.loose))

    def take(self) -> tuple[bytes, list[int], list[int]]:
        self.flush()
        out = b"".join(self.frames), self.ends, self.units
        self.clear()
        return out


class Reader:
    """A stored text: any range of code points is read from the frames that hold it."""

    def __init__(self, data: bytes, ends: list[int], units: list[int]):
        self.data, self.ends, self.units = data, ends, units
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.held: dict[int, bytes] = {}

    def __len__(self) -> int:
        return self.units[-1] if self.units else 0

    def packed(self, k: int) -> bytes:
        return self.data[self.ends[k - 1] if k else 0:self.ends[k]]

    def frame(self, k: int) -> bytes:
        return self.held[k] if k in self.held else self.unpack(self.packed(k))

    def stream(self) -> Iterator[bytes]:
        return map(self.frame, range(len(self.ends)))

    def copy(self, low: int, high: int, to: Writer) -> None:
        """Code points low to high: frames inside go over compressed, only those that are cut are opened (and kept for the next cut)."""
        k = bisect_right(self.units, low)
        while low < high:
            first, last = self.units[k - 1] if k else 0, self.units[k]
            if low == first and last <= high:
                to.frame(self.packed(k), last - first)
            else:
                text = self.held.setdefault(k, self.frame(k))
                to.text(text[byte_of(text, low - first):byte_of(text, min(high, last) - first)])
            low, k = last, k + 1


def plan(doc_id: int | None, n: int, marked: bool) -> tuple[str, int, int]:
    """(form, end of the prefix, end of the middle), drawn from the id alone."""
    drawn = sha256(b"1:" + (b"" if doc_id is None else b"%d" % doc_id)).hexdigest()
    h1, h2, h3, h4 = (int(drawn[8 * k:8 * k + 8], 16) for k in range(4))
    if n == 0 or marked or h3 % 100 >= PLAIN_FROM:
        return "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < SPM_BELOW else "psm"), low, high


def rearrange(text: Reader, form: str, low: int, high: int, to: Writer) -> None:
    n = len(text)
    parts = {"plain": [(b"", 0, n)], "psm": [(PREFIX, 0, low), (SUFFIX, high, n), (MIDDLE, low, high)],
             "spm": [(SUFFIX, high, n), (PREFIX, 0, low), (MIDDLE, low, high)]}
    for mark, a, b in parts[form]:
        to.text(mark)
        text.copy(a, b, to)


def find_marks(text: Reader, marks: tuple[bytes, ...]) -> list[int]:
    """Code points before the first occurrence of each mark, in this order, in one pass over the frames."""
    found, before, rest = [], 0, b""
    for frame in text.stream():
        buffer, at = rest + frame, 0
        while len(found) < len(marks):
            k = buffer.find(marks[len(found)], at)
            if k < 0:
                break
            found.append(before + count_units(buffer[:k]))
            at = k + len(marks[len(found) - 1])
        keep = max(at, len(buffer) - 2)
        before, rest = before + count_units(buffer[:keep]), buffer[keep:]
    return found


def put_back(made: Reader, form: str, to: Writer) -> None:
    """The text from its rearranged form. A text with a mark in it is plain, so each mark is met where it was set."""
    n = len(made)
    if form == "plain":
        return made.copy(0, n, to)
    first, second, third = find_marks(made, (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE))
    spans = [(first + 3, second), (second + 3, third)]
    prefix, suffix = spans if form == "psm" else spans[::-1]
    for a, b in (prefix, (third + 3, n), suffix):
        made.copy(a, b, to)


def store_texts(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, n, marked, data, ends, units) for every row of `docs(doc_id, text)`.

    `data` is a row of independent zstandard frames of at most `frame_bytes` bytes of text, each of whole code points; `ends` and
    `units` count the compressed bytes and the code points up to the end of each, so a frame is found by bisection and opened
    alone. `marked` says that one of the three marks stands in the text. Null and empty texts have no frame.
    """

    def make():
        writer = Writer(frame_bytes)

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out: dict[str, list] = {c: [] for c in ("doc_id", "n", "marked", "data", "ends", "units")}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                writer.text(text)
                data, ends, units = writer.take()
                row = (doc_id, units[-1] if units else 0, any(m in text for m in (PREFIX, SUFFIX, MIDDLE)), data, ends, units)
                for column, value in zip(out.values(), row):
                    column.append(value)
            return out

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes(F.col("text")).alias("text"))
    return arrow_pass(rows, f"doc_id long, n long, marked boolean, {STORE}", make)


def rearranged(store: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, data, ends, units): the output of every stored text, as frames again."""

    def make():
        writer = Writer(frame_bytes)

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out: dict[str, list] = {c: [] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "data", "ends", "units")}
            for doc_id, n, marked, *stored in zip(*(batch[c] for c in ("doc_id", "n", "marked", "data", "ends", "units"))):
                form, low, high = plan(doc_id, n, marked)
                rearrange(Reader(*stored), form, low, high, writer)
                cut = (None, None) if form == "plain" else (low, high - low)
                for column, value in zip(out.values(), (doc_id, n, form, *cut, *writer.take())):
                    column.append(value)
            return out

        return step

    return arrow_pass(store, f"doc_id long, n long, form string, prefix_chars long, middle_chars long, {STORE}", make)


def restored(made: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, data, ends, units): the texts, rebuilt from `made(doc_id, form, data, ends, units)` alone."""

    def make():
        writer = Writer(frame_bytes)

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out: dict[str, list] = {c: [] for c in ("doc_id", "data", "ends", "units")}
            for doc_id, form, *stored in zip(*(batch[c] for c in ("doc_id", "form", "data", "ends", "units"))):
                put_back(Reader(*stored), form, writer)
                for column, value in zip(out.values(), (doc_id, *writer.take())):
                    column.append(value)
            return out

        return step

    return arrow_pass(made.select("doc_id", "form", "data", "ends", "units"), f"doc_id long, {STORE}", make)


def digest(text: Reader) -> str:
    total = sha256()
    for frame in text.stream():
        total.update(frame)
    return total.hexdigest()


def digests(made: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The columns of rearranged() with the digests of the output and of the text rebuilt from it in place of the frames."""
    fields = ("doc_id", "n", "form", "prefix_chars", "middle_chars")

    def make():
        writer = Writer(frame_bytes)

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out = {c: batch[c] for c in fields} | {"output_sha256": [], "restored_sha256": []}
            for form, *stored in zip(*(batch[c] for c in ("form", "data", "ends", "units"))):
                text = Reader(*stored)
                put_back(text, form, writer)
                out["output_sha256"].append(digest(text))
                out["restored_sha256"].append(digest(Reader(*writer.take())))
            return out

        return step

    return arrow_pass(made, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string", make)


def fill_in_middle(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """One row for each row of `docs(doc_id, text)`: its cut, form, and the digests of the output and of the text rebuilt from it.

    A null text is empty; empty texts are plain. A null id draws from the empty decimal. The draw depends on the id alone, so repeated rows
    and rows of one id are cut alike (at their own lengths). A very long text is held compressed and opened a frame at a time. Other columns are
    not read. An empty table gives no row. The store is written first, so a lost task reads frames again, not the source.
    """
    return digests(rearranged(materialise(store_texts(docs, frame_bytes)), frame_bytes), frame_bytes)
