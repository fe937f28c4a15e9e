"""Runs of words that stand in several documents, wherever in a line: winnowed fingerprints name candidates, whole windows decide."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes
from lossloom.session import materialise, trimmed

RUN = 50  # words of a window
GRAM = 25  # words of a fingerprint; RUN - GRAM + 1 of them lie in a window, and the least one stands for it
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_hashes(text: bytes) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, text.lower().split()), "<u8")


def rolled(hashes: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """64-bit hash of every window of `width` words: equal windows have equal hashes wherever they stand."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    count = len(hashes)
    up = np.cumprod(np.full(count, base, np.uint64), dtype=np.uint64)
    down = np.cumprod(np.full(count, inverse, np.uint64), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down, dtype=np.uint64)])
    found = (sums[width:] - sums[:-width]) * up[:count - width + 1]
    found ^= found >> np.uint64(32)
    return found * BASES[1]


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    held, size = values, 1
    while 2 * size <= width:
        held = np.minimum(held[:-size], held[size:])
        size *= 2
    rest = width - size
    return np.minimum(held[:len(held) - rest], held[rest:]) if rest else held


def fingerprints(text: bytes) -> np.ndarray:
    """Different fingerprints of a text: every window of RUN words holds one, which depends on its words alone."""
    grams = rolled(word_hashes(text), GRAM, BASES[0])
    if len(grams) < RUN - GRAM + 1:
        return np.zeros(0, np.uint64)
    return np.unique(least_of(grams, RUN - GRAM + 1))


def windows_at(text: bytes, prints: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hash, second hash) of the windows that hold one of `prints`."""
    hashes = word_hashes(text)
    hits = np.flatnonzero(np.isin(rolled(hashes, GRAM, BASES[0]), np.array(prints, np.int64).view(np.uint64)))
    first = rolled(hashes, RUN, BASES[0])
    steps = np.zeros(len(first) + 1, np.int64)
    np.add.at(steps, np.maximum(hits - (RUN - GRAM), 0), 1)
    np.add.at(steps, np.minimum(hits + 1, len(first)), -1)
    places = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
    return places, first[places], rolled(hashes, RUN, BASES[1])[places]


def runs_of(places: list[int]) -> list[tuple[int, int]]:
    """(first word, word after the last) of the runs that windows beginning at `places` cover."""
    runs: list[list[int]] = []
    for at in sorted(places):
        if runs and at <= runs[-1][1]:
            runs[-1][1] = at + RUN
        else:
            runs.append([at, at + RUN])
    return [(a, b) for a, b in runs]


def without_runs(text: str, places: list[int]) -> str:
    """The text without the words that the windows at `places` cover; the rest of a line stays on it."""
    raw = text.encode()
    spans = [m.span() for m in WORD.finditer(raw)]
    out, at = [], 0
    for begin, end in runs_of(places):
        out.append(raw[at:spans[begin][0]])
        at = spans[end - 1][1]
        if end < len(spans) and b"\n" not in raw[at:spans[end][0]]:
            at = spans[end][0]
    out.append(raw[at:])
    return b"".join(out).decode()


@trimmed
def shared_windows(docs: DataFrame) -> DataFrame:
    """(row, places, gone) of the rows of `docs(row, doc_id, text_hash, text)` with windows of RUN words that another document has too.

    Documents are told apart by id and hash. `places` are the first words of the windows, `gone` those whose first copy, by (doc_id, hash,
    place), stands elsewhere. Two windows are equal if two hashes of 64 bits are.
    """

    def make_prints():
        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            found = [fingerprints(t) for t in batch["text"]]
            return {"row": np.repeat(np.array(batch["row"], np.int64), [len(f) for f in found]),
                    "print": np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)}

        return step

    texts = docs.select("row", as_bytes(F.col("text")).alias("text"))
    prints = materialise(arrow_pass(texts, "row long, print long", make_prints))
    common = materialise(prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("print"))
    wanted = materialise(prints.join(common, "print").groupBy("row").agg(F.collect_list("print").alias("prints")))

    def make_windows():
        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out: dict[str, list] = {"row": [], "place": [], "a": [], "b": []}
            for row, text, found in zip(batch["row"], batch["text"], batch["prints"]):
                places, a, b = windows_at(text, found)
                out["row"].append(np.full(len(places), row, np.int64))
                out["place"].append(places.astype(np.int32))
                out["a"].append(a.view(np.int64))
                out["b"].append(b.view(np.int64))
            return {k: np.concatenate(v) for k, v in out.items()}

        return step

    met = texts.join(wanted.hint("shuffle_hash"), "row").select("row", "text", "prints")
    windows = arrow_pass(met, "row long, place int, a long, b long", make_windows)
    named = materialise(windows.join(docs.join(wanted.select("row"), "row", "left_semi").select("row", "doc_id", "text_hash"), "row"))
    owner, place = F.struct("doc_id", "text_hash"), F.struct("doc_id", "text_hash", "place")
    shared = materialise(named.groupBy("a", "b").agg(F.min(place).alias("first"), F.min(owner).alias("low"), F.max(owner).alias("high"))
                         .filter(~F.col("low").eqNullSafe(F.col("high"))).select("a", "b", "first"))
    # The order of the first copy is that of places, so a window whose own place is the first stays.
    return materialise(named.join(shared, ["a", "b"]).groupBy("row").agg(
        F.collect_list("place").alias("places"), F.collect_list(F.when(~place.eqNullSafe(F.col("first")), F.col("place"))).alias("gone")))


def drop_passages(docs: DataFrame, row: str, doc_id: str, text_hash: str, found: str) -> DataFrame:
    """Columns of a written `docs`, whose text loses the passages that stand in an earlier document, and `found`.

    `row`, `doc_id` and `text_hash` name the columns of a row's number, its id and its text's hash; `found` is a struct of n_passages, the runs
    of RUN words or more that another document has too (kept ones included), and words_removed.
    """
    keys = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text_hash).alias("text_hash"), "text")
    shared = shared_windows(keys).withColumnsRenamed({"row": f"{row}__", "places": f"{row}_places", "gone": f"{row}_gone"})

    @F.pandas_udf("struct<text string, n_passages long, words_removed long>")
    def cut(texts, places, gone):
        import pandas as pd

        rows = [(without_runs(t, list(g)), len(runs_of(list(p))), sum(b - a for a, b in runs_of(list(g)))) for t, p, g in zip(texts, places, gone)]
        return pd.DataFrame(rows, columns=["text", "n_passages", "words_removed"])

    joined = docs.join(shared.hint("shuffle_hash"), F.col(row) == F.col(f"{row}__"), "left")
    inside = F.col(f"{row}__").isNotNull()
    other = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    hit = joined.filter(inside).withColumn(found, cut("text", f"{row}_places", f"{row}_gone")).select(
        *other, F.col(f"{found}.text").alias("text"), F.struct(f"{found}.n_passages", f"{found}.words_removed").alias(found))
    none = F.struct(F.lit(0).cast("long").alias("n_passages"), F.lit(0).cast("long").alias("words_removed"))
    return hit.unionByName(joined.filter(~inside).select(*other, "text", none.alias(found)))
