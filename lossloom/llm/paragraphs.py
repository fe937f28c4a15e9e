"""Substring dedup by paragraph: MinHash banding, exact Jaccard of colliding paragraphs, removals by components."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes, by_cell, cells, components, tree_edges, unused
from lossloom.llm.passages import drop_passages
from lossloom.session import materialise, trimmed

SHINGLE = 5
MIN_WORDS = 20
# Short lines are joined to at most so many times the least number of words.
LONGEST = 8
# 1 - (1 - 0.8^3)^10 = 0.9992 of the pairs with Jaccard 0.8 collide in a band, and more of the closer ones.
BANDS, BAND_ROWS = 10, 3
PIECE = 1 << 14


def hash_constants(count: int) -> np.ndarray:
    """Odd 64-bit multipliers from a fixed generator."""
    return np.random.default_rng(9).integers(1, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)


MULTIPLIERS = hash_constants(BANDS * BAND_ROWS)


def shingles(found: list[bytes]) -> list[bytes]:
    if len(found) <= SHINGLE:
        return [b" ".join(found)]
    return list(map(b" ".join, zip(*(found[k:] for k in range(SHINGLE)))))


def bands(found: list[bytes]) -> list[int]:
    """Band keys of a paragraph: BAND_ROWS minima of multiplied shingle hashes each."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles(found)), "<u8")
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(hashes), PIECE):
        mixed = hashes[s:s + PIECE] ^ (hashes[s:s + PIECE] >> np.uint64(29))
        np.minimum(least, (mixed[:, None] * MULTIPLIERS[None, :]).min(0), out=least)
    keys = least.reshape(BANDS, BAND_ROWS)
    return [xxhash.xxh64_intdigest(keys[b].tobytes(), b) - (1 << 63) for b in range(BANDS)]


def paragraphs_of(text: bytes, min_words: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first line, lines, words) of the paragraphs of a text.

    A line of `min_words` words or more is one. Shorter lines that follow each other (lines without a word between them do not part
    them) are joined until they have `min_words` words and the hash of their last line is even, or LONGEST times as many words: borders
    depend on the lines around them, so a passage in short lines is cut alike wherever it stands. What is left at the end of such a run
    belongs to the paragraph before it; a run with fewer words in all is no paragraph.
    """
    run: list[tuple[int, int, list[bytes]]] = []
    start, held, end = -1, [], -1

    def rest() -> list[tuple[int, int, list[bytes]]]:
        if len(held) >= max(1, min_words):
            run.append((start, end - start, held))
        elif held and run:
            first, _, words = run.pop()
            run.append((first, end - first, words + held))
        return run

    for place, line in enumerate(text.lower().split(b"\n")):
        found = line.split()
        if len(found) >= min_words:
            yield from rest()
            yield place, 1, found
            run, held = [], []
        elif found:
            if not held:
                start = place
            held, end = held + found, place + 1
            if len(held) >= min_words and (len(held) >= LONGEST * min_words or xxhash.xxh64_intdigest(b" ".join(found)) % 2 == 0):
                if run:
                    yield run.pop()
                run, held = [(start, end - start, held)], []
    yield from rest()


def paragraph_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_hash, place, span, digest, n_words, bands) of every paragraph: it begins at line `place` and has `span` lines."""

    def make():
        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            rows: list[list] = [[] for _ in range(7)]
            for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
                seen: dict[bytes, list[int]] = {}
                for place, span, found in paragraphs_of(text, min_words):
                    digest = blake2b(b" ".join(found), digest_size=16).digest()
                    if digest not in seen:
                        seen[digest] = bands(found)
                    for column, value in zip(rows, (doc_id, text_hash, place, span, digest, len(found), seen[digest])):
                        column.append(value)
            return dict(zip(("doc_id", "text_hash", "place", "span", "digest", "n_words", "bands"), rows))

        return step

    return arrow_pass(docs.select("doc_id", "text_hash", as_bytes(F.col("text")).alias("text")),
                      "doc_id long, text_hash long, place int, span int, digest binary, n_words int, bands array<long>", make)


def jaccard_edges(rows: list[tuple[bytes, list[bytes]]], threshold: float) -> Iterator[tuple[bytes, bytes]]:
    """Tree edges between the digests of one cell whose shingle sets reach `threshold`, by way of others or directly.

    A paragraph that already hangs together with another through a third is not compared with it again.
    """
    groups: list[list[int]] = []
    sets = [frozenset(shingles(found)) for _, found in rows]
    for i, own in enumerate(sets):
        joined, apart = [i], []
        for group in groups:
            near = False
            for j in group:
                other = sets[j]
                small, large = sorted((len(own), len(other)))
                if small >= threshold * large:
                    common = len(own & other)
                    if common >= threshold * (small + large - common):
                        near = True
                        break
            if near:
                joined = group + joined
            else:
                apart.append(group)
        groups = [*apart, joined]
    for group in groups:
        if len(group) > 1:
            yield from tree_edges(sorted(rows[i][0] for i in group))


def verified_edges(distinct: DataFrame, docs: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """Edges (a, b) between digests of paragraphs that share a band and pass the exact test."""
    spark = docs.sparkSession
    # Half the digest's bytes name a paragraph until its bands are met; two with one name are both looked at.
    short = F.xxhash64("digest").alias("short")
    keyed = materialise(distinct.select(short, F.explode("bands").alias("key")))
    dealt = materialise(cells(keyed, F.xxhash64("short", F.lit(3)), block_rows).select("cell", "key", "short"))
    wanted = distinct.select("digest", "rep", short).join(dealt.select("short").distinct(), "short", "left_semi").select("digest", "rep")
    places = materialise(wanted.groupBy(F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_hash").alias("text_hash")).agg(
        F.collect_list(F.struct(F.col("rep.place").alias("place"), F.col("rep.span").alias("span"), "digest")).alias("wanted")))
    # One copy of the document is enough: rows of one id and hash have the same text.
    texts = docs.join(places, docs["doc_id"].eqNullSafe(places["doc_id"]) & (docs["text_hash"] == places["text_hash"])).select(
        F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"), F.explode("wanted").alias("w")).select(
        F.col("w.digest").alias("digest"), 
        F.array_join(F.slice("lines", F.col("w.place") + 1, F.col("w.span")), " ").alias("line"))
    texts = materialise(texts.groupBy("digest").agg(F.min("line").alias("line")))
    rows = by_cell(dealt.join(texts.select("digest", "line", short), "short").select("cell", "key", "digest", F.col("line").cast("binary").alias("line")), spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, list[bytes]]] = []
        now, out = None, []
        for batch in batches:
            for cell, key, digest, line in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (cell, key) != now:
                    out += jaccard_edges(held, threshold)
                    held, now = [], (cell, key)
                held.append((digest, line.lower().split()))
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        out += jaccard_edges(held, threshold)
        yield batch_of(out)

    def batch_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in out], pa.binary()), "b": pa.array([e[1] for e in out], pa.binary())})

    return rows.mapInArrow(run, "a binary, b binary")


@trimmed
def linked_digests(distinct: DataFrame, docs: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """(node, component) of the digests that verified edges link; the tables of the comparison go with the call."""
    return components(verified_edges(distinct, docs, threshold, block_rows))


@trimmed
def similar_texts(docs: DataFrame, threshold: float = 0.8, block_rows: int = 256) -> DataFrame:
    """(doc_id, component binary) for every row of `docs(doc_id, text)`, whose ids must be unique and not null.

    Whole texts are compared as drop_repeated() compares lines: by their sets of five-word shingles in lower case (A to Z). Texts linked
    by Jaccard `threshold` or more have one component; null and empty texts and those without a word are equal.
    """
    # A line feed separates words like a blank, so a text is one line of the same words.
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("text_hash"), F.translate("text", "\n", " ").alias("text"))
    lines = materialise(paragraph_rows(keys, 0))
    distinct = materialise(lines.groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash", "place", "span")).alias("rep"), F.first("bands").alias("bands")))
    linked = linked_digests(distinct, keys, threshold, block_rows)
    return lines.select("doc_id", "digest").join(linked, F.col("digest") == linked["node"], "left").select(
        "doc_id", F.coalesce("component", "digest").alias("component"))


@trimmed
def removals(keys: DataFrame, threshold: float, min_words: int, block_rows: int) -> DataFrame:
    """(doc_id, text_hash, the counts of drop_repeated(), places: lines that go) of the documents with paragraphs; all other tables of the search go."""
    lines = materialise(paragraph_rows(keys, min_words))
    distinct = materialise(lines.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_hash", "place", "span")).alias("rep"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n")))
    linked = linked_digests(distinct.select("digest", "rep", "bands"), keys, threshold, block_rows)
    named = distinct.join(linked, distinct["digest"] == linked["node"], "left").select(
        "digest", "rep", "n", F.coalesce("component", "digest").alias("class"))
    named = materialise(named)
    classes = materialise(named.groupBy("class").agg(F.min("rep").alias("keeper"), F.sum("n").alias("n")).filter("n > 1"))
    members = materialise(named.join(classes.select("class", "keeper"), "class").select("digest", "keeper"))
    found = lines.drop("bands").join(members, "digest", "left").select(
        "doc_id", "text_hash", "place", "span", "n_words", "keeper",
        (~F.struct("doc_id", "text_hash", "place", "span").eqNullSafe(F.col("keeper")) & F.col("keeper").isNotNull()).alias("gone"))
    return materialise(found.groupBy("doc_id", "text_hash", "place").agg(
        F.first("n_words").alias("n_words"), F.first("span").alias("span"), F.first("keeper").alias("keeper"), F.first("gone").alias("gone")).groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("n_paragraphs"), F.count("keeper").alias("n_repeated"), F.count_if("gone").alias("n_removed"),
        F.coalesce(F.sum(F.when(F.col("gone"), F.col("n_words"))), F.lit(0)).cast("long").alias("words_removed"),
        F.array_sort(F.collect_set("keeper.doc_id")).alias("kept_in"),
        F.flatten(F.collect_list(F.when(F.col("gone"), F.sequence("place", F.col("place") + F.col("span") - 1)))).alias("places")))


@trimmed
def drop_repeated(docs: DataFrame, threshold: float = 0.8, min_words: int = MIN_WORDS, block_rows: int = 512) -> DataFrame:
    """Columns of `docs(doc_id, text, ...)` with the repeated paragraphs taken out of `text`, and what was found.

    Paragraphs are those of paragraphs_of(): lines of `min_words` words or more, and neighbouring shorter lines joined. They are compared
    in lower case (A to Z) by their sets of five-word shingles.
    Paragraphs linked by Jaccard `threshold` or more, within a document or across, form a class; the first of a class by
    (doc_id, place) stays and the others go. n_paragraphs counts the paragraphs looked at, n_repeated those in a class of
    two or more (kept ones included), n_removed and words_removed what went, kept_in lists the documents that hold the kept ones.
    Runs of short lines with fewer than `min_words` words in all (headings, greetings) and a null text stay as they are. Rows equal in id and text are one document and treated alike; null
    ids come first in the order. Existing columns of the seven new names are replaced, others keep their values whatever their names. has_repeated
    says plainly that n_repeated or n_passages is not 0. What is left is then searched for runs of 50 words or more that another document
    has too, wherever in a line: n_passages counts them, and they go from all documents but the first (see passages.py), their words
    counted in words_removed. A very long text is looked at as a whole, an empty table stays empty.
    """
    new = ("n_paragraphs", "n_repeated", "n_removed", "words_removed", "kept_in")
    kept = [c for c in docs.columns if c not in (*new, "has_repeated", "n_passages")]
    mark, own_id, own_hash, own_places, number, cut = (unused(docs, f"__{n}") for n in ("text_hash", "id", "hash", "places", "number", "cut"))
    docs = docs.select(*kept, F.xxhash64("text").alias(mark))
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(mark).alias("text_hash"), "text")
    per_doc = removals(keys, threshold, min_words, block_rows).withColumnsRenamed({"doc_id": own_id, "text_hash": own_hash, "places": own_places})

    @F.pandas_udf("string")
    def without(texts, places):
        import pandas as pd

        out = []
        for text, gone in zip(texts, places):
            drop = set(gone)
            out.append("\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop))
        return pd.Series(out, dtype=object)

    joined = docs.join(per_doc, docs["doc_id"].cast("long").eqNullSafe(per_doc[own_id]) & (docs[mark] == per_doc[own_hash]), "left")
    touched = joined.filter("n_removed > 0").withColumn("text", without("text", own_places))
    same = joined.filter("coalesce(n_removed, 0) = 0")
    zero = {n: F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in new[:-1]}
    columns = [*kept, mark, *zero.values(), F.coalesce("kept_in", F.array().cast("array<bigint>")).alias("kept_in")]
    # Written, so that a row's number is the same in every pass over what is left.
    rest = materialise(touched.select(*columns).unionByName(same.select(*columns)).withColumn(number, F.monotonically_increasing_id()))
    found = drop_passages(rest, number, "doc_id", mark, cut)
    return found.select(
        *kept, ((F.col("n_repeated") > 0) | (F.col(f"{cut}.n_passages") > 0)).alias("has_repeated"), "n_paragraphs", "n_repeated", "n_removed",
        (F.col("words_removed") + F.col(f"{cut}.words_removed")).alias("words_removed"), "kept_in", F.col(f"{cut}.n_passages").alias("n_passages"))
