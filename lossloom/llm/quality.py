"""Quality rules by a hashed n-gram log-likelihood ratio, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.llm.common import words
from lossloom.session import materialise

SYMBOLS = r"[#*$%&|<>]"
MAX_BITMAPS = 8192  # 32 MB


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where `use` names it inside another lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeat_words(found: Column, few: int = 64) -> Column:
    """Number of words that lie in a 3-word window found twice or more.

    Sorted window hashes show which hashes repeat. Only windows with such a hash are compared as text: sorted by hash
    and text, equal neighbours are the repeated ones. Their places in order cover three words each, less the overlap
    with the next. With more than `few` repeated hashes all windows are sorted instead of looked up one by one.
    """

    def repeated(ordered: Column) -> Column:
        n = F.size(ordered)
        return F.array_distinct(F.array_compact(F.zip_with(
            F.slice(ordered, 1, n - 1), F.slice(ordered, 2, n - 1), lambda a, b: F.when(a == b, a))))

    def candidates(w: Column, h: Column, again: Column) -> Column:
        all_places = F.sequence(F.lit(1), F.size(w) - 2)
        chosen = F.when(F.size(again) > few, all_places).otherwise(F.filter(all_places, lambda i: F.array_contains(again, F.get(h, i - 1))))
        return F.sort_array(F.transform(chosen, lambda i: F.struct(
            F.get(h, i - 1).alias("h"), F.concat_ws(" ", F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("w"), i.alias("p"))))

    def places(ordered: Column) -> Column:
        n = F.size(ordered)
        near = F.zip_with(F.slice(ordered, 1, n - 1), F.slice(ordered, 2, n - 1), lambda a, b: (a["h"] == b["h"]) & (a["w"] == b["w"]))
        return let(near, lambda same: F.sort_array(F.transform(F.filter(
            F.zip_with(ordered, F.zip_with(F.concat(F.array(F.lit(False)), same), F.concat(same, F.array(F.lit(False))), lambda a, b: a | b),
                       lambda row, hit: F.struct(row["p"].alias("p"), hit.alias("hit"))), lambda x: x["hit"]), lambda x: x["p"])))

    def covered(at: Column) -> Column:
        n = F.size(at)
        gaps = F.zip_with(F.slice(at, 1, n - 1), F.slice(at, 2, n - 1), lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda total, g: total + g))

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
        return let(hashes, lambda h: let(let(F.sort_array(h), repeated), lambda again: F.when(F.size(again) == 0, F.lit(0)).otherwise(
            let(candidates(w, h, again), lambda o: let(places(o), covered)))))

    return let(found, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(count(w))).cast("long")


def base_rules(text: Column, found: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(found).cast("long"),
        "word_chars": F.char_length(F.regexp_replace(whole, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": (F.char_length(whole) - F.char_length(F.translate(whole, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(found),
    }


def grams(found: Column, buckets: int) -> Column:
    """Array of bucket numbers of the words and word pairs of a text."""
    def hashed(w: Column) -> Column:
        n = F.size(w)
        one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
        two = F.when(n < 2, F.array().cast("array<int>")).otherwise(F.zip_with(
            F.slice(w, 1, n - 1), F.slice(w, 2, n - 1), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int")))
        return F.concat(one, two)

    return let(found, hashed)


def ratios(counts: DataFrame, buckets: int) -> Column:
    """Array by bucket of log p(target) - log p(raw), add-one smoothed, from `counts(bucket, n, n_target)`.

    Every bucket is one number, so the array is bounded by the parameter whatever the corpus.
    """
    rows = {r["bucket"]: (r["n"], r["n_target"]) for r in counts.collect()}
    raw, target = sum(a for a, _ in rows.values()) + buckets, sum(b for _, b in rows.values()) + buckets
    pairs = (rows.get(i, (0, 0)) for i in range(buckets))
    return F.lit([math.log((b + 1) / target) - math.log((a + 1) / raw) for a, b in pairs])


def mark_targets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`docs(doc_id, text)` with target 1 where the id is in `ids(doc_id)`, else null; texts are not shuffled.

    The ids become bitmaps of 32,768 ids, 4 KB each, which are broadcast after their number is counted. Ids spread over more
    than MAX_BITMAPS of them are joined as they are.
    """
    bucket = F.bitmap_bucket_number("doc_id")
    ids = ids.filter("doc_id is not null")
    if ids.select(bucket.alias("b")).distinct().limit(MAX_BITMAPS + 1).count() > MAX_BITMAPS:
        return docs.join(ids.distinct().withColumn("target", F.lit(1)), "doc_id", "left")
    maps = F.broadcast(ids.groupBy(bucket.alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("doc_id")).alias("bits")))
    place = F.bitmap_bit_position("doc_id").cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    return docs.join(maps, bucket == F.col("b"), "left").select("doc_id", "text", F.when(hit, 1).alias("target"))


def score_quality(docs: DataFrame, target_ids: DataFrame, buckets: int = 8192, threshold: float = -0.06,
                  min_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """Base rules, score and verdict for every row of `docs(doc_id, text)`.

    Two multinomials over hashed words and word pairs are counted: one over all documents, one over those whose id is in
    `target_ids(doc_id)` (each id once; ids without a document do nothing). A document's score is the log-likelihood
    ratio of its n-grams under both, divided by their number; it is kept if it passes the base rules and its score
    reaches `threshold`. The verdict depends on the row and the counts alone, so equal texts get equal verdicts.
    A null or empty text has no words, score null, and fails the base rules. Null ids are no target.
    """
    marked = mark_targets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), target_ids.select(F.col("doc_id").cast("long").alias("doc_id")))
    counts = marked.select(F.explode(grams(words(F.lower("text")), buckets)).alias("bucket"), "target").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count("target").alias("n_target"))
    ratio = ratios(materialise(counts), buckets)
    found = words(F.col("text"))
    score = let(grams(words(F.lower("text")), buckets), lambda g: F.aggregate(
        g, F.lit(0.0), lambda total, b: total + F.get(ratio, b)) / F.nullif(F.size(g), F.lit(0)))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", found.alias("found")).select(
        "doc_id", *(c.alias(n) for n, c in base_rules(F.col("text"), F.col("found")).items()), score.alias("score"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False)))
