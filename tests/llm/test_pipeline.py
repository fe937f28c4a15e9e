"""Stages of the corpus pipeline on the given tables."""

import random
from collections import Counter

from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from lossloom.llm import simhash


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR))
        assert docs.columns == list(corpus_pipeline.COLUMNS) and docs.count() > 0
        ids = {r["doc_id"] for r in before.select("doc_id").collect()}
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= ids
        if name == "near_duplicates":
            groups = simhash.near_duplicates(before).select("component_id").distinct().count()
            assert docs.count() == groups
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    copies = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    whole = {r["doc_id"]: r["doc_tokens"] for r in packed}
    length = Counter()
    for r in packed:
        length[r["doc_id"]] += r["length"]
    assert length == Counter({k: n * whole[k] for k, n in copies.items()})
    assert first.count() >= len(copies)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_near_duplicates_by_fingerprint_distance(spark):
    """The stage's contract: four-word shingles, 4 of 64 bits; groups by brute force over all pairs of fingerprints."""
    rng = random.Random(4)
    lone = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(80)) for _ in range(5)]
    base = [f"w{rng.randrange(10_000)}" for _ in range(4000)]
    near = [*base[:2000], "one", *base[2000:]]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (None, lone[0]), (None, lone[1]), (7, lone[2]), (7, lone[3]), (None, lone[4]), (9, lone[4]),
            (4, None), (3, ""), (None, " \n")]
    prints = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin((prints[i] ^ prints[j]) & (1 << 64) - 1).count("1") <= 4:
                group = [group[j] if g == group[i] else g for g in group]
    assert group[0] == group[1]
    first = {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)):
        first.setdefault(group[k], rows[k])
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark, [(i, t) for i, t in rows]), SF_DIR).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(first.values())


def test_mix_takes_rows_without_or_with_repeated_ids(spark):
    rows = [(None, "a b c"), (None, "d e f g"), (5, "h i"), (5, "j k l m n"), (5, "o"), (6, "p q r s t u")]
    docs = frame(spark, rows)
    got = corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect()
    # One source: its target is its size, so every row is taken once.
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)


def test_stages_on_empty_tables_and_odd_rows(spark):
    """No row gives no row; nulls in any column, repeated rows, a long text and columns with names that stages use inside pass through all stages."""
    rng = random.Random(8)
    line = lambda n: " ".join(f"w{rng.randrange(5_000)}" for _ in range(n))
    texts = [line(60) for _ in range(12)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [
        (None, line(40), "en", None, None), (50, line(30_000), None, "s", 2), (51, None, "en", "s", None), (52, "", None, None, 0), (1, texts[1], "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    # Stages read the five columns; these are there besides.
    extra = {"row": "x", "component_id": "y", "guess": "z", "places": "p", "size": "q", "copy": "r"}
    plain = spark.createDataFrame(rows, schema)
    for start, odd in ((spark.createDataFrame([], schema), False), (plain, True)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            if odd and name in ("language", "repeated_paragraphs", "packing"):
                docs = docs.withColumns({n: F.lit(v) for n, v in extra.items()})
            docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR))
            if not odd:
                assert docs.count() == 0
            elif name == "near_duplicates":
                kept = Counter(r["doc_id"] for r in docs.collect())
                assert kept[1] == 1 and kept[None] == 1 and kept[50] == 1 and kept[51] == 0
            ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
            if odd and name == "repeated_paragraphs":
                assert ids == {None, *range(12), 50}
            # The mix leaves out what its targets do not want; packing gives pieces of every row it gets.
            assert name != "packing" or ids == mixed
            mixed = ids
            if name != "packing":
                assert docs.columns == list(corpus_pipeline.COLUMNS)
