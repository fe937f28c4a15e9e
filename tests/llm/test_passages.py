"""Passages inside lines against brute force over all windows of 50 words."""

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from lossloom.llm import paragraphs, passages

SCHEMA = "doc_id long, text string"


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(3_000)}" for _ in range(n))


def shared_by(texts):
    """Indices of texts that share a window of 50 words with another one."""
    seen = defaultdict(set)
    for k, text in enumerate(texts):
        words = (text or "").lower().split()
        for i in range(len(words) - 49):
            seen[tuple(words[i:i + 50])].add(k)
    return {k for s in seen.values() if len(s) > 1 for k in s}


def test_passage_inside_longer_lines_is_found_and_taken_out(spark):
    """Passages of 50 to 70 words stand in the middle of lines that are otherwise different: no two lines come near Jaccard 0.8."""
    rng = random.Random(6)
    texts = []
    for size in (49, 50, 51, 60, 70):
        passage = sentence(rng, size)
        texts += [f"{sentence(rng, 90)} {passage} {sentence(rng, 40 + k)}\n{sentence(rng, 30)}" for k in range(3)]
    split = sentence(rng, 80).split()
    texts += [f"{sentence(rng, 40)} {' '.join(split).upper()}", f"{' '.join(split[:30])}\n{' '.join(split[30:])} {sentence(rng, 60)}"]
    texts += [sentence(rng, 200) for _ in range(10)] + ["", sentence(rng, 20), None]
    rows = {r["doc_id"]: r for r in paragraphs.drop_repeated(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4)).collect()}
    want = shared_by(texts)
    assert want == set(range(3, 17)) and {k for k, r in rows.items() if r["has_repeated"]} == want == {k for k, r in rows.items() if r["n_passages"]}
    assert not shared_by([rows[k]["text"] for k in range(len(texts))])
    for k, text in enumerate(texts):
        left, words = (rows[k]["text"] or "").split(), (text or "").split()
        assert len(left) == len(words) - rows[k]["words_removed"]
        # The first copy stays whole; elsewhere only words of the passage go.
        first = k not in want or k in (3, 6, 9, 12, 15)
        assert rows[k]["words_removed"] == (0 if first else 80 if k == 16 else (50, 51, 60, 70)[k // 3 - 1]) and (rows[k]["text"] == text or not first)


def test_equal_rows_and_null_ids(spark):
    rng = random.Random(7)
    text = sentence(rng, 120)
    held = [(None, f"{sentence(rng, 60)} {text}"), (4, f"{text} {sentence(rng, 50)}"), (8, sentence(rng, 90))]
    got = paragraphs.drop_repeated(spark.createDataFrame([*held, held[1], held[2]], SCHEMA)).select("doc_id", "n_passages", F.size(F.split("text", " ")).alias("n"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, 1, 180), (4, 1, 50), (4, 1, 50), (8, 0, 90), (8, 0, 90)], key=str)


def test_every_window_holds_a_fingerprint_of_its_own_words():
    rng = random.Random(8)
    for size in (10, 49, 50, 51, 75, 400):
        words = sentence(rng, size).split()
        prints = set(passages.fingerprints(" ".join(words).encode()).tolist())
        for i in range(size - 49):
            own = passages.fingerprints(" ".join(words[i:i + 50]).encode()).tolist()
            assert len(own) == 1 and own[0] in prints
        hashes = passages.rolled(passages.word_hashes(" ".join(words * 2).encode()), 5, passages.BASES[0])
        assert np.array_equal(hashes[:max(0, size - 4)], hashes[size:])
