"""MinHash fingerprints, edited texts and near-copy classes against brute force."""

import random
from hashlib import sha256

import numpy as np
import pytest

from lossloom.llm import minhash

SCHEMA = "doc_id long, text string, n_chars long, digest long, node long, text_hash long, part int, component_id long"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def exact(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def edited(text, following):
    text, following = text or "", following or ""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def make(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 6) for i, t in rows], SCHEMA)


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    base = [words(rng, rng.randrange(1, 300)) for _ in range(60)]
    texts = [" ".join(w) for w in base]
    for k in range(10):
        near = words(rng, 200)
        texts.append(" ".join(near))
        for _ in range(3):
            other = list(near)
            other[rng.randrange(200)] = "changed"
            texts.append(" ".join(other))
        texts.append(" ".join(near[:100] + words(rng, 100)))
    texts += ["", None, "  \n", "★ é 😀", "one two", "One  TWO", " ".join(words(rng, 20_000))]
    rng.shuffle(texts)
    return [*enumerate(texts)]


def test_hashes_follow_shingles():
    a, b = b"a b c d e f g", b"A  b\nc d e x y"
    left, right = (set(minhash.shingle_hashes(t).tolist()) for t in (a, b))
    assert len(left) == len(right) == 3 and len(left & right) == 1
    assert len(minhash.shingle_hashes(b"")) == 0 and len(minhash.shingle_hashes(b"a b")) == 1
    assert minhash.fingerprint(minhash.minima(minhash.shingle_hashes(b""))) == "f" * 512


def test_rows_against_brute_force(spark, rows):
    got = {r["doc_id"]: r for r in minhash.fingerprint_documents(make(spark, rows)).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    sets = {i: shingle_set(t) for i, t in rows}
    component = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if component[i] < component[j] and exact(sets[i], sets[j]) >= 0.8:
                    component[j], changed = component[i], True
    by_print = {}
    for (i, text), (j, following) in zip(order, order[1:] + order[:1]):
        row = got[i]
        new = edited(text, following)
        assert row["n_chars"] == len(text or "") and row["edited_sha256"] == sha256(new.encode()).hexdigest()
        assert row["edited_fingerprint"] == minhash.fingerprint(minhash.minima(minhash.shingle_hashes(new.encode())))
        assert abs(row["near_edited"] - exact(sets[i], shingle_set(new))) < 0.2
        assert abs(row["near_next"] - exact(sets[i], sets[j])) < 0.2
        if text and text == new:
            assert row["near_edited"] == 1
        assert by_print.setdefault(row["fingerprint"], sets[i]) == sets[i]
        assert row["component_id"] == component[i]
        assert row["class_rows"] == list(component.values()).count(component[i])


def test_nulls_repeats_and_ties(spark, monkeypatch):
    big = "repeated words stand here " * 50
    rows = [(5, "a b c d e f"), (5, "g h i j k l"), *[(4, big)] * 40, (None, "x y z"), (None, None), (None, None), (2, None), (3, "ends here now")]
    docs = make(spark, rows)
    got = minhash.fingerprint_documents(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    hashes = {(r["doc_id"], r["text"]): r["text_hash"] for r in minhash.with_text_hash(docs).collect()}
    order = sorted(rows, key=lambda r: minhash.order_key(r[0], hashes[(r[0], (r[1] or "").encode())]))
    want = [(i, sha256(edited(t, f).encode()).hexdigest()) for (i, t), (_, f) in zip(order, order[1:] + order[:1])]
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in got), key=str) == sorted(want, key=str)
    # The run of equal rows is larger than a part and so begins several of them.
    starts = minhash.part_starts(minhash.materialise(minhash.sketches(docs)), 8)
    assert len(starts) == 8 and len(set(starts)) < 8
    nulls = [r for r in got if r["doc_id"] is None and r["n_chars"] == 0]
    assert {(r["component_id"], r["class_rows"]) for r in nulls} == {(2, 3)}


def test_single_row_and_empty_table(spark):
    one = minhash.fingerprint_documents(make(spark, [(1, "a b c d")])).collect()
    assert [(r["edited_sha256"], r["near_next"], r["component_id"], r["class_rows"]) for r in one] == [(sha256(b"a b a b").hexdigest(), 1.0, 1, 1)]
    empty = minhash.fingerprint_documents(make(spark, []))
    assert empty.count() == 0 and "text_hash" not in empty.columns


def test_large_buckets_keep_every_link(spark):
    """Chains inside one bucket are found although no member is near the leader; blocks are smaller than the bucket."""
    rng = random.Random(5)
    shared = words(rng, 60)
    texts = []
    for k in range(12):
        own = shared + words(rng, 40)
        texts += [" ".join(own), " ".join(own[:-4] + words(rng, 4))]
    docs = make(spark, [*enumerate(texts)])
    found = minhash.materialise(minhash.sketches(docs))
    got = {r["digest"]: r["component"] for r in minhash.copies(docs, found, block_rows=2).collect()}
    digest = {r["doc_id"]: r["digest"] for r in found.collect()}
    sets = [shingle_set(t) for t in texts]
    for k in range(0, len(texts), 2):
        assert exact(sets[k], sets[k + 1]) >= 0.8 and got[digest[k]] == got[digest[k + 1]]
    assert len(set(got.values())) == 12


def test_likeness_estimates_jaccard():
    rng = random.Random(1)
    errors = []
    for _ in range(40):
        a = words(rng, 300)
        cut = rng.randrange(300)
        b = a[:cut] + words(rng, 300 - cut)
        ta, tb = (" ".join(t) for t in (a, b))
        got = minhash.likeness(*(minhash.minima(minhash.shingle_hashes(t.encode())) for t in (ta, tb)))
        errors.append(got - exact(shingle_set(ta), shingle_set(tb)))
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.15
