"""Operators of the training-data pipeline against brute force on small fixtures, with nulls, empty and long texts, ties and repeats."""

import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from lossloom.llm import attention, common, language, mixing, packing, paragraphs, quality, scoring, simhash, token_counts, topk, wrappers

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, part string, row long"


def make_docs(spark, texts, source=lambda k: f"s{k % 3}"):
    rows = [(k if k != 3 else None, t, "en", source(k), None, 1, 2, "x", 3) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    pool = ["".join(rng.choice(["th", "er", "an", "on", "re", "ti"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def line(n):
        return " ".join(rng.choice(pool) for _ in range(n)).capitalize() + "."

    base = ["\n".join(line(rng.randint(1, 60)) for _ in range(rng.randint(1, 5))) for _ in range(40)]
    shared = line(60)
    copies = base[:5] + [base[6] + " " + pool[0], base[7].replace(pool[1], pool[2])]
    return [None, "", "  \n\t ", "null id", "***", *base, *copies, base[9] + "\n" + shared, shared, line(30_000), "one", "one two three four", "Thé ÑU ★ 12"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return make_docs(spark, texts).cache()


def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_row(rows, key="doc_id"):
    return {r[key]: r for r in rows}


def test_components_reach_smallest_node(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 420)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {x: root(x) for x in parent}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_links_and_fingerprints(spark, docs, texts):
    rows = simhash.near_duplicates(docs, block_rows=4).collect()
    prints = {}
    for text in texts:
        found = (text or "").encode().lower().split()
        parts = [b" ".join(found[k:k + 4]) for k in range(max(1, len(found) - 3))] if found else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints[text] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
    got = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in rows)
    assert got == Counter((k if k != 3 else None, prints[t]) for k, t in enumerate(texts))
    label = {k: k for k in range(len(texts)) if k != 3}
    values = {k: prints[texts[k]] for k in label}
    while True:
        new = {k: min(label[j] for j in label if (values[j] ^ values[k]).bit_count() <= 4) for k in label}
        if new == label:
            break
        label = new
    assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None} == label
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_bit_sliced_cells_match_popcount():
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 6, np.uint64)
    values = centre[rng.integers(0, 6, 700)]
    for _ in range(3):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64))
    cell = np.sort(np.r_[np.zeros(300, int), rng.integers(1, 60, 400)])
    near = (np.bitwise_count(values[:, None] ^ values[None, :]) <= 4) & (cell[:, None] == cell[None, :])
    label = np.arange(700)
    while True:
        new = np.where(near, label[None, :], 700).min(1)
        if (new == label).all():
            break
        label = new
    parent = np.arange(700)
    edges = simhash.cell_edges(values, np.arange(700), cell, 4)
    for _ in range(700):
        before = parent.copy()
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
        if (parent == before).all():
            break
    assert (parent == label).all()


def test_repeated_paragraphs(spark, docs, texts):
    rows = paragraphs.drop_repeated(docs, block_rows=3).collect()
    lines = []
    for k, text in enumerate(texts):
        for place, span, found in paragraphs.paragraphs_of((text or "").encode(), paragraphs.MIN_WORDS):
            lines.append(((k, place, span), frozenset(paragraphs.shingles(found))))
    label = list(range(len(lines)))
    for i, (_, a) in enumerate(lines):
        for j in range(i):
            b = lines[j][1]
            if len(a & b) >= 0.8 * len(a | b):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    removed = [lines[i][0] for i in range(len(lines)) if label[i] != i]
    gone = {(k, place + j) for k, place, span in removed for j in range(span)}
    got = by_row(rows)
    for k, text in enumerate(texts):
        key = k if k != 3 else None
        kept = "\n".join(x for p, x in enumerate((text or "").split("\n")) if (k, p) not in gone)
        assert (got[key]["text"] or "") == kept
        assert got[key]["n_removed"] == sum(d == k for d, _, _ in removed)
    assert len(removed) > 5 and len(rows) == len(texts)
    assert paragraphs.drop_repeated(empty(spark)).count() == 0


def test_short_lines_are_joined():
    """Every run of short lines with MIN_WORDS words is covered once and in order; long lines stand alone; nothing else is."""
    rng = random.Random(11)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 3, 8, 15, 19, 20, 45]) for _ in range(rng.randint(0, 30))]
        lines = [" ".join(f"W{rng.randrange(50)}" for _ in range(n)).encode() for n in sizes]
        found = list(paragraphs.paragraphs_of(b"\n".join(lines), 20))
        covered = [p for place, span, _ in found for p in range(place, place + span)]
        assert covered == sorted(set(covered))
        for place, span, words in found:
            assert words == b" ".join(lines[place:place + span]).lower().split() and len(words) >= 20
            assert span == 1 or max(sizes[place:place + span]) < 20
        run: list[int] = []
        for place in range(len(sizes) + 1):
            if place < len(sizes) and sizes[place] < 20:
                run += [place] if sizes[place] else []
                continue
            assert (set(run) <= set(covered)) == (not run or sum(sizes[p] for p in run) >= 20)
            run = []
            assert place == len(sizes) or (place, 1) in [(p, s) for p, s, _ in found]


def test_passage_in_short_lines_is_found(spark):
    """A passage of 240 words in lines of six stands in the middle of other short lines, which differ, and is cut alike."""
    rng = random.Random(5)

    def lines(n):
        return [" ".join(f"w{rng.randrange(10_000)}" for _ in range(6)) for _ in range(n)]

    passage = lines(40)
    held = make_docs(spark, ["\n".join(lines(9 + k) + passage + lines(7)) for k in range(3)] + ["\n".join(lines(50)) for _ in range(5)])
    got = [r["has_repeated"] for r in paragraphs.drop_repeated(held).orderBy(F.col("text").isNull(), F.col("doc_id").asc_nulls_last()).collect()]
    assert sum(got) == 3
    left = paragraphs.drop_repeated(held).agg(F.sum("words_removed")).first()[0]
    assert left >= 0.7 * 2 * 240


@pytest.mark.parametrize("step", [2, 3])
def test_top_inner_products(spark, step):
    rng = np.random.default_rng(step)
    rows = [(k, [float(x) for x in np.round(rng.standard_normal(16), 1)]) for k in range(120)]
    rows += [(200, None), (201, [1.0, None] * 8), (202, [float("nan")] * 16), (203, [float("inf")] * 16), (None, [1.0] * 16), (5, rows[5][1]), (300, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = topk.top_inner_products(df, F.col("vec_id") % step == 0, query_block=7, row_block=25).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {k: np.floor(1024 * np.array(v)).astype(int) for k, v in rows[:120]}
    for q in (k for k in whole if k % step == 0):
        want = sorted(((-int(whole[q] @ v), k) for k, v in whole.items() if k != q))[:10]
        assert sorted(found[q]) == [(n, k, -s) for n, (s, k) in enumerate(want, 1)]
    assert 300 not in found and 200 not in found
    assert topk.top_inner_products(df.limit(0), F.lit(True)).count() == 0


def brute_quality(text):
    found = (text or "").encode().split()
    windows = [tuple(found[k:k + 3]) for k in range(len(found) - 2)]
    often = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(found), sum(len(w.decode()) for w in found), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, texts):
    more = [*texts, "a b c a b c a b", "x x x x x", "## |a| <b> $5 100% & *", "l\nl\nl\n\n", " ".join(map(str, range(200))) * 2]
    docs = make_docs(spark, more)
    target = spark.createDataFrame([(k,) for k in range(5, 40)] * 2 + [(None,), (9999,)], "doc_id long")
    rows = quality.score_quality(docs, target, buckets=512).collect()
    assert len(rows) == len(more)
    counts, chosen = Counter(), Counter()

    def grams(text):
        found = (text or "").lower().encode().split()
        one = [xxhash.xxh64_intdigest(w, 42) for w in found]
        two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(found, found[1:])]
        return [h % 512 if h < 1 << 63 else (h - (1 << 64)) % 512 for h in one + two]

    for k, text in enumerate(more):
        counts.update(grams(text))
        if 5 <= k < 40:
            chosen.update(grams(text))
    n, m = counts.total() + 512, chosen.total() + 512
    got = by_row(rows)
    for k, text in enumerate(more):
        r = got[k if k != 3 else None]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_quality(text)
        g = grams(text)
        score = sum(math.log((chosen[b] + 1) / m) - math.log((counts[b] + 1) / n) for b in g) / len(g) if g else None
        assert (r["score"] is None) == (score is None) and (score is None or abs(r["score"] - score) < 1e-9)
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and score >= -0.06)
    assert quality.score_quality(empty(spark), target).count() == 0


def test_mixing_targets(spark, texts):
    many = [t for t in texts if t is None or len(t) < 20_000] * 4
    docs = make_docs(spark, many, lambda k: None if k % 7 == 0 else f"s{k % 5 if k % 3 else 0}")
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(many)
    again = Counter((r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(5)).collect())
    assert again == Counter((r["doc_id"], r["taken"]) for r in rows)
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert size == Counter({s: next(r["source_size"] for r in rows if r["source"] == s) for s in size})
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, want, free = sum(size.values()), {}, set(order)
    while True:
        rate = (total - sum(want.values())) / sum(weight[s] for s in free)
        full = {s for s in free if rate * weight[s] > 3 * size[s]}
        if not full:
            break
        want |= {s: 3.0 * size[s] for s in full}
        free -= full
    want |= {s: rate * weight[s] for s in free}
    for s in order:
        assert abs(target[s] - want[s]) < 1e-6 * total and abs(taken[s] - want[s]) <= 30
    assert mixing.mix(empty(spark)).count() == 0


def test_fit_counts_is_a_best_subset_sum():
    rng = np.random.default_rng(2)
    for _ in range(40):
        lengths = np.unique(rng.integers(0, 30, 5))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(0, 80))
        sums = {0}
        for length, n in zip(lengths.tolist(), counts.tolist()):
            sums = {s + k * length for s in sums for k in range(n + 1)}
        got = mixing.fit_counts(lengths, counts, budget)
        assert ((got >= 0) & (got <= counts)).all()
        assert int((got * lengths).sum()) == max(s for s in sums if s <= budget)


def test_token_counts_match_plain_segmentation(spark, docs, texts):
    scores, longest, unknown = token_counts.pieces(public_tokenizers.path("piece_bpe_32k.model"))

    def plain(word):
        text = "▁" + word
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            n = len(text[end - 1].encode())
            options = [(best[end - 1][0] + unknown * n, best[end - 1][1] + n)]
            options += [(best[s][0] + scores[text[s:end]], best[s][1] + 1) for s in range(end) if text[s:end] in scores]
            best.append(max(options, key=lambda o: (o[0], -o[1])))
        return best[-1][1]

    known = {}
    got = by_row(token_counts.token_counts(docs).collect())
    for k, text in enumerate(texts):
        found = [w.decode() for w in (text or "").encode().split()]
        n = sum(known[w] if w in known else known.setdefault(w, plain(w)) for w in found)
        assert (got[k if k != 3 else None]["n_words"], got[k if k != 3 else None]["n_tokens"]) == (len(found), n)
    assert token_counts.token_counts(empty(spark)).count() == 0


def test_packing_round_trip(spark, docs, texts):
    rows = packing.pack(docs, part_tokens=20_000).collect()
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    for k, text in enumerate(texts):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[k if k != 3 else None], key=lambda r: r["start"]):
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    for found in windows.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack(empty(spark)).count() == 0


def test_word_encoder_equals_whole_texts():
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["A.B. c, d ., e.. f.\n|x| a|b ''s it's İstanbul ΣΑΣ Σ x y é", "", "end.", "a.\tb,\x0bc ...", "x, . ,, y"]
    want = [np.array(e.ids, "<u2").tobytes() for e in encoder.model.encode_batch(odd, add_special_tokens=False)]
    assert encoder.encode([t.encode() for t in odd]) == want


def test_word_encoder_equals_the_tokenizer_on_mixed_characters(monkeypatch):
    """Every byte of ASCII, small letters beyond it, other letters, spaces and special tokens, with a cache that ages all the time."""
    monkeypatch.setattr(packing, "CACHE", 40)
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(8)
    some = [*map(chr, range(128)), *"abcABC.,'|<>  \néÉßàí÷ÿİ中…½²ªµﬁ\u0301\u00a0\u2003\x85", "'s", "'re", "'LL", "<|startoftext|>", "<|STARTOFTEXT|>", "<|endoftext|>"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    want = [np.array(encoder.model.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encoder.encode([t.encode() for t in texts]) == want


def test_packing_mixture_in_windows():
    packer = packing.Packer(0, 100, 1, {"a": 0.5, "b": 0.3, "c": 0.2}, {})
    for source, n in (("a", 5000), ("b", 3000), ("c", 2000)):
        packer.add(source, 1, np.zeros(n, "<u2").tobytes())
    packer.pack()
    mix = {}
    for _, _, length, _, _, sequence, _, source in zip(*packer.rows):
        mix.setdefault(sequence, Counter())[source] += length
    assert len(mix) == 100 and all(m == Counter(a=50, b=30, c=20) for m in mix.values())


def test_language(spark):
    rng = random.Random(4)
    kinds = {"aa": "bcdfg", "bb": "klmnp", "cc": "éñüöç"}
    rows = [(k, " ".join("".join(rng.choice(kinds[lang]) for _ in range(4)) for _ in range(20)), lang)
            for k, lang in enumerate(rng.choice(sorted(kinds)) for _ in range(200))]
    rows += [(900, None, "aa"), (901, "12 *** !!", "bb"), (None, "bcdfg bcd", None), (902, "", None), (902, "", None), (903, "bcdf " * 100_000, None)]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")), per_language=20).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0)
        if r["doc_id"] is not None and r["doc_id"] < 900:
            assert r["lang_pred"] == r["lang"]
        elif r["doc_id"] is None or r["doc_id"] == 903:
            assert r["lang_pred"] == "aa"
        else:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert language.identify(empty(spark)).count() == 0


def test_lm_scores(spark, docs, texts):
    rows = scoring.score_texts(docs).collect()
    fold = {k: zlib.crc32(("" if k == 3 else str(k)).encode()) % 5 for k in range(len(texts))}
    counts = Counter()
    for k, text in enumerate(texts):
        if fold[k] != 1:
            counts.update([*(text or "").encode().lower().split(), b"\n"])
    n, under = counts.total(), counts.total() + 0.5 * (len(counts) + 1)
    got = by_row(rows)
    for k, text in enumerate(texts):
        r, found = got[k if k != 3 else None], [*(text or "").encode().lower().split(), b"\n"]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold[k] == 1, len(found), sum(counts[w] > 0 for w in found), n)
        assert abs(r["base_score"] - sum(math.log10((counts[w] + 0.5) / under) for w in found)) < 1e-6 * len(found)
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert scoring.score_texts(empty(spark)).count() == 0


def test_mix_fits_long_documents_and_spreads_lengths_that_occur_once():
    taken = mixing.fit_counts(np.array([5_000, 140_000]), np.array([20, 1]), 150_000)
    assert taken.tolist() == [2, 1]
    lengths = np.arange(1_000, 3_000)
    taken = mixing.fit_counts(lengths, np.ones(2_000, np.int64), 2_000_000)
    assert int((lengths * taken).sum()) == 2_000_000 and taken.max() == 1
    assert 0.4 < taken[:1_000].sum() / taken.sum() < 0.6


def test_lm_learns_from_all_windows_of_whole_texts(spark):
    rng = random.Random(5)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    texts = ["", "one", *(" ".join(rng.choice(["claims", "paragraph", "zyx", "of", "unthinkable"]) for _ in range(n)) for n in (30, 400, 3_000))]
    counts = scoring.count_words(spark.createDataFrame([(t.encode(),) for t in texts], "text binary"))
    scorer = scoring.TextScorer(vocabulary, scoring.id_counts(counts, vocabulary))
    rows = scoring.text_pieces(spark.createDataFrame(list(enumerate(texts)), "draw long, text string"), vocabulary).collect()
    whole = scorer.ids([t.encode() for t in texts])
    assert len(rows) == sum(-(-len(i) // scoring.PIECE) for i in whole) and len(whole[-1]) > 2 * scoring.PIECE
    ids = [np.frombuffer(r["ids"], "<u2").astype(np.int32) for r in rows]
    assert sum(int((i == scorer.end).sum()) for i in ids) == len(texts)

    def bag(columns):
        return Counter(b"".join(c[k].tobytes() for c in columns) for k in range(len(columns[0])))

    # Target and symbol before count where a position is scored.
    x, before, target, weight, _ = scorer.examples(whole)
    own = scorer.lessons(ids, [r["place"] > 0 for r in rows])
    assert bag([x, before, target, weight]) == bag(own) and int(own[3].sum()) == sum(map(len, whole))


def test_lm_pairs_of_rare_ids_are_counted():
    size = scoring.FREQUENT + 500
    symbols = scoring.Symbols(np.arange(size, 0, -1), np.zeros(size, bool))
    rare, mate = size - 1, size - 2
    assert symbols.rank[rare] >= scoring.FREQUENT and symbols.of_class[rare] == symbols.of_class[mate]
    symbols.follow(np.array([5 * size + rare, 9 * size + 3, 5 * size + mate]), np.array([40, 7, 2]))
    after = symbols.inside_class(np.full(size, 5), np.arange(size))
    assert np.allclose(np.bincount(symbols.of_class, np.exp(after), scoring.CLASSES), 1, atol=1e-4)
    share = symbols.share[rare]
    assert abs(math.exp(after[rare]) - (40 + scoring.ALPHA * share) / (42 + scoring.ALPHA)) < 1e-5
    assert symbols.prior[5, symbols.of_class[rare]] == symbols.prior[5].max()


def test_attention_is_causal_normalised_and_has_the_right_gradient():
    rng = np.random.default_rng(0)
    model = attention.new_model(50, 12)
    prior = np.ones((50, 12), np.float32)
    ids = [rng.integers(2, 50, n).astype(np.int32) for n in (1, 8, 9, 40)]
    x, counts = attention.windows(ids)
    assert counts.tolist() == [1, 1, 2, 5] and [int((w[attention.HALF:] != 0).sum()) for w in x] == [1, 8, 8, 1, 8, 8, 8, 8, 8]
    before = x[:, attention.HALF:]
    total = sum(np.exp(attention.class_scores(model, x, prior, before, np.full(before.shape, c))) for c in range(12))
    assert np.allclose(total, 1, atol=1e-4)
    target = rng.integers(0, 12, before.shape)
    first = attention.class_scores(model, x, prior, before, target)
    later = x.copy()
    later[:, -1] = 7
    assert np.allclose(first[:, :-1], attention.class_scores(model, later, prior, before, target)[:, :-1])
    weight = np.ones(before.shape, np.float32)
    flat = prior[before.reshape(-1)]
    _, g = attention.gradient(model, x, flat, target, weight)
    for name in ("q", "k", "v", "gap", "o", "u"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        up[name][at] += 0.01
        down[name][at] -= 0.01
        slope = (attention.gradient(up, x, flat, target, weight)[0] - attention.gradient(down, x, flat, target, weight)[0]) / 0.02
        assert abs(slope - g[name][at]) < 0.05 * abs(g[name][at]) + 1e-4


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="nav-open"><header>Top</header><nav><ul><li>Menu</ul></nav>
<div id="cookie-notice">Accept</div><%s><h1>Head &amp; line</h1><p>One <b>bold</b>
 two<br>three</p><script>var a = "</p>";</script><p>Open<ul><li>i</li><li>ii</ul><aside>Side</aside><form>Mail<input></form>
<section class="comments"><p>Reader</p></section>%s</%s><footer>&copy; x</footer>%s"""


def test_main_text(spark):
    want = "Head & line\nOne bold two three\nOpen\ni\nii\nLast €"
    rows = [(k, f"http://h{k % 2}.example/{k}", PAGE % ("article", "<p>Last &euro;", "article", "</body></html>" if k % 3 else "")) for k in range(12)]
    rows += [(20, "http://other/", PAGE % ("div", "<p>Last &euro;</p>", "div", "")), (21, None, None), (22, "odd", ""), (23, "http://h0.example/x", "<p>loose < text"),
             (24, "http://h0.example/y", "<div>" * 3000 + "deep" + "</div>" * 3000), (25, "http://h1.example/z", "<!-- open"), (0, rows[0][1], rows[0][2])]
    got = wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("t"))).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(text[k] == want for k in [*range(12), 20])
    assert (text[21], text[22], text[23], text[24], text[25]) == ("", "", "loose < text", "deep", "")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert wrappers.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_resolves_optional_and_repeated_groups():
    a, b = (wrappers.shape(wrappers.parse(h)) for h in ("<h2>a</h2><p>b</p><h2>c</h2><p>d</p>", "<div>x</div><h2>a</h2><p>b</p>"))
    merged = wrappers.merge(a, b)
    assert a[0] == [[[["h2", False, False], ["p", False, False]], False, True]]
    assert json.dumps(merged[0]).count("div") == 1 and ["div", True, False] in merged[0]
