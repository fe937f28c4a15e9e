"""Training steps, and scores from ids that were written once."""

import random

import numpy as np
import public_tokenizers

from lossloom.llm import attention, scoring

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_and_scores_come_from_ids(spark):
    rng = random.Random(6)
    texts = ["", "one", *(" ".join(rng.choice(["claims", "Paragraph", "zyx", "of", "unthinkable."]) for _ in range(n)) for n in (30, 900))]
    counts = scoring.count_words(spark.createDataFrame([(t.lower().encode(),) for t in texts], "text binary"))
    symbols = scoring.id_counts(counts, VOCABULARY)
    model = attention.new_model(scoring.INPUTS, scoring.CLASSES)
    scorer = scoring.TextScorer(VOCABULARY, symbols, model)
    packed = scorer.packed([t.encode() for t in texts])
    by_ids = scoring.id_pieces(spark.createDataFrame(list(enumerate(packed)), "draw long, ids binary")).collect()
    by_text = scoring.text_pieces(spark.createDataFrame(list(enumerate(texts)), "draw long, text string"), VOCABULARY).collect()
    assert sorted(map(tuple, by_ids)) == sorted(map(tuple, by_text))
    assert len(packed[-1]) > 2 * scoring.PIECE * 2
    ids = [np.frombuffer(p, "<u2").astype(np.int32) for p in packed]
    # Every position by itself: its window holds the symbols up to it and nothing later.
    for found, score in zip(ids, scorer.scores(ids)):
        shown = np.r_[attention.BEGIN, symbols.symbol[found[:-1]]]
        total = 0.0
        for i, target in enumerate(found):
            start = i // attention.HALF * attention.HALF - attention.HALF
            x = np.zeros((1, attention.SPAN), np.int32)
            for j in range(max(0, start), i + 1):
                x[0, j - start] = shown[j]
            before = np.full((1, attention.HALF), symbols.before[found[i - 1]] if i else attention.BEGIN, np.int32)
            goal = np.full((1, attention.HALF), target, np.int32)
            total += float(attention.class_scores(model, x, symbols.prior, before, symbols.of_class[goal])[0, i % attention.HALF])
            total += float(symbols.inside_class(before, goal)[0, 0])
        assert abs(score - total / np.log(10)) < 1e-3 + 1e-4 * abs(total)


def test_adam_steps_of_one_vector():
    rng = np.random.default_rng(3)
    model = attention.new_model(20, 6)
    plain = {k: v.astype(np.float64) for k, v in model.items()}
    first, second = ({k: np.zeros_like(v) for k, v in plain.items()} for _ in range(2))
    adam = attention.Adam(model, 0.01)
    for step in range(1, 6):
        g = {k: rng.standard_normal(v.shape).astype(np.float32) for k, v in model.items()}
        adam.update(g)
        for k, v in plain.items():
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k].astype(np.float64) ** 2
            v -= 0.01 * (1 - 0.99 ** step) ** 0.5 / (1 - 0.9 ** step) * first[k] / (np.sqrt(second[k]) + 1e-7)
    assert adam.all.size == sum(v.size for v in model.values())
    assert all(np.allclose(model[k], v, atol=1e-4) and np.shares_memory(model[k], adam.all) for k, v in plain.items())
    rows = rng.integers(0, 20, 300)
    values = rng.standard_normal((300, 5)).astype(np.float32)
    want = np.zeros((20, 5))
    np.add.at(want, rows, values)
    assert np.allclose(attention.row_sums(20, rows, values), want, atol=1e-4)
