"""Online LDA: every step reads its own documents only, and finds planted topics."""

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.linalg import Vectors

from lossloom.operators import online_lda
from lossloom.operators import topics as P
from lossloom.sources import readers, sinks


def planted(n, rng):
    """Even documents use terms 0 to 4, odd ones 5 to 9; every tenth is empty."""
    rows = []
    for i in range(n):
        counts = np.bincount(rng.integers(0, 5, 40) + 5 * (i % 2), minlength=10)
        used = [] if i % 10 == 9 else np.flatnonzero(counts)
        rows.append((i, Vectors.sparse(10, [int(t) for t in used], [float(counts[t]) for t in used])))
    return rows


def test_gamma_functions():
    assert np.allclose(online_lda.digamma(np.array([0.1, 1.0, 5.5])), [-10.4237549404, -0.5772156649, 1.6110931486], atol=1e-9)
    assert np.allclose(online_lda.trigamma(np.array([0.1, 1.0, 5.5])), [101.4332991508, 1.6449340668, np.pi ** 2 / 2 - 4 * sum(1 / (2 * k - 1) ** 2 for k in range(1, 6))], atol=1e-9)


def test_each_pass_reads_each_document_once(spark, monkeypatch):
    docs = spark.createDataFrame(planted(400, np.random.default_rng(0)), ["id", "v"]).repartition(3)
    reads, asked = [], []
    real = type(spark.sparkContext).runJob

    def spy(self, rdd, task, partitions=None, allowLocal=False):
        found = real(self, rdd, task, partitions, allowLocal)
        asked.append(tuple(partitions))
        reads.append(sum(f[2] for f in found))
        return found

    monkeypatch.setattr(type(spark.sparkContext), "runJob", spy)
    model = P.fit_lda(docs, "v", topics=2, passes=3, chunk=50)
    assert model.steps == 3 * 8 and sum(reads) == 3 * 400 and max(reads) <= 80
    for k in range(3):
        taken = [p for step in asked[8 * k:8 * k + 8] for p in step]
        assert sorted(taken) == list(range(len(taken)))
    shares = {r.id: (r.TOPIC_NEW_0, r.TOPIC_NEW_1) for r in P.topic_distribution(docs, model).collect()}
    assert shares[9] == (0, 0)
    side = shares[0][0] > 0.5
    assert all((s[0] > 0.5) == (side == (i % 2 == 0)) and abs(sum(s) - 1) < 1e-9 for i, s in shares.items() if i % 10 != 9)
    top = {r.topic: set() for r in P.topic_terms(model, [str(i) for i in range(10)], 5).collect()}
    for r in P.topic_terms(model, [str(i) for i in range(10)], 5).collect():
        top[r.topic].add(r.term)
    assert sorted(map(sorted, top.values())) == [list("01234"), list("56789")]


def test_many_chunks_share_a_step(spark, monkeypatch):
    monkeypatch.setattr(online_lda, "STEPS", 2)
    docs = spark.createDataFrame(planted(400, np.random.default_rng(1)), ["id", "v"])
    model = P.fit_lda(docs, "v", topics=2, passes=3, chunk=20)
    assert model.steps == 3 * 2
    heavy = [set(np.argsort(-w)[:5].tolist()) for w in model.weights]
    assert sorted(map(sorted, heavy)) == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9]]


def test_empty_table_and_models_of_both_kinds(spark, tmp_path):
    rows = planted(40, np.random.default_rng(2))
    docs = spark.createDataFrame(rows, ["id", "v"])
    with pytest.raises(ValueError):
        P.fit_lda(docs.filter("id < 0"), "v", topics=2)
    model = P.fit_lda(docs, "v", topics=2, passes=2, chunk=10)
    sinks.save_model(model, str(tmp_path / "own"))
    sinks.save_model(model, str(tmp_path / "own"))
    loaded = readers.load_lda(str(tmp_path / "own"))
    assert (loaded.weights == model.weights).all() and (loaded.alpha == model.alpha).all()
    sinks.save_model(LDA(k=2, maxIter=2, featuresCol="v", topicDistributionCol="topics").fit(docs), str(tmp_path / "spark"))
    assert P.topic_distribution(docs, readers.load_lda(str(tmp_path / "spark"))).count() == 40
