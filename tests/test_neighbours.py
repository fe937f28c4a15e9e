"""Exact neighbours by cells and, where pivots do not part the vectors, by pairs of blocks of bounded size."""

import numpy as np
import pytest
from test_scale import brute

from lossloom import session
from lossloom.operators import neighbours as N


def found(df, k):
    got = {}
    for r in N.nearest_neighbours(df, "id", "v", k).collect():
        got.setdefault(r.id, []).append((r["rank"], round(r.distance, 12), r.neighbour))
    return {i: [(d, j) for _, d, j in sorted(rows)] for i, rows in got.items()}


def frame(spark, vectors):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<double>").repartition(3)


def test_wide_vectors_meet_in_pairs_of_bounded_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "STEP", 7)
    vectors = np.random.default_rng(3).normal(0, 1, (300, 48))
    vectors[100:140] = vectors[:40]
    used, pairs = [], N.block_pairs

    def watched(rows, k, blocks):
        used.append((rows.count(), blocks))
        return pairs(rows, k, blocks)

    monkeypatch.setattr(N, "block_pairs", watched)
    assert found(frame(spark, vectors), 5) == brute(range(300), vectors, 5)
    # Every vector would have travelled to every cell.
    assert used == [(260, 5)]


def test_vectors_on_a_line_travel_to_few_cells(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "BLOCK_COMPONENTS", 0)
    monkeypatch.setattr(N, "SENT", 5)
    vectors = np.random.default_rng(4).uniform(0, 100, (600, 1))
    monkeypatch.setattr(N, "block_pairs", lambda *a: pytest.fail("pivots part these vectors"))
    assert found(frame(spark, vectors), 3) == brute(range(600), vectors, 3)


def test_no_vectors(spark):
    assert N.nearest_neighbours(spark.createDataFrame([], "id bigint, v array<double>"), "id", "v", 2).count() == 0


def plans(monkeypatch):
    """Plans of all tables that the operators write from now on."""
    seen, write = [], session.materialise_all

    def watched(frames):
        frames = list(frames)
        seen.extend(f._jdf.queryExecution().toString() for f in frames)
        return write(frames)

    monkeypatch.setattr(session, "materialise_all", watched)
    monkeypatch.setattr(N, "materialise_all", watched)
    return seen


def test_vectors_of_block_pairs_are_not_repeated_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    vectors = np.random.default_rng(5).normal(0, 1, (300, 48))
    seen = plans(monkeypatch)
    near = N.nearest_vectors(frame(spark, vectors).selectExpr("id as vid", "v as vec"), 2)
    assert sum("CartesianProduct" in p for p in seen) == 1
    # One copy of a vector for each block was shuffled; the disk grew with the square of the table.
    assert not any("Generate" in p for p in [*seen, near._jdf.queryExecution().toString()])
    assert near.count() == 600


def test_blocks_hold_every_vector_once(spark):
    vectors = np.random.default_rng(6).normal(0, 1, (211, 5))
    rows = N.packed_blocks(frame(spark, vectors).selectExpr("id as vid", "v as vec"), 4).collect()
    held = {}
    for r in rows:
        ids = np.frombuffer(r.ids, np.int64)
        assert r.block in ids and len(ids) <= 53
        held.update(zip(ids.tolist(), np.frombuffer(r.points).reshape(-1, 5).tolist()))
    assert sum(len(r.ids) for r in rows) == 8 * 211 and held == dict(enumerate(vectors.tolist()))


def test_vectors_travel_to_cells_in_rounds_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "ROUND", 1)
    rng = np.random.default_rng(7)
    # A third of the vectors is in one cell of several blocks.
    vectors = np.concatenate([rng.uniform(0, 100, (400, 1)), rng.uniform(50, 50.5, (200, 1))])
    monkeypatch.setattr(N, "block_pairs", lambda *a: pytest.fail("pivots part these vectors"))
    seen = plans(monkeypatch)
    assert found(frame(spark, vectors), 3) == brute(range(600), vectors, 3)
    assert sum("FlatMapCoGroupsInPandas" in p for p in seen) > 3


@pytest.mark.parametrize("kind", ["plain", "ties", "far away", "huge", "tiny", "missing"])
@pytest.mark.parametrize("k", [1, 4])
def test_pairs_that_meet_keep_the_nearest_on_both_sides(monkeypatch, kind, k):
    monkeypatch.setattr(N, "STEP", 7)
    monkeypatch.setattr(N, "WIDE", 16)
    monkeypatch.setattr(N, "SENT", 5)
    rng = np.random.default_rng(8)
    v = rng.normal(0, 1, (90, 6))
    v = {"plain": v, "ties": np.round(v), "far away": 1e6 + 1e-3 * v, "huge": 1e25 * v, "tiny": 1e-30 * v,
         "missing": np.where(rng.random(v.shape) < 0.02, np.nan, v)}[kind]
    ids = rng.permutation(1000)[:90]
    left, right = N._Found(ids[:40], k), N._Found(ids[40:], k)
    N._meet(v[:40], left, v[40:], right, both=True)
    N._meet(v[:40], left, v[:40], left, both=False)
    N._meet(v[40:], right, v[40:], right, both=False)
    for i in range(90):
        away = [(np.sqrt(((v[i] - v[j]) ** 2).sum()), ids[j]) for j in range(90) if j != i]
        want = sorted(x for x in away if np.isfinite(x[0]))[:k]
        side = left if i < 40 else right
        columns = side.columns()
        mine = columns["vid"] == ids[i]
        assert list(zip(columns["distance"][mine], columns["nvid"][mine])) == want


def test_tables_of_the_search_go_before_the_rows_are_read_again(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.normal(0, 1, 4).tolist(), int(i % 5 == 0)) for i in range(200)], "id bigint, v array<double>, y int")
    before = len(session._scratch)
    left = N.balance(df, "id", "v", "y", 1)
    # The points of both kinds and the links.
    assert len(session._scratch) - before == 2
    assert left.filter("y = 1").count() <= 160 and left.count() == left.select("id").distinct().count()
