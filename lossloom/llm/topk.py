"""Exact top-k inner products: bounds from segment means and deviations, coarse to fine, then exact scores of the survivors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossloom.session import materialise

LEVELS = (1, 4, 16)
QUERY_STEP = 256
ROW_STEP = 4096
DENSE = 1 / 16  # share of the pairs of a block above which one product of matrices is cheaper


def quantised(vector: Column, scale: int = 1024) -> Column:
    """Array of floor(scale * x), x as double; null if the vector is null or holds a null or non-finite component."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), whole)


def segment_stats(rows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and deviations of `level` segments, scaled so that products of both add up to a bound of the inner product."""
    sums, devs = [], []
    for part in np.array_split(rows, level, axis=1):
        n = max(1, part.shape[1])
        mean = part.sum(1, keepdims=True) / n
        sums.append(mean[:, 0] * np.sqrt(n))
        devs.append(np.sqrt(((part - mean) ** 2).sum(1)))
    return np.stack(sums, 1), np.stack(devs, 1)


def products(a: np.ndarray, b: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Inner products of rows `at[0]` of a with rows `at[1]` of b: pair by pair, or as one product of matrices where most pairs are asked."""
    if len(at[0]) > DENSE * len(a) * len(b):
        return (a @ b.T)[at]
    out = np.empty(len(at[0]), a.dtype)
    for t in range(0, len(out), 1 << 17):
        part = slice(t, t + (1 << 17))
        out[part] = np.einsum("ij,ij->i", a[at[0][part]], b[at[1][part]])
    return out


def exact_scores(a: np.ndarray, b: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Inner products of pairs of rows as 64-bit integers; doubles hold them when every sum stays below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0 ** 53:
        return products(a.astype(np.float64), b.astype(np.float64), at).astype(np.int64)
    return products(a, b, at)


def best_of_cell(query_id: np.ndarray, q: np.ndarray, vec_id: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple]:
    """Top k rows of one cell for each of its queries, the query's own id left out.

    The squared distance of two vectors splits by segment into the distance of the means and at least the squared
    difference of the deviations. Read as a bound of the inner product: the product of the means plus the product of
    the deviations. Levels are tried coarse to fine, against the k-th best score found so far.
    """
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    bounds = [(segment_stats(qf, n), segment_stats(xf, n)) for n in LEVELS if n <= max(1, q.shape[1])]
    norm = np.sqrt((xf ** 2).sum(1))
    order = np.lexsort((vec_id, -norm))  # long vectors first: thresholds rise early
    for s in range(0, len(q), QUERY_STEP):
        ids, vectors = query_id[s:s + QUERY_STEP], q[s:s + QUERY_STEP]
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
        floor = np.full(len(ids), -np.inf)
        length = np.sqrt((qf[s:s + QUERY_STEP] ** 2).sum(1))
        for r in range(0, len(order), ROW_STEP):
            rows = order[r:r + ROW_STEP]
            if (length * norm[rows[0]] * (1 + 1e-9) + 1 < floor).all():
                break
            live = np.nonzero(np.ones((len(ids), len(rows)), bool))
            for (qm, qd), (xm, xd) in bounds:
                top = products(qm[s:s + QUERY_STEP], xm[rows], live) + products(qd[s:s + QUERY_STEP], xd[rows], live)
                keep = top + 1e-9 * np.abs(top) + 1 >= floor[live[0]]
                live = live[0][keep], live[1][keep]
            keep = ids[live[0]] != vec_id[rows[live[1]]]
            live_q, live_x = live[0][keep], live[1][keep]
            if not len(live_q):
                continue
            score = exact_scores(vectors, x[rows], (live_q, live_x))
            enough = score >= floor[live_q]
            live_q, live_x, score = live_q[enough], live_x[enough], score[enough]
            cut = np.searchsorted(live_q, np.arange(len(ids) + 1))
            for i in np.unique(live_q):
                v = np.concatenate([best[i][0], vec_id[rows[live_x[cut[i]:cut[i + 1]]]]])
                c = np.concatenate([best[i][1], score[cut[i]:cut[i + 1]]])
                pick = np.lexsort((v, -c))[:k]
                best[i] = v[pick], c[pick]
                if len(pick) == k:
                    floor[i] = c[pick[-1]]
        for i, (v, c) in enumerate(best):
            yield int(ids[i]), v, c


def top_inner_products(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024,
                       query_block: int = 16384, row_block: int = 16384) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `vectors(vec_id, embedding)` where `queries` holds, its k best others.

    Rows with a null id, a null vector, or a null or non-finite component take no part; vectors of different lengths
    are never compared. Ties go to the smaller id. A repeated id with the same vector counts once; other rows of one
    id count each. Queries and rows are cut into blocks and every pair of blocks is one task's cell, so neither side is
    broadcast; a cell holds about query_block + row_block vectors whatever the size of the table.
    """
    spark = vectors.sparkSession
    rows = materialise(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("v"),
                                      F.coalesce(queries, F.lit(False)).alias("asks"))
                       .filter("vec_id is not null and v is not null").dropDuplicates(["vec_id", "v"]))
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    r, s = max(1, -(-total // row_block)), max(1, -(-asking // query_block))
    part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(r)).cast("int")
    ask = F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(s)).cast("int")
    size = F.size("v").alias("size")
    base = rows.select(F.explode(F.sequence(F.lit(0), F.lit(s - 1))).alias("qb"), part.alias("rb"), size, F.lit(False).alias("ask"), "vec_id", "v")
    asks = rows.filter("asks").select(ask.alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(r - 1))).alias("rb"), size, F.lit(True).alias("ask"), "vec_id", "v")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        width = group["size"][0].as_py()
        ids = group["vec_id"].to_numpy()
        values = group["v"].chunk(0).flatten().to_numpy(zero_copy_only=False) if len(ids) else np.empty(0)
        v = values.astype(np.int64).reshape(len(ids), width)
        ask = group["ask"].to_numpy(zero_copy_only=False).astype(bool)
        out: list[list] = [[], [], []]
        for query_id, vec_id, score in best_of_cell(ids[ask], v[ask], ids[~ask], v[~ask], k):
            out[0] += [query_id] * len(vec_id)
            out[1] += vec_id.tolist()
            out[2] += score.tolist()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    found = base.unionByName(asks).groupBy("qb", "rb", "size").applyInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
