"""Topic models over term vectors: LDA, non-negative factors, and topic shares per claim."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.operators import online_lda
from lossloom.operators.online_lda import TopicModel
from lossloom.session import materialise

FACTOR_LIMIT = 20_000_000
TINY = 1e-12


def fit_lda(vectors: DataFrame, vector: str, topics: int = 30, passes: int = 10, chunk: int = 10_000,
            documents: int | None = None, seed: int = 1) -> TopicModel:
    """Online LDA: `passes` passes over the corpus in steps of `chunk` documents, each of which reads its own documents only.

    Time grows with passes * documents. See online_lda.fit().
    """
    return online_lda.fit(vectors, vector, topics, passes, chunk, documents, seed)


def topic_distribution(vectors: DataFrame, model: LDAModel | TopicModel, prefix: str = "TOPIC_NEW_") -> DataFrame:
    """One column per topic; new documents are encoded with the vocabulary the model was fitted on."""
    shares = model.transform(vectors).withColumn("__t", vector_to_array(model.getTopicDistributionCol()))
    return shares.select(*vectors.columns, *[F.col("__t")[i].alias(f"{prefix}{i}") for i in range(model.getK())])


def topic_terms(model: LDAModel | TopicModel, vocabulary: list[str], n: int = 10) -> DataFrame:
    """(topic, rank, term, weight) of the heaviest terms."""
    described = model.describeTopics(n)
    names = F.array(*[F.lit(t) for t in vocabulary])
    return described.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "e")
    ).select("topic", "rank", F.get(names, F.col("e.termIndices")).alias("term"), F.col("e.termWeights").alias("weight"))


@dataclass(frozen=True)
class TopicFactors:
    """Topics x terms matrix of a non-negative factorisation."""

    matrix: np.ndarray
    inner: int
    # How the fit went: passes over the documents, and the squared error of each pass.
    errors: tuple[float, ...] = ()

    def top_terms(self, terms: list[str], n: int = 20) -> list[list[str]]:
        return [[terms[i] for i in np.argsort(-row, kind="stable")[:n]] for row in self.matrix]


def _loadings(flat: np.ndarray, amounts: np.ndarray, sizes: np.ndarray, matrix: np.ndarray, inner: int) -> np.ndarray:
    """Loadings of a batch of sparse rows (flattened, with row sizes) for fixed topics by multiplicative updates."""
    product = np.zeros((len(sizes), len(matrix)))
    filled = sizes > 0
    if filled.any():
        part = matrix.T[flat] * amounts[:, None]
        product[filled] = np.add.reduceat(part, (np.cumsum(sizes) - sizes)[filled], axis=0)
    gram = matrix @ matrix.T
    loads = np.where(product > 0, 1.0, 0.0) * product.mean(axis=1, keepdims=True)
    for _ in range(inner):
        loads *= product / (loads @ gram + TINY)
    return loads


def topic_sweeps(matrix: np.ndarray, cross: np.ndarray, gram: np.ndarray, sweeps: int) -> np.ndarray:
    """Topics x terms after block-wise updates for fixed loadings, of which only the sums of a pass are needed.

    A sweep sets each topic in turn to its exact minimum given the others; sweeps end when they no longer move the matrix.
    """
    matrix = matrix.copy()
    for _ in range(sweeps):
        before = matrix.copy()
        for t in range(len(matrix)):
            if gram[t, t] > TINY:
                matrix[t] = np.maximum(matrix[t] + (cross[t] - gram[t] @ matrix) / gram[t, t], TINY)
        if np.abs(matrix - before).max() < 1e-6 * max(np.abs(matrix).max(), TINY):
            break
    return matrix


def fit_factors(vectors: DataFrame, vector: str, width: int, topics: int = 10, iterations: int = 500,
                tolerance: float = 1e-5, inner: int = 20, seed: int = 1, sweeps: int = 50) -> TopicFactors:
    """Non-negative factors of a sparse document x term matrix, zeros included.

    The loadings of a document follow from its row and the current topics alone, so they are recomputed inside each
    pass and never stored; a pass returns only the sums that update the topics x terms matrix, and its squared error. That matrix is
    bounded by topics * width and is all the driver holds. The sums of one pass serve up to `sweeps` block-wise updates of all topics.
    Passes end when the squared error has fallen by less than `tolerance` of itself in each of two passes, or after `iterations`; the topics with the
    least error are returned.
    """
    if topics * width > FACTOR_LIMIT:
        raise ValueError("topics * width is too large for the driver; limit the vocabulary")
    stored = materialise(vectors.select(F.unwrap_udt(vector).alias("v")).select("v.indices", "v.values"))
    matrix = np.random.default_rng(seed).uniform(0.1, 1.0, (topics, width))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    best, errors = matrix, []
    for _ in range(iterations):
        matrix_now = matrix

        def pass_sums(batches):
            cross, gram, square = np.zeros((topics, width)), np.zeros((topics, topics)), 0.0
            for batch in batches:
                indices, values = batch.column("indices"), batch.column("values")
                sizes = pc.list_value_length(indices).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = indices.flatten().to_numpy(zero_copy_only=False)
                amounts = values.flatten().to_numpy(zero_copy_only=False)
                loads = _loadings(flat, amounts, sizes, matrix_now, inner)
                gram += loads.T @ loads
                square += float(amounts @ amounts)
                spread = np.repeat(loads, sizes, axis=0) * amounts[:, None]
                for t in range(topics):
                    cross[t] += np.bincount(flat, weights=spread[:, t], minlength=width)
            yield pa.RecordBatch.from_pydict({"sums": [np.concatenate([cross.ravel(), gram.ravel(), [square]])]})

        partial = stored.mapInArrow(pass_sums, "sums array<double>").select(
            array_to_vector("sums").alias("sums"), F.pmod(F.spark_partition_id(), F.lit(64)).alias("slot"))
        folded = partial.groupBy("slot").agg(Summarizer.sum(F.col("sums")).alias("sums"))
        total = folded.agg(Summarizer.sum(F.col("sums")).alias("sums")).first()["sums"].toArray()
        cross, gram = total[: topics * width].reshape(topics, width), total[topics * width:-1].reshape(topics, topics)
        errors.append(float(total[-1] - 2 * (cross * matrix_now).sum() + (gram * (matrix_now @ matrix_now.T)).sum()))
        if errors[-1] <= min(errors):
            best = matrix_now
        if len(errors) > 2 and all(a - b < tolerance * max(a, TINY) for a, b in zip(errors[-3:-1], errors[-2:])):
            break
        matrix = topic_sweeps(matrix_now, cross, gram, sweeps)
        lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = matrix / np.where(lengths > 0, lengths, 1.0)
    return TopicFactors(best, inner, tuple(errors))


def factor_loadings(vectors: DataFrame, vector: str, factors: TopicFactors, name: str = "loadings") -> DataFrame:
    """Topic loadings of each document, old or new."""
    matrix, inner = factors.matrix, factors.inner

    @F.pandas_udf("array<double>")
    def loadings(indices: pd.Series, values: pd.Series) -> pd.Series:
        sizes = indices.map(len).to_numpy(dtype=np.int64)
        if not sizes.sum():
            return pd.Series([np.zeros(len(matrix))] * len(sizes))
        return pd.Series(list(_loadings(np.concatenate(indices.tolist()), np.concatenate(values.tolist()), sizes, matrix, inner)))

    raw = F.unwrap_udt(vector)
    return vectors.withColumn(name, loadings(raw["indices"], raw["values"]))


def topic_shares(loadings: DataFrame, key: str, column: str, topics: int, prefix: str) -> DataFrame:
    """Mean topic share per key. A document without any loading has no share; its key gets zeros."""
    total = F.aggregate(column, F.lit(0.0), lambda a, x: a + x)
    share = lambda i: F.coalesce(F.try_divide(F.col(column)[i], total), F.lit(float("nan")))
    spread = loadings.select(key, *[share(i).alias(f"{prefix}{i + 1}") for i in range(topics)])
    return spread.groupBy(key).agg(*[
        F.nanvl(F.avg(f"{prefix}{i + 1}"), F.lit(0.0)).alias(f"{prefix}{i + 1}") for i in range(topics)])


def top_topic_terms(shares: DataFrame, k: int) -> DataFrame:
    """Heaviest `k` entries of each (topic, values array) row, inside the row."""
    from lossloom.functions.maths import largest_components

    return shares.select("topic", F.posexplode(largest_components(F.col("values"), k)).alias("rank", "e")).select(
        "topic", "rank", "e.pos", "e.value")
