"""Online variational Bayes for latent Dirichlet allocation, where a step reads the documents of its own chunks and no others.

The update rules are those of Spark's online optimizer (Hoffman, Blei and Bach 2010; document concentration by Newton steps), whose steps
each sample the whole corpus. Here documents are dealt to pieces once, and a step is a job over its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.session import materialise

# Settings of Spark's online optimizer: slow start, decay, and the mean change at which a document is done.
START, DECAY, SETTLED = 1024.0, 0.51, 1e-3
# A corpus of more than STEPS chunks takes up to WORKERS chunks a step, as the multicore model with 12 workers does.
STEPS, WORKERS = 100, 12
# Numbers of one work table inside a task.
CELLS = 2_000_000


def digamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    for k in range(6):
        shift += 1 / (x + k)
    y = x + 6
    s = 1 / (y * y)
    return np.log(y) - 0.5 / y - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s / 240))) - shift


def trigamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    for k in range(6):
        shift += 1 / (x + k) ** 2
    y = x + 6
    s = 1 / (y * y)
    return 1 / y + s / 2 + s / y * (1 / 6 - s * (1 / 30 - s * (1 / 42 - s / 30))) + shift


def expected_logs(weights: np.ndarray) -> np.ndarray:
    return digamma(weights) - digamma(weights.sum(axis=-1, keepdims=True))


def document_weights(flat: np.ndarray, amounts: np.ndarray, sizes: np.ndarray, terms: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(topic weights of each document, theta x count / norm of each entry) for non-empty sparse rows; `terms` is terms x topics."""
    gamma = np.ones((len(sizes), len(alpha)))
    shares = np.empty((len(flat), len(alpha)))
    part, left, rows, counts = terms[flat], np.arange(len(sizes)), np.repeat(np.arange(len(sizes)), sizes), amounts
    entries, lengths = np.arange(len(flat)), sizes
    while len(left):
        theta = np.exp(expected_logs(gamma[left]))
        spread = theta[rows]
        norm = np.einsum("ij,ij->i", part, spread) + 1e-100
        found = alpha + theta * np.add.reduceat(part * (counts / norm)[:, None], np.cumsum(lengths) - lengths, axis=0)
        done = np.abs(found - gamma[left]).mean(axis=1) <= SETTLED
        gamma[left] = found
        if done.any():
            out = done[rows]
            last = np.exp(expected_logs(found[done]))[np.repeat(np.arange(done.sum()), lengths[done])]
            shares[entries[out]] = last * (counts[out] / (np.einsum("ij,ij->i", part[out], last) + 1e-100))[:, None]
            left, lengths = left[~done], lengths[~done]
            part, counts, entries = part[~out], counts[~out], entries[~out]
            rows = np.repeat(np.arange(len(left)), lengths)
    return gamma, shares


def _blocks(sizes: np.ndarray, topics: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, first entry, end entry) of blocks whose work tables are small; a long row is a block of its own."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = int(ends[start] - sizes[start])
        stop = max(start + 1, int(np.searchsorted(ends, before + CELLS // topics, "right")))
        yield start, stop, before, int(ends[stop - 1])
        start = stop


def _flat(indices: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = pc.fill_null(pc.list_value_length(indices), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return (indices.flatten().to_numpy(zero_copy_only=False).astype(np.int32), values.flatten().to_numpy(zero_copy_only=False).astype(np.float64), sizes)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            flat, amounts, sizes = _flat(batch.column("indices"), batch.column("values"))
            yield pa.RecordBatch.from_pydict({"flat": [flat.tobytes()], "amounts": [amounts.tobytes()], "sizes": [sizes.tobytes()]})


class TopicModel:
    """Topics as Dirichlet weights over terms (topics x terms), with the weights of topics in a document.

    It has the methods of Spark's LDA models that this package uses; transform() makes the shares of a document from its row alone.
    """

    def __init__(self, weights: np.ndarray, alpha: np.ndarray, features: str = "features", output: str = "topics", steps: int = 0):
        self.weights, self.alpha, self.features, self.output, self.steps = weights, alpha, features, output, steps

    def getK(self) -> int:
        return len(self.weights)

    def getTopicDistributionCol(self) -> str:
        return self.output

    def vocabSize(self) -> int:
        return self.weights.shape[1]

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Shares add up to one; a document without a known term has zeros."""
        terms, alpha = np.exp(expected_logs(self.weights)).T.copy(), self.alpha

        @F.arrow_udf("array<double>")
        def shares(indices: pa.Array, values: pa.Array) -> pa.Array:
            flat, amounts, sizes = _flat(indices, values)
            out = np.zeros((len(sizes), len(alpha)))
            filled = np.flatnonzero(sizes)
            for a, b, first, end in _blocks(sizes[filled], len(alpha)):
                gamma, _ = document_weights(flat[first:end], amounts[first:end], sizes[filled[a:b]], terms, alpha)
                out[filled[a:b]] = gamma / gamma.sum(axis=1, keepdims=True)
            return pa.ListArray.from_arrays(np.arange(0, out.size + 1, len(alpha), dtype=np.int32), out.ravel())

        raw = F.unwrap_udt(self.features)
        return vectors.withColumn(self.output, array_to_vector(shares(raw["indices"], raw["values"])))

    def describeTopics(self, maxTermsPerTopic: int = 10) -> DataFrame:
        shares = self.weights / self.weights.sum(axis=1, keepdims=True)
        heaviest = np.argsort(-shares, axis=1, kind="stable")[:, :maxTermsPerTopic]
        rows = [(t, at.tolist(), shares[t, at].tolist()) for t, at in enumerate(heaviest)]
        return SparkSession.getActiveSession().createDataFrame(rows, "topic int, termIndices array<int>, termWeights array<double>")

    def write(self) -> MLWriter:
        return _Writer(self)

    @staticmethod
    def load(path: str) -> TopicModel:
        rows = SparkSession.getActiveSession().read.parquet(path).orderBy("topic").collect()
        return TopicModel(np.array([r["weights"] for r in rows]), np.array([r["alpha"] for r in rows]), rows[0]["features"], rows[0]["output"], rows[0]["steps"])


class _Writer(MLWriter):
    """One row a topic."""

    def __init__(self, model: TopicModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        rows = [(t, w.tolist(), float(a), m.features, m.output, m.steps) for t, (w, a) in enumerate(zip(m.weights, m.alpha))]
        table = self.sparkSession.createDataFrame(rows, "topic int, weights array<double>, alpha double, features string, output string, steps int")
        table.coalesce(1).write.parquet(path)


def piece_sums(weights: np.ndarray, alpha: np.ndarray):
    """Task of a step: (sums of topics x terms, sum of expected log shares, documents, documents with a term) of its pieces."""
    terms = np.exp(expected_logs(weights)).T.copy()
    topics, width = weights.shape

    def run(rows: Iterator) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
        sums, logs, seen, used = np.zeros((topics, width)), np.zeros(topics), 0, 0
        for row in rows:
            flat, amounts, sizes = np.frombuffer(row[0], np.int32), np.frombuffer(row[1]), np.frombuffer(row[2], np.int64)
            seen += len(sizes)
            sizes = sizes[sizes > 0]
            used += len(sizes)
            for a, b, first, end in _blocks(sizes, topics):
                gamma, shares = document_weights(flat[first:end], amounts[first:end], sizes[a:b], terms, alpha)
                logs += expected_logs(gamma).sum(axis=0)
                for t in range(topics):
                    sums[t] += np.bincount(flat[first:end], weights=shares[:, t], minlength=width)
        yield sums, logs, seen, used

    return run


def moved_alpha(alpha: np.ndarray, logs: np.ndarray, used: int, weight: float) -> np.ndarray:
    """One Newton step for the weights of topics in a document, if they stay above zero."""
    gradient = used * (logs / used - expected_logs(alpha))
    c, q = used * trigamma(np.array([alpha.sum()]))[0], -used * trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - weight * (gradient - b) / q
    return moved if (moved > 0).all() else alpha


def fit(vectors: DataFrame, vector: str, topics: int, passes: int, chunk: int, documents: int | None = None, seed: int = 1) -> TopicModel:
    """Topics after `passes` passes over all documents, in steps of `chunk` documents.

    Documents are dealt evenly to pieces, of which a chunk has one to four, and kept by the executors (on disk where memory is short). Each pass takes every chunk once,
    in an order drawn anew. A corpus of more than STEPS chunks takes several chunks a step, up to WORKERS, that see the same topics; such a step moves
    the topics by as much as its chunks would one after the other. The driver holds topics x terms numbers.
    """
    spark = vectors.sparkSession
    stored = materialise(vectors.select(F.unwrap_udt(vector).alias("v")).select("v.size", "v.indices", "v.values"))
    count = stored.count()
    if not count:
        raise ValueError("no documents to fit topics on")
    width = stored.agg(F.max("size")).first()[0]
    chunks = -(-count // chunk)
    together = min(WORKERS, max(1, chunks // STEPS))
    each = min(4, max(1, -(-spark.sparkContext.defaultParallelism // together)))
    packed = stored.select("indices", "values").repartition(chunks * each).mapInArrow(_pack, "flat binary, amounts binary, sizes binary")
    pieces = packed.rdd.map(lambda r: (bytes(r[0]), bytes(r[1]), bytes(r[2]))).persist(StorageLevel.MEMORY_AND_DISK)
    order = np.random.default_rng(seed)
    weights, alpha, clock, steps = order.gamma(100.0, 0.01, (topics, width)), np.full(topics, 1 / topics), 0, 0
    total = documents or count
    try:
        for _ in range(passes):
            turn = order.permutation(chunks)
            for at in range(0, chunks, together):
                mine = turn[at:at + together]
                numbers = [int(c) * each + k for c in mine for k in range(each)]
                found = spark.sparkContext.runJob(pieces, piece_sums(weights, alpha), numbers)
                sums, logs, seen, used = (sum(x) for x in zip(*found))
                clock, steps = clock + len(mine), steps + 1
                if used:
                    weight = 1 - (1 - (START + clock) ** -DECAY) ** len(mine)
                    target = sums * np.exp(expected_logs(weights)) * (total / seen) + 1 / topics
                    weights = (1 - weight) * weights + weight * target
                    alpha = moved_alpha(alpha, logs, used, weight)
    finally:
        pieces.unpersist()
    return TopicModel(weights, alpha, vector, "topics", steps)
