"""Exact nearest neighbours as a distributed join.

Points are assigned to the nearest of a bounded set of pivots. An upper bound on the neighbour distance inside each
cell follows from the pivots, and a point travels only to the cells its distance allows (triangle inequality), so
the result is exact. Equal vectors are merged first, so a large group of copies costs one vector. Cells are cut
into blocks of bounded size; a block returns k candidates per point, never all pairs.

The points that would travel are counted first, and they travel in rounds of a few times the table, so the disk that
shuffles take does not grow faster than the table. Where the pivots part little (vectors of many components that lie about
equally far from each other), every pair of blocks meets once instead: the work is quadratic then, as exact neighbours of such
vectors are, but vectors are shuffled once, into a table of packed blocks, and a task reads two parts of that table. What
the tasks give out is k candidates per point and part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossloom.session import materialise, materialise_all, setting, trimmed

PIVOT_LIMIT = 1024
BLOCK = 2048
# Components of a block where all pairs of blocks meet: 4 MB of doubles; rows and columns compared and rows sent at once.
BLOCK_COMPONENTS = 1 << 19
STEP = 512
WIDE = 1024
SENT = 8192
# Bytes of vectors in a part of the table of blocks; a task holds one part and streams another.
PART_BYTES = 64 << 20
# Rows that a round sends to cells, as a multiple of all vectors.
ROUND = 4


def _smallest(df: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """The k first rows of each group; Spark limits each group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= k).drop("__rank")


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squared, 0.0))


def _slack(points: np.ndarray) -> float:
    """Allowance for rounding when distances are compared with bounds."""
    return 1e-6 * (1.0 + float(np.abs(points).max(initial=0.0)))


def _points(column) -> np.ndarray:
    """Rows of an Arrow list column as a matrix."""
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class _Found:
    """The k nearest that each of some points has met so far, ties by id."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids = ids
        self.distance = np.full((len(ids), k), np.inf)
        self.other = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, distance: np.ndarray, other: np.ndarray) -> None:
        near = distance <= self.distance[rows, -1]
        rows, distance, other = rows[near], distance[near], other[near]
        if not len(rows):
            return
        k = self.distance.shape[1]
        changed = np.unique(rows)
        rows = np.concatenate([np.repeat(changed, k), rows])
        distance = np.concatenate([self.distance[changed].ravel(), distance])
        other = np.concatenate([self.other[changed].ravel(), other])
        order = np.lexsort((other, distance, rows))
        first = order[np.searchsorted(rows[order], changed)[:, None] + np.arange(k)]
        self.distance[changed], self.other[changed] = distance[first], other[first]

    def columns(self) -> dict[str, np.ndarray]:
        rows, at = np.nonzero(np.isfinite(self.distance))
        return {"vid": self.ids[rows], "nvid": self.other[rows, at], "distance": self.distance[rows, at]}


def _bounds(found: _Found, part: slice, away: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Squared distance beyond which no row of `away` has one of its k nearest. A point may meet itself once."""
    with np.errstate(over="ignore"):
        limit = (found.distance[part, -1] ** 2 + slack).astype(away.dtype)
    new = np.flatnonzero(np.isinf(limit))
    if len(new) and away.shape[1] > k:
        limit[new] = np.partition(away[new], k, axis=1)[:, k] + away.dtype.type(slack)
        limit[np.isnan(limit)] = np.inf
    return limit


def _true_at(mask: np.ndarray) -> np.ndarray:
    """Positions of the few true cells of a flat mask; eight cells are looked at together."""
    if mask.size % 8:
        return np.flatnonzero(mask)
    words = np.flatnonzero(mask.view(np.uint64))
    word, byte = np.nonzero(mask.reshape(-1, 8)[words])
    return words[word] * 8 + byte


def _meet(points: np.ndarray, found: _Found, others: np.ndarray, other_found: _Found, both: bool) -> None:
    """Points meet others and keep their k nearest; if `both`, the others keep theirs too.

    Squared distances come from one product of matrices in single precision, STEP x WIDE at a time; what they and their
    rounding do not exclude is computed exactly. Where single precision excludes too little, double precision goes on.
    """
    if not len(points) or not len(others):
        return
    k, width = found.distance.shape[1], points.shape[1]
    squares, other_squares = (points**2).sum(1), (others**2).sum(1)
    scale = sum(math.sqrt(s[np.isfinite(s)].max(initial=0.0)) for s in (squares, other_squares)) ** 2

    def prepared(kind: type) -> tuple[np.ndarray, np.ndarray, float]:
        left = np.column_stack([-2 * points, squares, np.ones(len(points))]).astype(kind)
        right = np.ascontiguousarray(np.column_stack([others, np.ones(len(others)), other_squares]).T.astype(kind))
        return left, right, 2 * (width + 8) * float(np.finfo(kind).eps) * scale + float(np.finfo(kind).tiny)

    single = 1e-30 < scale < 1e30
    with np.errstate(invalid="ignore", over="ignore"):
        left, right, slack = prepared(np.float32 if single else np.float64)
        for s in range(0, len(points), STEP):
            for c in range(0, len(others), WIDE):
                mine, theirs = slice(s, s + STEP), slice(c, c + WIDE)
                while True:
                    away = left[mine] @ right[:, theirs]
                    mask = away <= _bounds(found, mine, away, k, slack)[:, None]
                    if both:
                        mask |= away <= _bounds(other_found, theirs, away.T, k, slack)[None, :]
                    at = _true_at(mask.ravel())
                    if not single or len(at) <= mask.size // 16 + 4 * (k + 1) * sum(mask.shape):
                        break
                    single = False
                    left, right, slack = prepared(np.float64)
                rows, columns = np.divmod(at, mask.shape[1])
                for h in range(0, len(at), SENT):
                    r, q = s + rows[h:h + SENT], c + columns[h:h + SENT]
                    exact = np.sqrt(((points[r] - others[q]) ** 2).sum(1))
                    use = (found.ids[r] != other_found.ids[q]) & np.isfinite(exact)
                    r, q, exact = r[use], q[use], exact[use]
                    found.add(r, exact, other_found.ids[q])
                    if both:
                        other_found.add(q, exact, found.ids[r])


def packed_blocks(vectors: DataFrame, blocks: int) -> DataFrame:
    """(block, ids, points): about `blocks` rows, each with the ids and vectors of a block as bytes. A block is named by one of its ids."""
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    size = math.ceil(n / blocks)
    parts = max(math.ceil(8 * n * (width or 1) / PART_BYTES), min(blocks, vectors.sparkSession.sparkContext.defaultParallelism))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(count: int) -> pa.RecordBatch:
            nonlocal held
            table = pa.Table.from_batches(held).combine_chunks()
            ids, points = table["vid"][:count].to_numpy(), _points(table["vec"][:count].combine_chunks())
            held = table[count:].to_batches()
            return pa.RecordBatch.from_pydict({
                "block": pa.array([ids[0]], pa.int64()), "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                "points": pa.array([points.astype(np.float64).tobytes()], pa.binary())})

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                yield row(size)
        if any(b.num_rows for b in held):
            yield row(size)

    return materialise(vectors.select("vid", "vec").repartition(parts, "vid").mapInArrow(pack, "block bigint, ids binary, points binary"))


def block_pairs(vectors: DataFrame, k: int, blocks: int) -> DataFrame:
    """(vid, nvid, distance): the k nearest of every vector; all pairs of about `blocks` blocks meet once, for both sides.

    Vectors are shuffled once, into a table of blocks. A task takes two parts of that table and gives out k candidates for each of their vectors.
    """
    packed = packed_blocks(vectors, blocks)
    others = packed.select(F.col("block").alias("other"), F.col("ids").alias("other_ids"), F.col("points").alias("other_points"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, _Found] = {}

        def side(batch: pa.RecordBatch, i: int, name: str, ids: str, points: str) -> tuple[int, np.ndarray]:
            block, own = batch[name][i].as_py(), np.frombuffer(batch[ids][i].as_buffer(), np.int64)
            if block not in met:
                met[block] = _Found(own.copy(), k)
            return block, np.frombuffer(batch[points][i].as_buffer(), np.float64).reshape(len(own), -1)

        for batch in batches:
            for i in range(batch.num_rows):
                a, points = side(batch, i, "block", "ids", "points")
                b, other_points = side(batch, i, "other", "other_ids", "other_points")
                _meet(points, met[a], other_points, met[b], both=a != b)
        for found in met.values():
            columns = found.columns()
            for s in range(0, len(columns["vid"]), SENT):
                yield pa.RecordBatch.from_pydict({name: values[s:s + SENT] for name, values in columns.items()})

    pairs = packed.hint("shuffle_replicate_nl").crossJoin(others).filter("block <= other")
    found = pairs.mapInArrow(meet, "vid bigint, nvid bigint, distance double")
    # Files are not read together beyond a part, so that what a task holds does not depend on the session.
    with setting(vectors.sparkSession, "spark.sql.files.maxPartitionBytes", str(PART_BYTES)):
        return materialise(_smallest(found, "vid", ["distance", "nvid"], k))


@trimmed
def nearest_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(vid, nvid, distance): the k nearest other vectors of each, ties by nvid. `vectors`: distinct vid, vec."""
    n = vectors.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "vid bigint, nvid bigint, distance double")
    wanted = min(PIVOT_LIMIT, max(1, math.isqrt(n)))
    chosen = vectors.orderBy(F.xxhash64("vid"), "vid").limit(wanted).collect()
    pivots = np.array([r["vec"] for r in chosen])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch["vec"])
            cell, least = np.zeros(len(points), dtype="int32"), np.zeros(len(points))
            for s in range(0, len(points), STEP):
                away = _distances(points[s:s + STEP], pivots)
                cell[s:s + STEP], least[s:s + STEP] = away.argmin(1), away.min(1)
            yield pa.RecordBatch.from_arrays([batch["vid"], batch["vec"], pa.array(cell), pa.array(least)], ["vid", "vec", "cell", "away"])

    placed = materialise(vectors.select("vid", "vec").mapInArrow(assign, "vid bigint, vec array<double>, cell int, away double"))
    reach = np.zeros(len(pivots))
    sizes = np.zeros(len(pivots), dtype=np.int64)
    for r in placed.groupBy("cell").agg(F.max("away").alias("far"), F.count(F.lit(1)).alias("n")).collect():
        reach[r["cell"]], sizes[r["cell"]] = r["far"], r["n"]
    close = np.full((len(pivots), k + 1), np.inf)
    near = _smallest(placed.select("cell", "away", "vid"), "cell", ["away", "vid"], k + 1)
    for r in near.groupBy("cell").agg(F.sort_array(F.collect_list("away")).alias("a")).collect():
        close[r["cell"], : len(r["a"])] = r["a"]
    between = _distances(pivots, pivots)
    bound = np.array([
        reach[i] + np.partition((between[i][:, None] + close).ravel(), min(k, close.size - 1))[min(k, close.size - 1)]
        for i in range(len(pivots))])
    allowed = reach + bound + _slack(pivots)

    def reached(vecs: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the vectors reach which of the cells."""
        rows, at = np.nonzero(_distances(vecs, pivots[cells]) <= allowed[None, cells])
        return rows, cells[at]

    def count_sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pivots), dtype=np.int64)
        for batch in batches:
            points = _points(batch["vec"])
            for s in range(0, len(points), STEP):
                total += np.bincount(reached(points[s:s + STEP], everywhere)[1], minlength=len(pivots))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": cells.astype("int32"), "n": total[cells]})

    everywhere = np.flatnonzero(sizes > 0)
    reaching = placed.select("vec").mapInArrow(count_sent, "cell int, n bigint")
    counts = {r["cell"]: r["n"] for r in reaching.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    query_blocks = {c: math.ceil(int(sizes[c]) / BLOCK) for c in counts}
    # Rows sent so that one block of a cell's vectors meets all vectors that reach the cell.
    copies = {c: m + math.ceil(int(sizes[c]) / query_blocks[c]) * math.ceil(m / BLOCK) for c, m in counts.items()}
    compared = sum(int(sizes[c]) * m for c, m in counts.items())
    # A row sent costs about as much as BLOCK rows compared. A cell that nothing reaches has vectors without distances.
    if len(counts) < len(everywhere) or compared + BLOCK * sum(copies[c] * query_blocks[c] for c in counts) > n * n:
        block = min(4 * BLOCK, max(BLOCK, BLOCK_COMPONENTS // max(1, pivots.shape[1])))
        return block_pairs(placed.select("vid", "vec"), k, math.ceil(n / block))

    def nearest_in(ranges: dict[int, tuple[int, int]]) -> DataFrame:
        """(vid, nvid, distance): the k nearest of the vectors in some blocks (first, last) of some cells; all that can be one are sent there."""
        here = np.array(list(ranges))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = _points(batch["vec"])
                for s in range(0, len(points), STEP):
                    rows, to = reached(points[s:s + STEP], here)
                    for at in range(0, len(rows), SENT):
                        r = pa.array(s + rows[at:at + SENT])
                        yield pa.RecordBatch.from_arrays([batch["vid"].take(r), batch["vec"].take(r), pa.array(to[at:at + SENT].astype("int32"))],
                                                         ["vid", "vec", "cell"])

        def by_cell(value: Callable[[int], int]) -> Column:
            return F.try_element_at(F.create_map(*[F.lit(x) for c in ranges for x in (c, value(c))]), F.col("cell"))

        def block_of(blocks: Column) -> Column:
            return F.pmod(F.xxhash64("vid"), blocks).cast("int")

        blocks, first, last = by_cell(lambda c: math.ceil(counts[c] / BLOCK)), by_cell(lambda c: ranges[c][0]), by_cell(lambda c: ranges[c][1])
        own = placed.filter(F.col("cell").isin(list(ranges))).withColumn("qb", block_of(by_cell(query_blocks.get))).filter(F.col("qb").between(first, last))
        queries = own.select("vid", "vec", "cell", "qb", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("cb"))
        sent = placed.select("vid", "vec").mapInArrow(send, "vid bigint, vec array<double>, cell int")
        candidates = sent.select("vid", "vec", "cell", block_of(blocks).alias("cb"), F.explode(F.sequence(first, last)).alias("qb"))

        def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found, others = _Found(left["vid"].to_numpy(), k), _Found(right["vid"].to_numpy(), k)
            if len(left) and len(right):
                _meet(np.array(left["vec"].tolist()), found, np.array(right["vec"].tolist()), others, both=False)
            return pd.DataFrame(found.columns())

        keys = ["cell", "qb", "cb"]
        found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(best, "vid bigint, nvid bigint, distance double")
        return _smallest(found, "vid", ["distance", "nvid"], k)

    rounds, filled = [{}], 0
    for c in sorted(counts):
        for q in range(query_blocks[c]):
            if filled and filled + copies[c] > ROUND * n:
                rounds.append({})
                filled = 0
            rounds[-1][c] = (rounds[-1].get(c, (q, q))[0], q)
            filled += copies[c]
    return materialise_all(nearest_in(ranges) for ranges in rounds)


def nearest_neighbours(points: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(key, neighbour, distance, rank): the k nearest other points of each, ties by neighbour id.

    Copies are neighbours at distance 0. Per distinct vector only its k + 1 smallest ids can be neighbours.
    """
    rows = points.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    ids = (
        _smallest(rows, "vec", ["id"], k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("vid"), "vec", "ids")
    )
    groups = materialise(ids)
    near = nearest_vectors(groups.select("vid", "vec"), k)
    others = (
        near.join(groups.select(F.col("vid").alias("nvid"), F.col("ids").alias("nids")), "nvid")
        .select("vid", F.explode("nids").alias("neighbour"), "distance")
    )
    own = groups.select("vid", F.explode("ids").alias("neighbour"), F.lit(0.0).alias("distance"))
    # k + 1, because a point may find itself among the copies of its vector.
    lists = (
        _smallest(own.unionByName(others), "vid", ["distance", "neighbour"], k + 1)
        .groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbour"))).alias("list"))
    )
    member = rows.join(groups.select("vec", "vid"), "vec").select("id", "vid").join(lists, "vid")
    kept = F.slice(F.filter("list", lambda e: e["neighbour"] != F.col("id")), 1, k)
    ranked = member.withColumn("kept", kept).select("id", F.posexplode("kept").alias("at", "e"))
    return ranked.select("id", "e.neighbour", "e.distance", (F.col("at") + 1).alias("rank")).withColumnRenamed("id", key)


def uniform(*parts: Column) -> Column:
    """Number in [0, 1) decided by the given columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def oversample(df: DataFrame, key: str, vector: str, label: str, minority, k: int = 5, seed: int = 1) -> DataFrame:
    """Synthetic minority points until both classes are equal: (source, neighbour, copy, vector, label).

    Each lies between a minority point and one of its k nearest minority neighbours. Copies are dealt evenly; which
    points get one more is decided by an exact cut on a hash of the key.
    """
    from lossloom.operators.ordering import order_statistics

    sizes = df.agg(F.count_if(F.col(label) == minority).alias("few"), F.count_if(F.col(label) != minority).alias("many")).first()
    missing = sizes["many"] - sizes["few"]
    few = df.filter(F.col(label) == minority).select(F.col(key).cast("bigint").alias(key), F.col(vector).cast("array<double>").alias(vector))
    each, extra = divmod(max(missing, 0), max(sizes["few"], 1))
    spread = F.xxhash64(key, F.lit(seed))
    cut = order_statistics(few, {"cut": (spread, lambda n: extra - 1)}, value_type="bigint")["cut"]
    copies = F.lit(each) if cut is None else F.lit(each) + (spread <= F.lit(cut)).cast("int")
    near = nearest_neighbours(few, key, vector, min(k, max(sizes["few"] - 1, 1)))
    ends = few.select(F.col(key).alias("neighbour"), F.col(vector).alias("__end"))
    lists = near.join(ends, "neighbour").groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("rank", "neighbour", "__end"))).alias("__list"))
    drawn = (
        few.join(lists, key).withColumn("__copies", copies).filter("__copies > 0")
        .select(key, vector, "__list", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("copy"))
    )
    pick = F.get("__list", F.pmod(F.xxhash64(key, "copy", F.lit(seed + 1)), F.size("__list")).cast("int"))
    share = uniform(F.col(key), F.col("copy"), F.lit(seed + 2))
    chosen = drawn.select(F.col(key).alias("source"), "copy", vector, pick.alias("__to"), share.alias("__u"))
    between = F.zip_with(vector, F.col("__to.__end"), lambda a, b: a + F.col("__u") * (b - a))
    return chosen.select("source", F.col("__to.neighbour").alias("neighbour"), "copy", between.alias(vector), F.lit(minority).alias(label))


def tomek_links(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(first, second): mutual nearest neighbours of different classes. A pair is mutual when it is found twice."""
    near = nearest_neighbours(df, key, vector, 1).join(df.select(F.col(key).cast("bigint").alias(key), label), key)
    return (
        near.groupBy(F.least(key, "neighbour").alias("first"), F.greatest(key, "neighbour").alias("second"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(label).alias("a"), F.max(label).alias("b"))
        .filter("n = 2 and a <> b").select("first", "second")
    )


@trimmed
def without_tomek_links(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Both ends of every link are removed."""
    # Written, so that the tables and shuffles of the search are gone when the rows are read again.
    links = materialise(tomek_links(df, key, vector, label))
    ends = links.select(F.explode(F.array("first", "second")).alias(key))
    return df.join(ends, key, "left_anti")


@trimmed
def _with_synthetic(df: DataFrame, key: str, vector: str, label: str, minority, k: int, seed: int) -> DataFrame:
    """(key, vector, label, synthetic), written once: the given points and those that over-sampling makes."""
    original = df.select(F.col(key).cast("bigint").alias(key), F.col(vector).cast("array<double>").alias(vector), label,
                         F.lit(0).alias("synthetic"))
    # Read twice: written, so that the neighbour search runs once.
    made = materialise(oversample(df, key, vector, label, minority, k, seed))
    most = made.agg(F.max("copy")).first()[0] or 1
    renamed = made.select((-(F.col("source") * F.lit(most) + F.col("copy")) - 1).alias(key), vector, label, F.lit(1).alias("synthetic"))
    return materialise(original.unionByName(renamed))


def balance(df: DataFrame, key: str, vector: str, label: str, minority, k: int = 5, seed: int = 1) -> DataFrame:
    """Over-sample the minority, then remove Tomek links: (key, vector, label, synthetic).

    Synthetic points get negative keys made from their source and copy number, unique by construction.
    """
    return without_tomek_links(_with_synthetic(df, key, vector, label, minority, k, seed), key, vector, label)
