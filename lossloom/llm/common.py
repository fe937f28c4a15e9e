"""Helpers that several operators share: tables, words, folds, Arrow passes, connected components, cells of a similarity join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.session import materialise, trimmed

# White space that separates words: blank and the control characters tab to carriage return. bytes.split() uses the same six.
WORD_BREAK = r"[\x20\x09-\x0D]+"
FOLDS = 5
# Children per node of the trees that stand for a group of linked rows: small degrees, few rounds.
TREE_WIDTH = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(FOLDS)


def lower_ascii(text: Column) -> Column:
    """Lower case for A to Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def as_bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_pass(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict | None]]) -> DataFrame:
    """Run `make()` once per task; the function it returns maps the columns of a batch to output columns.

    A final call with an empty dict lets it give out what it has kept.
    """
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for piece in slices(batch):
                out = step({name: piece.column(i).to_pylist() for i, name in enumerate(piece.schema.names)})
                if out is not None:
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)
        out = step({})
        if out is not None:
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, target)


def slices(batch: pa.RecordBatch, limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `limit` bytes, so that Python objects of few rows exist at a time."""
    rows = batch.num_rows
    if rows:
        step = max(1, int(rows * limit / max(limit, batch.nbytes)))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def tree_edges(members: list) -> Iterator[tuple]:
    """Edges that connect `members` (sorted) with at most TREE_WIDTH + 1 edges a node."""
    for k in range(1, len(members)):
        yield members[k], members[(k - 1) // TREE_WIDTH]


@trimmed
def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges(a, b)`; component is the smallest node that can be reached.

    Each round takes the smallest label of the neighbours, hooks the parent under it and jumps to the parent's
    label, so rounds grow with the logarithm of the diameter. Labels are written after every round: lineage stays
    short, and both inputs of every join are plain tables, whose skewed partitions adaptive execution splits.
    """
    edges = materialise(edges.select("a", "b").filter("a <> b").distinct())
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = materialise(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("near")))
        hooks = step.groupBy(F.col("label").alias("node")).agg(F.min("near").alias("hook"))
        hooked = materialise(step.join(hooks, "node", "left").select(
            "node", "label", F.least("near", F.coalesce("hook", "near")).alias("next")))
        parents = hooked.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        moved = materialise(hooked.join(parents, "next", "left").select(
            "node", F.coalesce("jump", "next").alias("label"), F.col("label").alias("old")))
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")


def cells(keyed: DataFrame, spread: Column, block: int) -> DataFrame:
    """Rows of `keyed(key, ...)` that share a key with another row, dealt to cells of at most about 2 * `block` rows.

    A key with up to `block` rows is one cell. A larger one is cut by `spread` (a hash of the row) into s blocks and
    every pair of blocks becomes a cell, so each pair of its rows meets in one and no cell grows with the key.
    `keyed` must be a written table: it is read twice, and its join with the counts can then split a hot key.
    """
    counts = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    dealt = keyed.join(counts, "key").withColumn("s", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    own = F.pmod(spread, F.col("s")).cast("int")
    others = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("s") - 1), lambda j: j != own),
        lambda j: F.xxhash64(F.col("key"), F.least(own, j), F.greatest(own, j)))
    one = F.array(F.xxhash64(F.col("key"), F.lit(0), F.lit(0)))
    # The hash only groups: two cells with one hash are kept apart by the key, and meet with no loss otherwise.
    return dealt.withColumn("cell", F.explode(F.when(F.col("s") == 1, one).otherwise(others))).drop("n", "s")


def by_cell(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Rows of a cell next to each other in one task."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, "cell").sortWithinPartitions("cell", "key")
