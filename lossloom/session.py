"""Session defaults and the one place where intermediate results are written out."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "lossloom", master: str | None = None, **options: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC; extra options win."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's `spark.checkpoint.dir`.

    Only a local master may fall back to a fresh temporary folder. On a cluster a missing setting is an
    error, because a folder of one machine would be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="lossloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


# Scratch paths of this process that have not been removed yet.
_scratch: list[str] = []


def _hadoop_path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the checkpoint folder; never reused, so runs cannot overwrite each other. A surrounding `scratch` block removes it."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def release(spark: SparkSession, keep: int = 0) -> None:
    """Remove the scratch paths made since there were `keep` of them. Frames read from them cannot be computed any more."""
    while len(_scratch) > keep:
        at, files = _hadoop_path(spark, _scratch.pop())
        files.delete(at, True)
        files.cancelDeleteOnExit(at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of the block are removed at its end, also after an error: write or collect the result inside.

    Blocks can be nested; a block leaves what was made before it. Jobs that run at the same time in several threads should share one block.
    """
    before = len(_scratch)
    try:
        yield
    finally:
        release(spark, before)


def trimmed(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Of the intermediate tables that an operator makes, only those that its result reads outlive the call.

    Tables made before the call stay. Operators that run at the same time in several threads must not be trimmed.
    """

    @wraps(operator)
    def run(*args, **options) -> DataFrame:
        before = len(_scratch)
        result = operator(*args, **options)
        read = {part for file in result.inputFiles() for part in file.split("/")}
        kept = [path for path in _scratch[before:] if path.rsplit("/", 1)[-1] in read]
        _scratch[before:] = [path for path in _scratch[before:] if path not in kept]
        release(result.sparkSession, before)
        _scratch.extend(kept)
        return result

    return run


# Shuffle files of a query go when it has ended, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Queries that the block runs see this value of a session setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that the block runs are removed as each ends."""
    with setting(spark, SHUFFLES_GO, "true"):
        yield


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet under the checkpoint folder and read it back.

    Used where two branches must see the very same rows (range-partition numbers, iterative training) and
    where lineage has to be cut. Being a table on shared storage it survives the loss of executors. It is removed at the end of the
    surrounding `scratch` block, and at the latest when the driver's JVM ends; the shuffle files of the write go with its end.
    """
    return materialise_all([df])


def materialise_all(frames: Iterable[DataFrame]) -> DataFrame:
    """As `materialise`, for the rows of one or more frames of the same schema, written one after the other."""
    path = None
    for df in frames:
        if path is None:
            path = scratch_path(df.sparkSession, "frame")
        with shuffles_removed(df.sparkSession):
            df.write.mode("append").parquet(path)
    at, files = _hadoop_path(df.sparkSession, path)
    files.deleteOnExit(at)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer partitions than the session has cores.

    Such a scan is small by definition (less than one split per core), so the extra exchange is cheap; a scan of
    a large table already has more splits than cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# File bytes that stand for one partition of dealt(): about 600,000 rows of a narrow table.
DEALT_BYTES = 8 << 20


def file_parts(df: DataFrame, each: int) -> int:
    """How many parts of `each` bytes the files of a scan make."""
    found = 0
    for name in df.inputFiles():
        at, files = _hadoop_path(df.sparkSession, name)
        found += files.getFileStatus(at).getLen()
    return math.ceil(found / each)


def dealt(df: DataFrame, *keys: str, each: int | None = None) -> DataFrame:
    """Rows of a scan dealt by `keys` into partitions whose number grows with the files read, so that what a task holds does not.

    Aggregates on these keys (or more) that follow need no exchange of their own. Small tables get the session's number of shuffle
    partitions, which adaptive execution may merge.
    """
    wanted = file_parts(df, each or DEALT_BYTES)
    if wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(wanted, *keys)
