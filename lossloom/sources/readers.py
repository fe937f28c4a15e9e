"""Scans: JDBC queries and tables, CSV with an explicit schema, many files with differing headers, saved models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LocalLDAModel
from pyspark.sql import DataFrame, SparkSession

from lossloom.operators.online_lda import TopicModel
from lossloom.operators.topics import TopicFactors
from lossloom.session import _hadoop_path


def jdbc_options(url: str, query: str | None = None, table: str | None = None, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None, partitions: int | None = None,
                 fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Reader options. Credentials come through `extra`; large tables are split over a numeric column.

    A query cannot be split by the source, so a partitioned read wraps it as a derived table.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    if partition_column is None:
        options["query" if query else "dbtable"] = query or table
        return options
    if None in (lower, upper, partitions):
        raise ValueError("a partitioned read needs lower, upper and partitions")
    options["dbtable"] = table or f"({query}) source"
    options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, **arguments) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **arguments)).load()


def read_csv(spark: SparkSession, path: str | list[str], schema: str, encoding: str = "UTF-8") -> DataFrame:
    """CSV with header and explicit schema: no inference pass over the data."""
    return spark.read.schema(schema).option("header", True).option("encoding", encoding).csv(path)


def read_many_csv(spark: SparkSession, groups: Sequence[tuple[str | list[str], str]], encoding: str = "UTF-8") -> DataFrame:
    """Files with differing headers, one (paths, schema) group per header, stacked by column name."""
    return stack([read_csv(spark, path, schema, encoding) for path, schema in groups])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Append by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_header_case(df: DataFrame, change: Callable[[str], str] = str.upper) -> DataFrame:
    return df.toDF(*[change(c) for c in df.columns])


def drop_artefacts(df: DataFrame, names: Sequence[str] = ("Unnamed: 0", "DT_seg")) -> DataFrame:
    """Drop index columns left by earlier exports; absent names are ignored."""
    return df.drop(*[f"{n}" for n in names])


def keep_first_columns(df: DataFrame) -> DataFrame:
    """Keep the first of each repeated column name (case-insensitive), by position."""
    seen: set[str] = set()
    keep = [i for i, c in enumerate(df.columns) if not (c.lower() in seen or seen.add(c.lower()))]
    positional = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return positional.select(*[f"_c{i}" for i in keep]).toDF(*[df.columns[i] for i in keep])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_lda(path: str) -> LocalLDAModel | TopicModel:
    """A topic model that `save_model` wrote; models that Spark's own LDA wrote are read as well."""
    at, files = _hadoop_path(SparkSession.getActiveSession(), f"{path.rstrip('/')}/metadata")
    return LocalLDAModel.load(path) if files.exists(at) else TopicModel.load(path)


def load_factors(spark: SparkSession, path: str) -> TopicFactors:
    """Topic factors that `save_factors` wrote; topics x terms numbers, bounded when they were fitted."""
    rows = spark.read.parquet(path).orderBy("topic").collect()
    return TopicFactors(np.array([r["weights"] for r in rows]), rows[0]["inner"])


def read_run(spark: SparkSession, root: str, run_date: str, schema: str | None = None) -> DataFrame:
    """One run of a dated output, e.g. last week's snapshot; only its partition is listed."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/run_date={run_date}")
