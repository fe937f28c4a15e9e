"""Sinks: files, dated snapshots, JDBC append and truncate-and-load, models."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession

from lossloom.operators.topics import TopicFactors


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_run(df: DataFrame, root: str, run_date: str) -> None:
    """Write one run under its own dated directory, leaving other runs alone."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/run_date={run_date}")


def jdbc_write_options(url: str, table: str, batch_size: int = 1000, truncate: bool = False, **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **extra}
    if truncate:
        options["truncate"] = "true"
    return options


def append_table(df: DataFrame, url: str, table: str, **extra: str) -> None:
    df.write.format("jdbc").mode("append").options(**jdbc_write_options(url, table, **extra)).save()


def truncate_and_load(df: DataFrame, url: str, table: str, **extra: str) -> None:
    """Empty the table, keep its definition and grants, load in batches."""
    df.write.format("jdbc").mode("overwrite").options(**jdbc_write_options(url, table, truncate=True, **extra)).save()


def save_model(model: MLWritable, path: str) -> None:
    """A pipeline with every stage, so that a vocabulary travels with the model that uses it, or a topic model."""
    model.write().overwrite().save(path)


def save_factors(spark: SparkSession, factors: TopicFactors, path: str) -> None:
    """Topic factors as a table of one row a topic."""
    rows = [(i, factors.inner, row.tolist()) for i, row in enumerate(factors.matrix)]
    spark.createDataFrame(rows, "topic int, inner int, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)
