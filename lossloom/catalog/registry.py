"""Named queries over the driver's tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lossloom.session import fill_cores

# Tables whose rows cost much more to process than to read.
TEXT_TABLES = ("documents", "pages", "embeddings")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the Parquet tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        # Exposure lines that a query has written once, as many of its parts read them.
        self.lines: DataFrame | None = None

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return fill_cores(table) if name in TEXT_TABLES else table


def query(sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under its own name, with its oracle if SQL can express it."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
