"""Set changes between frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, StructType


def append_by_name(*frames: DataFrame) -> DataFrame:
    """Append by column name; absent columns become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def distinct_codes(df: DataFrame, key: Sequence[str], codes: Column, name: str = "code") -> DataFrame:
    """One row per key and distinct code of an array column."""
    return df.select(*key, F.explode(codes).alias(name)).filter(F.col(name).isNotNull()).distinct()


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """256-bit digest of a row, equal where grouping by the columns would call two rows of `df` equal.

    Every value is written with its length before it, so values cannot run into each other; a null has a mark of its own and
    the two zeros are one.
    """
    parts = []
    for column in columns:
        kind, value = df.schema[column].dataType, F.col(column)
        if isinstance(kind, (FloatType, DoubleType)):
            value = value + F.lit(0.0).cast(kind)
        if isinstance(kind, BinaryType):
            text = F.hex(value)
        elif isinstance(kind, (ArrayType, StructType)):
            text = F.when(value.isNotNull(), F.to_json(F.struct(value), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}))
        else:
            text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def snapshot_change(current: DataFrame, previous: DataFrame, key: str, name: str = "changed_value") -> DataFrame:
    """Per key of the current snapshot: number of distinct rows over both weeks for keys in both, else 0.

    1 is unchanged, 2 changed, 0 new. Identical rows are merged by the first aggregate, which also records where
    they came from, so no membership join is needed; equal nulls count as equal. Rows are shuffled by key and digest, so
    long texts in a snapshot stay where they are read.
    """
    columns = current.columns
    both = (
        current.select(*columns, F.lit(1).alias("__now"), F.lit(0).alias("__then"))
        .unionByName(previous.select(*columns, F.lit(0).alias("__now"), F.lit(1).alias("__then")))
    )
    short = both.select(key, row_digest(both, columns).alias("__digest"), "__now", "__then")
    rows = short.groupBy(key, "__digest").agg(F.max("__now").alias("__now"), F.max("__then").alias("__then"))
    return (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("__n"), F.max("__now").alias("__now"), F.max("__then").alias("__then"))
        .filter(F.col("__now") == 1)
        .select(key, F.when(F.col("__then") == 1, F.col("__n")).otherwise(F.lit(0)).alias(name))
    )
