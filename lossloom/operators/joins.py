"""Join shapes. Spark broadcasts a side only below its own size threshold, and adaptive execution splits skewed sort-merge
partitions where both inputs are plain shuffles, not where one is an aggregate on the key; `folded_join` splits hot keys there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.session import materialise

FIXED_ROWS_LIMIT = 2_000
# A key is hot from this many rows on, if it also holds more than the share of all rows below.
HOT_ROWS = 50_000
HOT_SHARES = 4


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A lookup table written in code; broadcast because its length is checked here."""
    if len(rows) > FIXED_ROWS_LIMIT:
        raise ValueError("too many rows for a fixed table; read it from a file")
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def decode(df: DataFrame, lookups: Mapping[str, tuple[DataFrame, str]], code: str = "ID",
           label: str = "DESCRIPTION") -> DataFrame:
    """Left-join one code table per column; {column: (code table, name of the label)}."""
    for column, (codes, name) in lookups.items():
        side = codes.select(F.col(code).alias(f"__{name}"), F.col(label).alias(name))
        df = df.join(side, F.col(f"`{column}`") == F.col(f"__{name}"), "left").drop(f"__{name}")
    return df


def first_match_table(table: DataFrame, keys: Sequence[str], value: str, line: str) -> DataFrame:
    """Lookup with one row per key: the value of the lowest line wins, as in a CASE that stops at its first match."""
    return table.groupBy(*keys).agg(F.min_by(value, line).alias(value))


def in_role(dimension: DataFrame, role: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A dimension with every column prefixed, so that it can be joined under several roles."""
    return dimension.select(*[F.col(c).alias(f"{role}_{c}") for c in (columns or dimension.columns)])


def null_spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: int = 256) -> DataFrame:
    """Left join in which rows without a key are spread over partitions instead of meeting in one.

    The extra join column is 0 for rows that have a key, so matches are unchanged. On the right it is computed from
    the key, because the optimizer would fold a literal and shuffle by the key alone.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.when(missing, F.pmod(F.xxhash64(*left.columns), F.lit(spread)) + 1).otherwise(F.lit(0).cast("bigint"))
    return (
        left.withColumn("__spread", salt)
        .join(right.withColumn("__spread", F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))), [*keys, "__spread"], "left")
        .drop("__spread")
    )


def hot_keys(df: DataFrame, *key_sets: Sequence[str], least: int = HOT_ROWS) -> list[DataFrame]:
    """One table (keys, __copies) for each set of columns: the keys with so many rows of `df` that one task should not hold them.

    All sets are counted in one pass, combined before the shuffle. With P shuffle partitions a key is hot if it has over 1/(4 P) of the rows
    and `least` or more, so a table has at most 4 P rows whatever the data; its copies add up to 12 P at most.
    """
    sets = [list(keys) for keys in key_sets]
    entries = [F.struct(F.lit(i).alias("__set"), *[F.col(c).alias(c) if c in keys else F.lit(None).cast(df.schema[c].dataType).alias(c)
                                                    for c in dict.fromkeys(c for ks in sets for c in ks)])
               for i, keys in enumerate(sets)]
    columns = list(dict.fromkeys(c for ks in sets for c in ks))
    counted = materialise(df.select(F.explode(F.array(*entries)).alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("__n")).select("e.*", "__n"))
    shares = HOT_SHARES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counted.filter("__set = 0").agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    limit = max(least, rows // shares + 1)
    hot = materialise(counted.filter(F.col("__n") >= limit).withColumn("__copies", F.ceil(F.col("__n") / F.lit(limit)).cast("int") + 1)
                      .select("__set", *columns, "__copies"))
    found = []
    for i, keys in enumerate(sets):
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
        found.append(hot.filter((F.col("__set") == i) & known).select(*keys, "__copies"))
    return found


def folded_join(df: DataFrame, folded: DataFrame, keys: Sequence[str], hot: DataFrame | None = None, by: Sequence[str] | None = None,
                spread: int = 256, least: int = HOT_ROWS) -> DataFrame:
    """Left join with a side that has one row per key, such as an aggregate on it, where a hot key meets its row in several tasks.

    Rows of a hot key get one of its copies' numbers by a hash of the columns `by` (all, if not given) and the folded row is repeated once a
    copy; other rows are joined as usual, rows without a key are spread. `hot` is a result of hot_keys(); it is computed if not given. Its
    length is bounded by the number of shuffle partitions, so it is broadcast.
    """
    if hot is None:
        hot = hot_keys(df, keys, least=least)[0]
    small = F.broadcast(hot.select(*[F.col(c).alias(f"__hot_{c}") for c in keys], "__copies"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__hot_{c}") for c in keys])
    marks = [f"__hot_{c}" for c in keys]
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    turn = F.xxhash64(*(by or df.columns))
    salt = (F.when(missing, F.pmod(turn, F.lit(spread)) + 1).when(F.col("__copies").isNotNull(), F.pmod(turn, F.col("__copies")))
            .otherwise(F.lit(0)).cast("int"))
    left = df.join(small, same, "left").withColumn("__salt", salt).drop("__copies", *marks)
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__copies"), F.lit(1)) - 1)
    right = folded.join(small, same, "left").withColumn("__salt", F.explode(copies)).drop("__copies", *marks)
    return left.join(right, [*keys, "__salt"], "left").drop("__salt")


def concat_key(*parts: Column) -> Column:
    """Text key of several columns; null if any part is null."""
    return F.concat(*[p.cast("string") for p in parts])


def concat_key_join(left: DataFrame, right: DataFrame, left_parts: Sequence[str], right_parts: Sequence[str],
                    how: str = "left", safe: bool = False) -> DataFrame:
    """Join on concatenated text keys, or with `safe` on the parts themselves (concatenations can collide)."""
    if safe:
        pairs = [F.col(a).cast("string") == F.col(b).cast("string") for a, b in zip(left_parts, right_parts)]
        return left.join(right, reduce(lambda x, y: x & y, pairs), how)
    return left.join(right, concat_key(*map(F.col, left_parts)) == concat_key(*map(F.col, right_parts)), how)


def with_members(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is in the list."""
    return df.join(keys, on, "left_semi")


def without_members(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is not in the list; nulls in the list do not empty the result."""
    return df.join(keys, on, "left_anti")


def lookup_fallback(df: DataFrame, by_first: DataFrame, first: str, by_second: DataFrame, second: str, value: str,
                    default=None, hot: Mapping[str, DataFrame] | None = None, by: Sequence[str] | None = None) -> DataFrame:
    """Value by the first key, else by the second, else the default. Both lookups hold one row per key; hot keys are split."""
    hot = hot or dict(zip((first, second), hot_keys(df, [first], [second])))
    primary = by_first.select(F.col(first), F.col(value).alias("__first"))
    secondary = by_second.select(F.col(second), F.col(value).alias("__second"))
    joined = folded_join(folded_join(df, primary, [first], hot[first], by), secondary, [second], hot[second], by)
    choices = [F.col("__first"), F.col("__second")] + ([] if default is None else [F.lit(default)])
    return joined.withColumn(value, F.coalesce(*choices)).drop("__first", "__second")


def assemble_wide(base: DataFrame, key: str, parts: Sequence[DataFrame]) -> DataFrame:
    """Left-join results that are already one row per key onto the base. All parts share one partitioning."""
    return reduce(lambda acc, part: acc.join(part, key, "left"), parts, base)


def assemble_packed(base: DataFrame, key: str, parts: Sequence[DataFrame]) -> DataFrame:
    """assemble_wide() for rows of many columns: each part travels through the joins that follow as one value, not column by column."""
    def packed(df: DataFrame, i: int) -> DataFrame:
        return df.select(key, F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key]).alias(f"__part{i}"))

    frames = [base, *parts]
    wide = assemble_wide(packed(base, 0), key, [packed(p, i) for i, p in enumerate(parts, 1)])
    return wide.select(key, *[F.col(f"__part{i}")[c].alias(c) for i, p in enumerate(frames) for c in p.columns if c != key])


def latest_status(df: DataFrame, history: DataFrame, on: str, defaults: Mapping[str, object]) -> DataFrame:
    """Attach history columns and fill the missing ones with defaults."""
    return df.join(history, on, "left").fillna(dict(defaults))
