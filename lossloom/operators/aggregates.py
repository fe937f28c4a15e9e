"""Per-key aggregates. All of them combine before the shuffle, so a frequent key sends little data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MASK_BITS = 60


def sum_when(condition: Column, amount: Column) -> Column:
    return F.sum(F.when(condition, amount).otherwise(F.lit(0)))


def count_when(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def any_when(condition: Column) -> Column:
    """1 if the condition holds for some row, else 0."""
    return F.max(F.coalesce(condition, F.lit(False)).cast("int"))


def flag_masks(conditions: Sequence[Column], name: str = "__mask") -> list[Column]:
    """Conditions of a row as bits of as few whole numbers as hold them (MASK_BITS each): a group keeps a number, not a column a condition."""
    masks = []
    for s in range(0, len(conditions), MASK_BITS):
        bits = [F.when(c, F.lit(1 << i)).otherwise(0).cast("bigint") for i, c in enumerate(conditions[s:s + MASK_BITS])]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(f"{name}{s // MASK_BITS}"))
    return masks


def flag_of(place: int, name: str = "__mask") -> Column:
    """0 or 1: the condition at `place` of flag_masks()."""
    return F.shiftright(F.col(f"{name}{place // MASK_BITS}"), place % MASK_BITS).bitwiseAND(F.lit(1))


def tri_state(flag: Column) -> Column:
    """1 if some row is set, 0 if rows are known but none set, null if none is known."""
    return F.max(F.when(flag == 1, 1).when(flag.isNotNull(), 0))


def one_hot_sum(column: Column, names: Mapping[str, object]) -> list[Column]:
    """Rows per listed value; {new name: value}."""
    return [F.sum(F.when(column == value, 1).otherwise(0)).alias(name) for name, value in names.items()]


def count_distinct_with_null(column: Column) -> Column:
    """Distinct values where a missing value counts as one more."""
    return F.count_distinct(column) + F.max(column.isNull().cast("int"))


def distinct_counts(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Mapping[str, Column]], missing: bool = False) -> DataFrame:
    """Many conditional distinct counts at once: {id column: {measure: condition}}; with `missing` a missing id counts as one more value.

    One row per (key, id kind, id) is built first with the conditions folded as bits of a number, then summed. Rows grow by
    the number of id columns, not by the number of measures, and a key with many rows is spread over its ids.
    """
    names = [m for conditions in measures.values() for m in conditions]
    kinds = {df.schema[i].dataType for i in measures}
    id_type = kinds.pop() if len(kinds) == 1 else "string"
    slots = []
    for kind, (identifier, conditions) in enumerate(measures.items()):
        masks = flag_masks([conditions.get(m, F.lit(False)) for m in names])
        slots.append(F.struct(F.lit(kind).alias("kind"), F.col(identifier).cast(id_type).alias("id"), *masks))
    held = [f"__mask{i}" for i in range(-(-len(names) // MASK_BITS))]
    per_id = (
        df.select(*keys, F.explode(F.array(*slots)).alias("slot")).select(*keys, "slot.*")
        .groupBy(*keys, "kind", "id").agg(*[F.bit_or(m).alias(m) for m in held])
    )
    # The group of missing ids stays, so that a key without any id keeps its row of zeros.
    known = F.lit(True) if missing else F.col("id").isNotNull()
    return per_id.groupBy(*keys).agg(*[F.sum(F.when(known, flag_of(i)).otherwise(0)).alias(m) for i, m in enumerate(names)])


def pivot_counts(df: DataFrame, key: str, column: str, values: Sequence, prefix: str,
                 measure: Column | None = None) -> DataFrame:
    """One column per listed value, 0 where absent. The list is fixed, so no extra pass finds it."""
    wide = df.groupBy(key).pivot(column, list(values)).agg(F.count(F.lit(1)) if measure is None else measure)
    return wide.select(key, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"{prefix}{v}") for v in values])


def dummy_sums(df: DataFrame, key: str, column: str, values: Mapping[str, object], null_name: str | None = None) -> DataFrame:
    """Rows per key for each listed value, with missing values in a column of their own."""
    measures = one_hot_sum(F.col(column), values)
    if null_name:
        measures.append(F.sum(F.when(F.col(column).isNull(), 1).otherwise(0)).alias(null_name))
    return df.groupBy(key).agg(*measures)


def note_documents(notes: DataFrame, key: str, order: Sequence[str], text: str, separator: str = " , ",
                   name: str = "document") -> DataFrame:
    """All notes of a key in order as one text. A cell holds at most 2 GB; flags and counts over longer histories
    come from `lossloom.plans.features.note_flags`, which works note by note."""
    entry = F.struct(*[F.col(c) for c in order], F.col(text).alias("__text"))
    ordered = F.array_sort(F.collect_list(entry))
    return notes.groupBy(key).agg(F.array_join(F.transform(ordered, lambda e: e["__text"]), separator).alias(name))


def code_list(df: DataFrame, key: str, code: str, separator: str = ",", name: str = "codes") -> DataFrame:
    """Distinct codes of a key, sorted and joined. Duplicates go before the collecting shuffle."""
    return (
        df.filter(F.col(code).isNotNull()).select(key, code).distinct()
        .groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(code)), separator).alias(name))
    )


def mean_vectors(df: DataFrame, key: str, vector: str, name: str = "mean") -> DataFrame:
    """Component-wise mean of array columns per key; partial sums are merged, rows are not moved."""
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return df.groupBy(key).agg(vector_to_array(Summarizer.mean(dense)).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def fill_with_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace missing values by the column mean; the means are one row."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(means[c])) for c in columns})


def prior_claims(parties: DataFrame, claim: str, party: str, name: str = "prior_claims") -> DataFrame:
    """Distinct claims per party, parties without a key left out."""
    return parties.filter(F.col(party).isNotNull()).groupBy(party).agg(F.count_distinct(claim).alias(name))


def any_in(column: Column, values: Sequence) -> Column:
    """1 if some row of the group has a listed value."""
    return any_when(column.isin(*values))


def coalesce_flags(flags: Sequence[Column]) -> Column:
    """1 if any of the flags is positive."""
    return reduce(lambda a, b: F.greatest(a, b), [F.coalesce(f, F.lit(0)) for f in flags])
