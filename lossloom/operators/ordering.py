"""Order-dependent operators without a one-task window: row numbers, running totals, gaps, cut-offs, quantiles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossloom.session import materialise

APPROXIMATION = 10_000
EXACT_ROWS = 200_000


def range_partitioned(df: DataFrame, *order: Column | str) -> DataFrame:
    """Stored rows in as many ranges as the session has shuffle partitions, with the number of their range in __part.

    The number is given, so adaptive execution does not put small ranges together and a hot value keeps its segments.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.repartitionByRange(width, *order).withColumn("__part", F.spark_partition_id()))


def running_totals(df: DataFrame, order: Sequence[Column], totals: Mapping[str, Column]) -> DataFrame:
    """Running sums over the whole frame in the given total order, distributed.

    Rows are range-partitioned and stored, each partition is summed, and the sums of earlier partitions (one row
    per partition) are added to the running sums inside a partition.
    """
    amounts = {f"__a_{n}": c for n, c in totals.items()}
    stored = range_partitioned(df.withColumns(amounts), *order)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("__part").agg(*[F.sum(f"__a_{n}").alias(f"__a_{n}") for n in totals])
        .select("__part", *[F.coalesce(F.sum(f"__a_{n}").over(before), F.lit(0)).alias(f"__s_{n}") for n in totals])
    )
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        stored.join(F.broadcast(starts), "__part")
        .withColumns({n: F.col(f"__s_{n}") + F.sum(f"__a_{n}").over(inside) for n in totals})
        .drop("__part", *amounts, *[f"__s_{n}" for n in totals])
    )


def row_index(df: DataFrame, order: Sequence[Column], name: str = "seq") -> DataFrame:
    """1, 2, 3, … in a total order."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")})


def round_robin(df: DataFrame, order: Sequence[Column], members: Sequence[str], name: str = "member",
                index: str = "seq") -> DataFrame:
    """Deal ordered rows to members in turn; row 1 goes to the first member."""
    roster = F.array(*[F.lit(m) for m in members])
    position = F.pmod(F.col(index) - 1, F.lit(len(members))).cast("int")
    return row_index(df, order, index).withColumn(name, F.get(roster, position))


def order_statistics(df: DataFrame, wanted: Mapping[str, tuple[Column, Callable[[int], int]]],
                     value_type: str = "double", exact_rows: int = EXACT_ROWS) -> dict[str, object]:
    """Exact values at given positions: {name: (column, n -> 0-based ascending position among the n known values)}.

    While more than `exact_rows` values are candidates, approximate quantiles bracket the position and an exact
    count checks the bracket; what remains is counted by value. Only a few numbers per name reach the driver.
    Names without known values, or whose position is outside 0..n-1, get None.
    """
    columns = {name: c.cast(value_type) for name, (c, _) in wanted.items()}
    values = df.select(*[c.alias(name) for name, c in columns.items()])
    sizes = values.agg(*[F.count(name).alias(name) for name in columns]).first()
    result: dict[str, object] = dict.fromkeys(wanted)
    state = {}
    for name, (_, position) in wanted.items():
        n = sizes[name]
        k = position(n) if n else -1
        if 0 <= k < n:
            state[name] = {"k": k, "below": 0, "inside": n, "test": F.col(name).isNotNull()}
    while any(s["inside"] > exact_rows for s in state.values()):
        wide = {n: s for n, s in state.items() if s["inside"] > exact_rows}
        brackets = values.agg(*[
            F.percentile_approx(
                F.when(s["test"], F.col(n)),
                [max(0.0, (s["k"] - s["below"]) / s["inside"] - 2 / APPROXIMATION),
                 min(1.0, (s["k"] - s["below"] + 1) / s["inside"] + 2 / APPROXIMATION)],
                APPROXIMATION,
            ).alias(n) for n, s in wide.items()
        ]).first()
        counts = values.agg(*[
            measure for n in wide for low, high in [brackets[n]] for measure in (
                F.count_if(F.col(n) < F.lit(low)).alias(f"{n}__below"),
                F.count_if(F.col(n).between(F.lit(low), F.lit(high))).alias(f"{n}__inside"),
            )
        ]).first()
        for n, s in wide.items():
            low, high = brackets[n]
            below, inside = counts[f"{n}__below"], counts[f"{n}__inside"]
            if not below <= s["k"] < below + inside:
                raise ArithmeticError("quantile bracket missed its position")
            if low == high:
                result[n] = low
                state.pop(n)
            elif inside < s["inside"]:
                s.update(below=below, inside=inside, test=F.col(n).between(F.lit(low), F.lit(high)))
            else:
                return {**result, **_by_value(values, state)}
    return {**result, **_by_value(values, state)} if state else result


def _by_value(values: DataFrame, state: Mapping[str, dict]) -> dict[str, object]:
    """Values at the wanted positions from exact counts per value."""
    entries = [F.struct(F.lit(n).alias("name"), F.when(s["test"], F.col(n)).alias("value")) for n, s in state.items()]
    candidate = reduce(lambda a, b: a | b, [s["test"] for s in state.values()])
    counted = (
        values.filter(candidate).select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(F.col("value").isNotNull())
        .groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.create_map(*[x for n, s in state.items() for x in (F.lit(n), F.lit(s["k"] - s["below"]).cast("bigint"))])
    rows = (
        counted.withColumn("upto", F.sum("n").over(upto))
        .filter(F.col("upto") > F.try_element_at(rank, F.col("name")))
        .groupBy("name").agg(F.min("value").alias("value")).collect()
    )
    return {r["name"]: r["value"] for r in rows}


def top_fraction(df: DataFrame, score: str, fraction: float = 0.05, name: str = "referred") -> DataFrame:
    """Mark rows whose score reaches the value at position int(n * fraction) of the descending order; ties are in."""
    cut = order_statistics(df, {"cut": (F.col(score), lambda n: n - 1 - int(n * fraction))})["cut"]
    return df.withColumn(name, F.when(F.col(score) >= F.lit(cut), 1).otherwise(0))


def winsorize(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Clamp columns to the values at positions int(low * n) and n - 1 - int(high * n); nulls are ignored."""
    wanted = {}
    for i, (column, (low, high)) in enumerate(limits.items()):
        wanted[f"low_{i}"] = (F.col(column), lambda n, q=low: int(q * n))
        wanted[f"high_{i}"] = (F.col(column), lambda n, q=high: n - 1 - int(q * n))
    cuts = order_statistics(df, wanted)
    clamped = {}
    for i, column in enumerate(limits):
        low, high, value = cuts[f"low_{i}"], cuts[f"high_{i}"], F.col(column)
        if low is not None:
            clamped[column] = F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)
    return df.withColumns(clamped)


def event_sequence(df: DataFrame, party: str, moment: str, tie: str, rank: str = "rn", gap: str = "gap_days") -> DataFrame:
    """Rank of each event of a party by time, and days since its previous event (0 for the first).

    Events are range-partitioned by (party, time, tie) and stored, so a party with many events, even in one hour, lies in several segments.
    A segment ranks its own rows; only the party that a segment begins with can go on from earlier ones, so one row a segment
    carries the number of its earlier events and the last of them. Events without a party are left out; events without a time are kept, with a
    null rank and gap. Events that agree in party, time and tie are ranked in any order.
    """
    undated = df.filter(F.col(party).isNotNull() & F.col(moment).isNull()).withColumns(
        {rank: F.lit(None).cast("bigint"), gap: F.lit(None).cast("int")})
    dated = df.filter(F.col(party).isNotNull() & F.col(moment).isNotNull())
    stored = range_partitioned(dated, party, moment, tie)
    runs = stored.groupBy(party, "__part").agg(F.count(F.lit(1)).alias("__n"), F.max(moment).alias("__last"))
    earlier = Window.partitionBy(party).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        runs.select(F.col(party).alias("__party"), "__part", F.sum("__n").over(earlier).alias("__before"),
                    F.last("__last").over(earlier).alias("__previous"))
        .filter("__before is not null").withColumnRenamed("__part", "__segment")
    )
    inside = Window.partitionBy("__part", party).orderBy(moment, tie)
    previous = F.coalesce(F.lag(moment).over(inside), "__previous")
    # One row a segment at most: broadcast.
    return (
        stored.join(F.broadcast(carried), (F.col("__part") == F.col("__segment")) & (F.col(party) == F.col("__party")), "left")
        .withColumns({
            rank: F.coalesce("__before", F.lit(0)) + F.row_number().over(inside),
            gap: F.coalesce(F.datediff(F.to_date(moment), F.to_date(previous)), F.lit(0)),
        })
        .drop("__part", "__segment", "__party", "__before", "__previous")
        .unionByName(undated)
    )


def longest_gap(df: DataFrame, party: str, moment: str, name: str = "gap_days") -> DataFrame:
    """Longest gap in days between consecutive events of a party; needs only its distinct days."""
    w = Window.partitionBy(party).orderBy("__day")
    return (
        df.filter(F.col(party).isNotNull()).select(party, F.to_date(moment).alias("__day")).distinct()
        .withColumn("__gap", F.coalesce(F.datediff(F.col("__day"), F.lag("__day").over(w)), F.lit(0)))
        .groupBy(party).agg(F.max("__gap").alias(name))
    )


def first_by_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Columns of the row that comes first in the given ascending order; an aggregate, so nothing is sorted.

    Use negated numbers for a descending order.
    """
    first = F.min_by(F.struct(*columns), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*key).agg(first.alias("__row")).select(*key, "__row.*")


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
