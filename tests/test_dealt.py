"""Scans dealt by key into partitions that grow with the files, and flags folded as bits."""

from conftest import SF_DIR
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lossloom.operators import aggregates as A
from lossloom.session import dealt


def test_dealt_partitions_grow_with_the_files(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    parts = dealt(lines, "l_orderkey", each=4096)
    assert parts.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions")) and parts.count() == lines.count()
    placed = parts.select("l_orderkey", F.spark_partition_id().alias("part")).distinct()
    assert placed.count() == lines.select("l_orderkey").distinct().count()


def test_aggregates_of_a_claim_meet_in_one_exchange(spark):
    for name in ("claim_measures", "party_counts", "recovery_amounts"):
        exchanged = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        keys = {line.split("hashpartitioning(")[1].split("#")[0] for line in exchanged.splitlines() if "Exchange hashpartitioning" in line}
        assert keys <= {"l_orderkey"}, (name, keys)


def test_many_flags_fit_several_masks(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("k"), "id")
    conditions = [F.col("id") == i for i in range(70)]
    masked = df.select("k", *A.flag_masks(conditions)).groupBy("k").agg(F.bit_or("__mask0").alias("__mask0"), F.bit_or("__mask1").alias("__mask1"))
    for r in masked.select("k", *[A.flag_of(i).alias(f"f{i}") for i in range(70)]).collect():
        assert [i for i in range(70) if r[f"f{i}"]] == [i for i in range(70) if i % 3 == r.k]
    counts = A.distinct_counts(df, ["k"], {"id": {f"m{i}": F.col("id") % 70 == i for i in range(70)}})
    for r in counts.collect():
        assert [r[f"m{i}"] for i in range(70)] == [sum(1 for j in range(200) if j % 70 == i and j % 3 == r.k) for i in range(70)]
