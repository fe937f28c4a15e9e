"""Edge rows the generated tables cannot show: nulls, ties, boundaries."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lossloom.functions import conditional as C
from lossloom.functions import dates as D
from lossloom.functions import maths as M
from lossloom.functions import text as X
from lossloom.operators import aggregates as A
from lossloom.operators import filters as L
from lossloom.operators import joins as J
from lossloom.operators import ordering as O
from lossloom.operators import model
from lossloom.operators import terms as V
from lossloom.operators.sets import snapshot_change
from lossloom.sources import readers, sinks


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column).first()[0]


def test_tri_state(spark):
    rows = [(1, None), (1, None), (2, 0), (2, None), (3, 0), (3, 1)]
    df = spark.createDataFrame(rows, "k int, f int").groupBy("k").agg(A.tri_state(F.col("f")).alias("s"))
    assert dict(df.collect()) == {1: None, 2: 0, 3: 1}


def test_distinct_with_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    assert df.agg(A.count_distinct_with_null(F.col("c"))).first()[0] == 2


def test_distinct_counts_ignore_null_ids_and_keep_empty_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 0), (1, None, 1), (2, None, 1)], "k int, id string, f int")
    got = A.distinct_counts(df, ["k"], {"id": {"n": F.lit(True), "on": F.col("f") == 1}}).collect()
    assert {r.k: (r.n, r.on) for r in got} == {1: (1, 1), 2: (0, 0)}


def test_first_match_lookup(spark):
    table = spark.createDataFrame([(2, "10537", "GL PD"), (1, "10537", "Building")], "line int, k string, v string")
    assert J.first_match_table(table, ["k"], "v", "line").collect() == [Row(k="10537", v="Building")]


@pytest.mark.parametrize("own,claimant,insured,party,want", [
    (None, "C", "I", "10001", "C"), (None, None, "I", "10001", "I"), (None, None, "I", "10002", None), ("O", "C", "I", "10001", "O")])
def test_exposure_name(spark, own, claimant, insured, party, want):
    df = spark.createDataFrame([(own, claimant, insured, party)], "o string, c string, i string, p string")
    assert df.select(C.exposure_name(*[F.col(c) for c in "ocip"])).first()[0] == want


def test_gap(spark):
    t = lambda s: dt.datetime.fromisoformat(s)
    rows = [("one", t("2020-01-01 10:00:00"), 1), ("same", t("2020-01-01 10:00:00"), 1), ("same", t("2020-01-01 11:00:00"), 2),
            ("night", t("2020-01-01 23:59:00"), 1), ("night", t("2020-01-02 00:01:00"), 2)]
    got = O.event_sequence(spark.createDataFrame(rows, "p string, ts timestamp, id int"), "p", "ts", "id").collect()
    assert {(r.p, r.id): (r.rn, r.gap_days) for r in got} == {
        ("one", 1): (1, 0), ("same", 1): (1, 0), ("same", 2): (2, 0), ("night", 1): (1, 0), ("night", 2): (2, 1)}


def test_winsorize(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(1, 201)] + [(None, None)], "x double, y double")
    got = O.winsorize(df, {"x": (0.01, 0.01), "y": (0, 0.002)}).agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count("*")).first()
    assert tuple(got) == (3.0, 198.0, 1.0, 200.0, 201)


def test_order_statistics_narrowing_equals_sorting(spark):
    values = [float((i * 7919) % 1013) for i in range(5000)] + [500.0] * 3000
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    wanted = {f"k{k}": (F.col("v"), lambda n, k=k: k) for k in (0, 17, 2500, 4000, 7999)}
    got = O.order_statistics(df, wanted | {"out": (F.col("v"), lambda n: n)}, exact_rows=50)
    ordered = sorted(values)
    assert got == {**{f"k{k}": ordered[k] for k in (0, 17, 2500, 4000, 7999)}, "out": None}


def test_top_fraction_with_tie(spark):
    scores = [0.9, 0.8, 0.8] + [i / 100 for i in range(17)]
    got = O.top_fraction(spark.createDataFrame([(s,) for s in scores], "s double"), "s", 0.05)
    assert got.agg(F.sum("referred")).first()[0] == 3


def test_snapshot_change(spark):
    schema = "k string, v string"
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("n", "1")], schema)
    then = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None), ("gone", "1")], schema)
    assert dict(snapshot_change(now, then, "k").collect()) == {"a": 1, "b": 2, "c": 1, "n": 0}


def test_snapshot_change_compares_whole_rows_by_digest(spark):
    schema = "k int, a string, b string, x double, t timestamp, l array<string>"
    t = dt.datetime(2020, 1, 1, 0, 0, 0, 5)
    long = "word " * 200_000
    now = [(1, "1:x", "y", 0.0, t, ["a, b"]), (2, "", None, 1.0, t, None), (3, "ab", "c", None, t, ["a", None]), (4, long + "a", "", 1.0, t, []),
           (5, "a", "b", 1.0, t, []), (6, "a", "b", 1.0, t, ["a, b"])]
    then = [(1, "1:x", "y", -0.0, t, ["a, b"]), (2, None, "", 1.0, t, None), (3, "a", "bc", None, t, ["a", None]), (4, long + "b", "", 1.0, t, []),
            (5, "a", "b", 1.0, t.replace(microsecond=6), []), (6, "a", "b", 1.0, t, ["a", "b"])]
    got = snapshot_change(spark.createDataFrame(now, schema), spark.createDataFrame(then, schema), "k")
    assert dict(got.collect()) == {1: 1, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("a#" not in line.split("hashpartitioning", 1)[1] for line in plan.splitlines() if "hashpartitioning" in line)


@pytest.mark.parametrize("referred,status,change,want", [
    (1, "SIU Investigation", 2, 0), (1, "Rejected Referral", 1, 0), (1, "Rejected Referral", 2, 1), (1, None, 1, 1), (0, "0", 0, 0)])
def test_referral(spark, referred, status, change, want):
    df = spark.createDataFrame([(referred, status, change)], "r int, s string, c int")
    assert df.select(C.referral_override(F.col("r"), F.col("s"), F.col("c"))).first()[0] == want


@pytest.mark.parametrize("clock,want", [
    ("00:00:00", "midnight"), ("00:00:05", "twelveam"), ("03:59:00", "midnight"), ("04:00:00", "early morning"),
    ("08:00:00", "dayhours"), ("21:59:00", "dayhours"), ("22:00:00", "midnight")])
def test_hour_bucket(spark, clock, want):
    assert one(spark, D.hour_bucket(F.lit(f"2020-01-01 {clock}").cast("timestamp_ntz"))) == want


def test_quarter_day_of_missing_moment(spark):
    assert one(spark, D.quarter_day(F.lit(None).cast("timestamp"))) == "18 to 23"


@pytest.mark.parametrize("day,want", [("2020-01-02", 0), ("2020-01-03", 1), ("2020-01-04", 1), ("2020-01-05", 1)])
def test_weekend(spark, day, want):
    assert one(spark, D.weekend(F.lit(day).cast("date"))) == want


@pytest.mark.parametrize("original,want", [(None, "2000-01-01"), ("1985-01-01", "2000-01-01"), ("1999-01-01", "1999-01-01")])
def test_oldest_valid(spark, original, want):
    got = one(spark, D.oldest_valid(F.lit(original).cast("date"), F.lit("2000-01-01").cast("date")))
    assert str(got) == want


def test_elapsed_days_rounds_down(spark):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, D.elapsed_days(at("2020-01-01 12:00:00"), at("2020-01-03 11:59:59"))) == 1
    assert one(spark, D.elapsed_days(at("2020-01-03 11:59:59"), at("2020-01-01 12:00:00"))) == -2
    assert one(spark, D.elapsed_days(F.lit(None).cast("timestamp_ntz"), at("2020-01-01 12:00:00"), default=0)) == 0


def test_clean_note(spark):
    assert one(spark, X.clean_note(F.lit("<b>x</b> &lt;5 (a)*"))) == "x less5 a "
    assert one(spark, X.clean_note(F.lit("Abc 12-3 x]] 9]z #]] p]"))) == "Abc 12-3 x z  p]".replace("  ", " ")
    assert one(spark, X.clean_note(F.lit(None).cast("string"))) == "None"
    assert one(spark, X.clean_note(F.lit("a1-b"), strict=True)) == "ab"


def test_literal_filter_alone(spark):
    assert one(spark, F.regexp_replace(F.lit("Abc 12-3 x]] 9]z #]] p]"), X.LITERAL_FILTER, "")) == "Abc 12-3 x z  p]"


def test_literal_keyword_rule(spark):
    df = spark.createDataFrame([("a loss",), ("total",), (None,)], "t string")
    got = [r[0] for r in df.select(X.DESCRIPTION_RULES[0].column(F.col("t"))).collect()]
    assert got == [1, 0, 0]


def test_phrase_count(spark):
    assert one(spark, X.phrase_count(F.lit("aaaa"), "aa")) == 2


@pytest.mark.parametrize("text,want", [(None, "f"), ("sixsix", "f"), ("seven77", "seven77")])
def test_longer_text(spark, text, want):
    assert one(spark, C.longer_text(F.lit(text).cast("string"), F.lit("f"))) == want


def test_anti_join_with_null_in_list(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert J.without_members(df, spark.createDataFrame([(1,), (None,)], "k int"), "k").collect() == [Row(k=2)]


def test_null_spread_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (9, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "never")], "k int, w string")
    got = {r.v: r.w for r in J.null_spread_join(left, right, ["k"]).collect()}
    assert got == {"a": "x", "b": None, "c": None, "d": None}
    folded = right.groupBy("k").agg(F.max("w").alias("w")).hint("merge")
    plan = J.null_spread_join(left, folded, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(k") >= 2 and "__spread" in plan[plan.index("hashpartitioning(k"):].split(")")[0]


def test_ratio_by_zero(spark):
    assert one(spark, M.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, M.clamp(F.lit(None).cast("int"), 0, 50, default=4)) == 4


def test_named(spark):
    df = spark.createDataFrame([("x",), ("Suspense Policy",), (None,)], "n string")
    known, unknown = L.split_named(df, "n")
    assert (known.count(), unknown.count()) == (1, 2)


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(X.ngram_range(F.col("t"), 1, 3)).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_chi2_tail(spark):
    df = spark.createDataFrame([(3.841458820694124,)], "x double")
    assert abs(df.select(V.chi2_tail(F.col("x"), 1)).first()[0] - 0.05) < 1e-9
    df = spark.createDataFrame([(7.814727903251179,), (9.487729036781154,)], "x double")
    assert abs(df.select(V.chi2_tail(F.col("x"), 3)).first()[0] - 0.05) < 1e-9
    assert abs(df.select(V.chi2_tail(F.col("x"), 4)).collect()[1][0] - 0.05) < 1e-9


def test_limited_split_keeps_all_parts_unless_limited(spark):
    assert one(spark, X.limited_split(F.lit("1,2,3,4,5,6,7,8"))) == list("12345678")
    assert one(spark, X.limited_split(F.lit("1,2,3,4,5,6,7,8"), limit=7)) == list("1234567")


def test_bump_suffix_reads_all_digits(spark):
    assert one(spark, X.bump_suffix(F.lit("AFV10D12345"))) == "AFV10D12346"


def test_event_sequence_keeps_undated_rows(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", None, 2), ("b", None, 3)], "p string, t string, id int").withColumn("t", F.to_timestamp("t"))
    got = {r.id: (r.rn, r.gap_days) for r in O.event_sequence(df, "p", "t", "id").collect()}
    assert got == {1: (1, 0), 2: (None, None), 3: (None, None)}


def test_balanced_weights_with_null_label(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int")
    assert sorted((str(r.y), r.weight) for r in model.balanced_weights(df, "y").collect()) == [("0", 1.5), ("1", 0.75), ("1", 0.75), ("None", None)]


def test_code_list_skips_keys_without_codes(spark):
    df = spark.createDataFrame([(1, "N"), (1, "A"), (1, "A"), (2, None)], "k int, c string")
    assert A.code_list(df, "k", "c").collect() == [Row(k=1, codes="A,N")]


def test_jdbc_options():
    got = readers.jdbc_options("jdbc:x", query="select 1", partition_column="id", lower=0, upper=9, partitions=3, user="u")
    assert got["dbtable"] == "(select 1) source" and got["numPartitions"] == "3" and got["user"] == "u" and "query" not in got
    assert readers.jdbc_options("jdbc:x", table="t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x")
    assert sinks.jdbc_write_options("jdbc:x", "t", truncate=True) == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "1000", "truncate": "true"}


def test_many_csv_with_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    got = readers.read_many_csv(spark, [(str(tmp_path / "a.csv"), "x int, y int"), (str(tmp_path / "b.csv"), "y int, z int")])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 2, None), (None, 3, 4)]


def test_scratch_tables_end_with_their_block(spark):
    import os

    from lossloom import session as S

    root = S.checkpoint_root(spark).removeprefix("file:")
    kept = S.materialise(spark.range(5))
    before = set(os.listdir(root))
    with S.scratch(spark):
        frame = S.materialise(spark.range(100))
        with S.scratch(spark):
            assert S.materialise(frame.filter("id > 50")).count() == 49
        assert len(set(os.listdir(root)) - before) == 1 and frame.count() == 100
    assert set(os.listdir(root)) == before and kept.count() == 5
    with pytest.raises(ValueError), S.scratch(spark):
        S.materialise(spark.range(3))
        raise ValueError
    assert set(os.listdir(root)) == before
    from __spark_entry__ import queries

    with S.scratch(spark):
        assert queries()["round_robin"](spark, "/root/testdata/sf0.001").count() > 0
    assert set(os.listdir(root)) == before


def test_scratch_tables_end_with_the_session(tmp_path):
    import os
    import subprocess
    import sys

    code = ("import sys; sys.path.insert(0, sys.argv[1])\nfrom lossloom.session import build_session, materialise\n"
            "s = build_session('end', 'local[1]', **{'spark.ui.enabled': 'false', 'spark.checkpoint.dir': sys.argv[2]})\n"
            "print(materialise(s.range(7)).count()); s.stop()")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code, here, str(tmp_path / "cp")], capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("7") and not [f for f in os.listdir(tmp_path / "cp") if f.startswith("frame-")]
