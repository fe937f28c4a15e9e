"""Training frames and fitted pipelines on small data."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lossloom.operators import model as G
from lossloom.operators import topics as P
from lossloom.plans import features as B
from lossloom.plans import recovery, training
from lossloom.sources import readers, sinks


def test_referral_model_saves_and_scores_new_values(spark, tmp_path):
    rows = spark.range(400).select(
        "id", (F.col("id") % 7).cast("double").alias("Report_lag"), (F.col("id") % 3).alias("kind"),
        F.when(F.col("id") % 7 > 4, F.when(F.col("id") % 2 == 0, 2).otherwise(1)).alias("SIU_FLAG"))
    estimator = G.boosted_trees(trees=3, leaf=2)
    model, train, test = training.fit_referral_model(rows, "id", "SIU_FLAG", ["kind"], ["Report_lag"], estimator)
    assert train.count() + test.count() == 400 and train.join(test, "id").count() == 0
    assert test.filter("(predicted_prob > 0.5) <> (SIU_FLAG = 1)").count() == 0
    sinks.save_model(model, str(tmp_path / "m"))
    fresh = spark.createDataFrame([(1, 6.0, "unseen"), (2, None, "nan")], "id bigint, Report_lag double, kind string")
    scored = G.score(
        fresh.withColumns({"label": F.lit(0.0), "weight": F.lit(1.0)}), readers.load_model(str(tmp_path / "m")), ["id"])
    assert {r.id for r in scored.collect() if 0 <= r.predicted_prob <= 1} == {1, 2}


def test_text_topics_and_full_outer(spark):
    docs = spark.createDataFrame(
        [(i, "hit the red car hit the red car" if i % 2 else "water in the wet house water in the wet house") for i in range(20)], "claim bigint, t string")
    shares, model, factors = training.text_topics(docs, "claim", "t", "Topic_LD_", topics=2, max_features=50, iterations=30)
    got = {r.claim: (r.Topic_LD_1, r.Topic_LD_2) for r in shares.collect()}
    assert all(abs(sum(v) - 1) < 1e-9 for v in got.values()) and max(got[1]) > 0.9 and got[1] != got[2]
    assert len(factors.top_terms(model.stages[0].vocabulary, 3)[0]) == 3
    both = training.topic_frame(shares, spark.createDataFrame([(99, 0.5)], "claim bigint, Topic_AN_1 double"), "claim")
    assert both.count() == 21


def test_topic_models_outlive_a_session(spark, tmp_path):
    rows = [(i, Vectors.sparse(3, [0, 2] if i % 2 else [1, 2], [1.0, 0.5])) for i in range(12)]
    sparse = spark.createDataFrame(rows, ["id", "v"])
    factors = P.fit_factors(sparse, "v", 3, topics=2, iterations=20)
    sinks.save_factors(spark, factors, str(tmp_path / "f"))
    loaded = readers.load_factors(spark, str(tmp_path / "f"))
    assert (loaded.matrix == factors.matrix).all() and loaded.inner == factors.inner
    shares = [r.loadings for r in P.factor_loadings(sparse, "v", loaded).orderBy("id").collect()]
    assert shares == [r.loadings for r in P.factor_loadings(sparse, "v", factors).orderBy("id").collect()]
    lda = P.fit_lda(sparse, "v", topics=2, passes=2)
    sinks.save_model(lda, str(tmp_path / "l"))
    rows = P.topic_distribution(sparse, readers.load_lda(str(tmp_path / "l"))).collect()
    assert len(rows) == 12 and all(abs(r.TOPIC_NEW_0 + r.TOPIC_NEW_1 - 1) < 1e-9 for r in rows)


def test_region_of_the_loss_state(spark):
    claims = spark.createDataFrame([(1, "ohio "), (2, "Nowhere"), (3, None)], "claimid int, lossloc_State string")
    places = spark.createDataFrame([("Ohio", "OH", "Midwest", "East North Central")] * 2, "lossloc_State string, STATE_ABBR string, REGION string, DIVISION string")
    got = B.with_region(claims, places).orderBy("claimid").collect()
    assert [(r.claimid, r.STATE_ABBR, r.REGION) for r in got] == [(1, "OH", "Midwest"), (2, None, None), (3, None, None)]


def test_recovery_model(spark):
    rows = [(None if i % 4 == 0 else "rear damage third party fault accident" if i % 2 else "hail storm damage roof window",
             "third party fault rear damage" if i % 3 else "storm damage window roof", i % 2) for i in range(60)]
    extract = spark.createDataFrame(rows, "INCIDENT_DESC string, CLM_DESC1 string, RECOVERY_FLAG int")
    model = recovery.recovery_model(extract, trees=3, depth=3)
    assert len(model.stages) == 4 and model.stages[-1].getNumTrees == 3


def test_topic_entries(spark):
    df = spark.createDataFrame([(0, [0.1, 0.7, 0.2])], "topic int, values array<double>")
    assert [(r.pos, r.value) for r in P.top_topic_terms(df, 2).collect()] == [(1, 0.7), (2, 0.2)]


def test_note_flags_equal_the_flags_of_the_joined_text(spark):
    from lossloom.functions.text import NOTE_RULES, keyword_flags
    from lossloom.operators.aggregates import note_documents

    texts = ["pay", "auth", "x pay", "record", "protect", "person", "key", "attorney repo", "none", "the auth"]
    rows = [(i // 2, i, texts[(i * 3) % 10]) for i in range(20)] + [(50, 1, "pay"), (51, 1, " record")]
    notes = spark.createDataFrame(rows, "k int, o int, t string")
    joined = note_documents(notes, "k", ["o"], "t").select("k", *keyword_flags(F.col("document"), NOTE_RULES))
    names = joined.columns
    assert sorted(map(tuple, B.note_keyword_flags(notes, "k", ["o"], "t").select(names).collect())) == sorted(map(tuple, joined.collect()))


def test_indicators(spark):
    df = spark.createDataFrame([(1, "0", "THEFT"), (2, None, None)], "id int, FAULTRATING string, LOSSCAUSE_GROUP string")
    one, two = B.with_indicators(df).orderBy("id").collect()
    assert (one["FAULTRATING_0.0"], one["LOSSCAUSE_GROUP_THEFT"], two["FAULTRATING_0.0"]) == (1, 1, 0)
    assert sum(len(v) for v in B.INDICATOR_VALUES.values()) == 57
