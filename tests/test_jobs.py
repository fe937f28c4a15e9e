"""The scoring job through files: repeated, broken and incomplete runs."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from lossloom.operators import model as G
from lossloom.plans import jobs
from lossloom.sources import runs, sinks


@pytest.fixture
def saved(spark, tmp_path):
    frame = spark.range(300).select(
        F.col("id").alias("CLAIMID"), F.concat(F.lit("C"), "id").alias("CLAIMNUMBER"), F.lit("2020-01-05").cast("date").alias("REPORTEDDATE"),
        (F.col("id") % 3).cast("string").alias("kind"), (F.col("id") % 7).cast("double").alias("size"), (F.col("id") % 5 == 0).cast("double").alias("label"))
    stages = [*G.encoder(frame, ["kind"], ["size"]).getStages(), LogisticRegression()]
    sinks.save_model(Pipeline(stages=stages).fit(frame), f"{tmp_path}/model")
    return frame.drop("label"), f"{tmp_path}/model", f"{tmp_path}/runs"


def files(root):
    from pathlib import Path

    return sorted(str(p) for p in Path(root).rglob("*.parquet")) + sorted(str(p) for p in Path(root).rglob("*.json"))


def test_repeated_run_changes_nothing(spark, saved):
    frame, model, root = saved
    first = jobs.scoring_run(spark, root, "2020-02-01", frame.filter("CLAIMID < 200"), model)
    assert (first["delivery"], first["scored"], first["delivered"]) == (1, 200, 200)
    second = jobs.scoring_run(spark, root, "2020-02-08", frame, model)
    assert (second["delivery"], second["scored"], second["delivered"]) == (2, 300, 100)
    before = files(root)
    assert jobs.scoring_run(spark, root, "2020-02-08", frame.limit(1), model) == second and files(root) == before
    output = runs.read_published(spark, root, "output")
    assert output.groupBy("CLAIMID").count().filter("count > 1").count() == 0 and output.count() == 300
    assert {r["DELIVERYID"] for r in output.filter("CLAIMID >= 200").collect()} == {"AFV10D2"}
    labels = frame.filter("CLAIMID < 10").select("CLAIMID", F.lit(1).alias("label"))
    known = jobs.confirmed_scores(spark, root, labels)
    assert known.count() == 300 and known.filter("label = 1").count() == 10
    assert known.filter("PREDICTED_PROB < 0 or PREDICTED_PROB > 1 or PREDICTED_PROB is null").count() == 0


def test_broken_run_is_done_anew(spark, saved, monkeypatch):
    frame, model, root = saved
    monkeypatch.setattr(runs, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        jobs.scoring_run(spark, root, "2020-02-01", frame, model)
    assert runs.published_runs(spark, root) == [] and runs.read_published(spark, root, "output") is None
    monkeypatch.undo()
    assert jobs.scoring_run(spark, root, "2020-02-01", frame, model)["delivered"] == 300
    assert runs.read_published(spark, root, "output", "2020-02-01").count() == 300


def test_missing_inputs_stop_the_job(spark, saved):
    frame, model, root = saved
    with pytest.raises(ValueError, match="kind"):
        jobs.scoring_run(spark, root, "2020-02-01", frame.drop("kind"), model)
    assert runs.published_runs(spark, root) == []
