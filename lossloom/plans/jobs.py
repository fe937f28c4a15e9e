"""The recurring scoring job: load the saved model, score every claim, choose the new ones, number the delivery, publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.operators import joins as J
from lossloom.operators import model as G
from lossloom.plans.triage import MODEL_ID, next_delivery, scored_output
from lossloom.sources import readers, runs

KEPT = ("CLAIMID", "CLAIMNUMBER", "REPORTEDDATE")


def model_inputs(model) -> list[str]:
    """Columns that a saved pipeline reads and none of its stages makes."""
    made: set[str] = set()
    wanted: list[str] = []
    for stage in model.stages:
        for many, one in (("inputCols", "inputCol"), ("featuresCol",) * 2):
            for name in dict.fromkeys((many, one)):
                if stage.hasParam(name) and stage.isDefined(name):
                    value = stage.getOrDefault(name)
                    wanted += [c for c in ([value] if isinstance(value, str) else value) if c not in made and c not in wanted]
        for name in ("outputCols", "outputCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
            if stage.hasParam(name) and stage.isDefined(name):
                value = stage.getOrDefault(name)
                made |= {value} if isinstance(value, str) else set(value)
    return wanted


def scoring_run(spark: SparkSession, root: str, run_date: str, frame: DataFrame, model_path: str, keep: Sequence[str] = KEPT,
                key: str = "CLAIMID", model_id: str = MODEL_ID) -> dict:
    """Score `frame` with the saved model and publish one delivery; returns the run's record.

    All rows are scored and stored as `scores` (key, predicted class and probability). Rows whose key is in no earlier published delivery are
    the new ones: they become the `output` table, with the next delivery number. The record is written last. A run whose date is
    already published changes nothing and returns its record, and a run that broke off is done anew, so repeating is safe. Columns that
    the model needs and the frame lacks stop the job before anything is written.
    """
    done = runs.published_run(spark, root, run_date)
    if done is not None:
        return done
    model = readers.load_model(model_path)
    missing = [c for c in [*model_inputs(model), *keep] if c not in frame.columns]
    if missing:
        raise ValueError(f"the scoring frame lacks {missing}")
    scored = G.score(frame, model, list(keep)).withColumnRenamed("predicted_prob", "PREDICTED_PROB")
    scores = runs.stage_table(scored, root, "scores", run_date)
    earlier = [r for r in runs.published_runs(spark, root) if r["run_date"] < run_date]
    rows = spark.read.parquet(scores)
    delivered = spark.read.parquet(*[r["paths"]["output"] for r in earlier]) if earlier else None
    if delivered is not None:
        rows = J.without_members(rows, delivered.select(key), key)
    delivery = next_delivery(delivered)
    output = scored_output(rows.drop("predicted_class"), F.lit(run_date).cast("date"), delivery, model_id)
    path = runs.stage_table(output, root, "output", run_date)
    return runs.publish(spark, root, run_date, {"scores": scores, "output": path}, delivery=delivery, model=model_path,
                        scored=spark.read.parquet(scores).count(), delivered=spark.read.parquet(path).count())


def confirmed_scores(spark: SparkSession, root: str, labels: DataFrame, key: str = "CLAIMID") -> DataFrame:
    """Scores of the last published run beside the labels known by now; claims without a label stay, with a null."""
    last = runs.published_runs(spark, root)[-1]
    return spark.read.parquet(last["paths"]["scores"]).join(labels, key, "left")
