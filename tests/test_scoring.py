"""The scoring frame on hand-made tables, and a model that is fitted on it, saved and used by the scoring job."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from test_features import codes, frame, tables, ts  # noqa: F401

from lossloom.operators import model as G
from lossloom.plans import jobs
from lossloom.plans import scoring as S
from lossloom.sources import schemas, sinks

AS_OF = "2017-05-21"


@pytest.fixture(scope="module")
def inputs(spark, tables):  # noqa: F811
    notes = frame(spark, schemas.NOTE, [
        dict(ClaimID=1, AuthoringDate=ts("2017-05-10"), Body="Total Loss, soft tissue"), dict(ClaimID=1, AuthoringDate=ts("2017-05-11"), Body="fire (x)"),
        dict(ClaimID=3, AuthoringDate=ts("2017-05-11"), Body="closed claim"), dict(ClaimID=2, AuthoringDate=ts("2017-04-11"), Body=None)])
    return {**tables, "note": notes}


@pytest.fixture(scope="module")
def topics(spark):
    return spark.createDataFrame([(1, *[float(i == 4) for i in range(S.TOPICS)])], ["claimid", *[f"TOPIC_NEW_{i}" for i in range(S.TOPICS)]])


def test_inputs_are_declared_once():
    declared = S.model_inputs()
    assert len(declared) == len({i.name for i in declared}) == len({i.plain_name() for i in declared}) == 187


def test_scoring_frame(inputs, codes, topics):  # noqa: F811
    found = S.scoring_frame(inputs, codes, F.lit(AS_OF).cast("date"), topics)
    assert len(found.columns) == 190 and not [f for f in found.schema.fields[3:] if f.dataType.simpleString() not in ("double", "string")]
    rows = {r["claimid"]: r.asDict() for r in found.collect()}
    assert set(rows) == {1, 2} and not any(v is None for r in rows.values() for n, v in r.items() if n not in ("ClaimNumber", "ReportedDate"))
    one, two = rows[1], rows[2]
    wanted = {
        "REPORT_LAG": 3, "EXPOSUREID": 3, "INCIDENTID": 2, "BI": 1, "COV_ROLLUP_3_AUTO BI": 1, "COV_ROLLUP_3_COLLISION": 2, "COV_ROLLUP_3_NAN": 0,
        "LOSSPARTYID_10001.0": 1, "LOSSPARTYID_10002.0": 2, "LOSSPARTYID_NAN": 0, "CLAIMANTDENORMID_10005": 1, "INSURED_NEW_V": 1, "TP_RENTED": 2,
        "COLLISION_F2": 1, "TOTALLOSS_FINAL": 1, "BODY_NECK": 2, "ISO_ADDRESS": 2, "ISO_VIN": 1, "REAR_END_PC_F": 1, "GLASS_DAMAGE_F": 0,
        "FP_V_AGE": 7, "TP_V_AGE": 50, "PC_ISSUE_REPORT_LAG": 62, "PC_LOSS_EXPRN_LAG": 306, "PREV_RENEWALS": 2, "PREV_POL_CLAIMS": 4,
        "CLM_TENURE": 62, "CLAIM_CNT_NAME_CLM": 1, "CLAIM_CNT_NAME_INS": 2, "AVG_NOTES_PER_DAY": 2 / 21, "TOTAL_FLAG_UNST": 1, "FIRE_FLAG_UNST": 1,
        "FIRE_FLAG_FINAL": 0, "KEY_PHRASE_9": 1, "KEY_PHRASE_0": 0, "LOSS_TIMEOFDAY_0 TO 5": 1, "LOSSCAUSE_GROUP_MOTOR_VEHICLE_ACCIDENT": 1,
        "LITIGATIONSTATUSID_1": 0, "FAULTRATING_0.0": 1, "RESPONSIBLEPARTY_DESC_0": 1, "TOPIC_MODEL_4": 1, "LOSSLOC_ZIP_TP_F": 1, "LOSSLOC_CITY_TP_F": 0,
    }
    assert {n: one[n] for n in wanted if n != "AVG_NOTES_PER_DAY"} == {n: v for n, v in wanted.items() if n != "AVG_NOTES_PER_DAY"}
    assert one["AVG_NOTES_PER_DAY"] == pytest.approx(2 / 21) and one["LOCATIONOFTHEFT_DESC"] == "0"
    # Claim 2: no incident (one missing value), no notes of the month, no topics.
    assert (two["INCIDENTID"], two["AVG_NOTES_PER_DAY"], two["TOPIC_MODEL_4"], two["LOSSCAUSE_GROUP_CATASTROPHE"]) == (1, 0, 0, 1)


def test_missing_source_stops(inputs, codes, topics):  # noqa: F811
    with pytest.raises(ValueError, match="TOPIC_MODEL_3"):
        S.scoring_frame(inputs, codes, F.lit(AS_OF).cast("date"), topics.drop("TOPIC_NEW_3"))


def test_scoring_job_reads_the_frame(spark, inputs, codes, tmp_path):  # noqa: F811
    found = S.scoring_frame(inputs, codes, F.lit(AS_OF).cast("date"), plain=True).withColumnsRenamed(
        {"claimid": "CLAIMID", "ClaimNumber": "CLAIMNUMBER", "ReportedDate": "REPORTEDDATE"}).cache()
    names = [i.plain_name() for i in S.model_inputs(topics=0)]
    numbers = [n for n in names if n != "LOCATIONOFTHEFT_DESC"]
    assert len(names) == 167
    train = found.withColumn("label", (F.col("CLAIMID") == 1).cast("double"))
    sinks.save_model(Pipeline(stages=[*G.encoder(train, ["LOCATIONOFTHEFT_DESC"], numbers).getStages(), LogisticRegression(maxIter=5)]).fit(train), f"{tmp_path}/m")
    run = jobs.scoring_run(spark, f"{tmp_path}/runs", "2017-06-01", found, f"{tmp_path}/m")
    assert (run["scored"], run["delivered"], run["delivery"]) == (2, 2, 1)
    with pytest.raises(ValueError, match="REPORT_LAG"):
        jobs.scoring_run(spark, f"{tmp_path}/runs", "2017-06-08", found.drop("REPORT_LAG"), f"{tmp_path}/m")
