"""Weekly triage: change detection, status history, referral decision, triage sheet and scored output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions.conditional import referral_override
from lossloom.functions.dates import elapsed_days
from lossloom.functions.text import bump_suffix
from lossloom.operators import ordering as O
from lossloom.operators.sets import snapshot_change
from lossloom.session import materialise

# First delivery of a claim that was never delivered, and the columns of the sheet.
FIRST_DELIVERY = "AFV10D10"
MODEL_ID = "AFV10"
SHEET_COLUMNS = {
    "model_id": "Model ID", "delivery_id": "Delivery ID", "claim_number": "Claim Number", "changed_value": "Changed Value",
    "predicted_prob": "Predicted Probability", "classification": "SIU Previous Classification Status",
    "previous_referral_final": "Previous Referral", "referral_final": "Model Referral", "reserve": "Remaining Reserve",
    "member": "Pre-Triage Member", "siu_referral": "SIU Referral old", "siu_referral_new": "SIU Referral",
    "red_flags": "Red Flags", "scoring_date": "Scoring date", "claims_system": "Claims System",
    "jurisdiction": "JurisdictionState", "reported": "ReportedDate", "claim_status": "Claim Status",
    "open_days": "Open Days", "triage_time": "Pre-Triage Time", "triage_indicator": "Triage Indictor",
}


def triage_history(previous_sheet: DataFrame, investigations: DataFrame) -> DataFrame:
    """Last sheet per claim with the investigation status.

    `previous_sheet`: claim_number, previous_referral, model_referral, siu_referral, delivery_id.
    `investigations`: claim_number, classification.
    """
    return previous_sheet.select("claim_number", "previous_referral", "model_referral", "siu_referral", "delivery_id").join(
        investigations.select("claim_number", "classification"), "claim_number", "left")


def referrals(current: DataFrame, previous: DataFrame, scores: DataFrame, history: DataFrame,
              fraction: float = 0.05) -> DataFrame:
    """Scored claims of the current week with change value, history, cut-off and final referral.

    `current` and `previous` are the weekly snapshots, `scores` holds claim_number, predicted_prob, reserve and
    jurisdiction, `history` comes from `triage_history`.
    """
    changes = snapshot_change(current, previous, "claim_number")
    week = (
        scores.join(changes, "claim_number").join(history, "claim_number", "left")
        .fillna(0, ["previous_referral", "model_referral", "siu_referral"]).fillna("0", ["classification"])
    )
    week = week.withColumn("previous_referral_final", F.when(
        (F.col("previous_referral") == 1) | ((F.col("previous_referral") == 0) & (F.col("siu_referral") == 1)), 1).otherwise(0))
    # The cut-off and the sheet read the joined week several times.
    week = O.top_fraction(materialise(week), "predicted_prob", fraction, "referred")
    return week.withColumns({
        "referral_final": referral_override(F.col("referred"), F.col("classification"), F.col("changed_value")),
        "siu_referral_new": F.lit(0),
    })


def triage_sheet(week: DataFrame, as_of: Column, members: Sequence[str], reported: str = "reported") -> DataFrame:
    """Sheet rows: referred claims dealt to the members by falling reserve, the others marked NA."""
    dated = week.withColumns({
        "model_id": F.lit(MODEL_ID),
        "delivery_id": bump_suffix(F.coalesce("delivery_id", F.lit(FIRST_DELIVERY))),
        "scoring_date": F.to_date(as_of), "red_flags": F.lit(""), "claims_system": F.lit("CC"),
        "claim_status": F.lit("Open"), "triage_time": F.lit(""), "triage_indicator": F.lit(0),
        "open_days": elapsed_days(F.col(reported), as_of),
    })
    order = [F.col("reserve").desc(), F.col("claim_number")]
    dealt = O.round_robin(dated.filter("referral_final = 1"), order, members).drop("seq")
    rest = dated.filter("referral_final = 0").withColumn("member", F.lit("NA"))
    return dealt.unionByName(rest)


def sheet_layout(sheet: DataFrame) -> DataFrame:
    """The sheet's columns in order under their printed names."""
    return sheet.select(*[F.col(c).alias(n) for c, n in SHEET_COLUMNS.items() if c in sheet.columns])


def next_delivery(previous_output: DataFrame | None, column: str = "DELIVERYID") -> int:
    """Number after the highest delivery of the output table; 1 for an empty or missing table."""
    if previous_output is None:
        return 1
    last = previous_output.agg(F.max(F.regexp_extract(column, "[0-9]+$", 0).try_cast("int"))).first()[0]
    return (last or 0) + 1


def scored_output(scores: DataFrame, as_of: Column, delivery: int, model_id: str = MODEL_ID) -> DataFrame:
    """Output rows: CLAIMID, CLAIMNUMBER, REPORTEDDATE, PREDICTED_PROB plus the fixed delivery columns."""
    return scores.withColumns({
        "SCORING_DATE": F.to_date(as_of),
        "OPEN_DAYS": elapsed_days(F.col("REPORTEDDATE"), as_of),
        "CLAIM_STATUS": F.lit("Open"), "SIU_Previous_Classification_Status": F.lit(""), "RED_FLAGS": F.lit(""),
        "MODELID": F.lit(model_id), "DELIVERYID": F.lit(f"{model_id}D{delivery}"),
        "PREDICTED_PROB": F.round("PREDICTED_PROB", 4),
    })
