"""The scoring frame: all inputs of the referral model, declared by name, source column and fill, one row per claim."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions import dates as D
from lossloom.functions import text as X
from lossloom.operators import aggregates as A
from lossloom.operators import joins as J
from lossloom.plans import features as B
from lossloom.session import materialise

TOPICS = 20
CLAIMANT_TYPES = tuple(str(c) for c in (*range(10001, 10012), 10014))
PARTIES = ("10001", "10002")

# Coverage categories that the model counts.
CATEGORIES = (
    "ALL OTHER", "AUTO BI", "AUTO PD", "BUILDING", "COLLISION", "COMPREHENSIVE", "CONTENTS", "GL BI", "GL PD", "INLAND MARINE", "LOSS OF USE",
    "MED PAY", "PIP", "RENTAL REIMBURSEMENT", "TOWING AND LABOR", "UIM/UM",
)
# Model input to the column of the assembled claim row that holds it.
RENAMED = {
    "COLLISION_F2": "collision_final", "EXT_LOWIMPACTINCIDENT_F": "Ext_LowImpactIncident", "VEHICLEDRIVEABLE_F": "VehicleDriveable",
    "TOTALLOSS_FINAL": "TotalLoss", "REPORT_LAG": "Report_lag", "EXPOSUREID": "exposure_Count", "PREV_RENEWALS": "prev_renewals",
    "CLM_TENURE": "claimant_tenure_wt", "AVG_NOTES_PER_DAY": "avg_notes_perday", "FOLL_CLOSELY_PC1": "following_closely",
    "INTERSECTION_PC1": "intersection_accident", "PARKED_VEHICLE": "parked_vehicle", "REAR_END_PC_F": "rear_end_pc",
    "SPEED_HEADON_PC_F": "speed_headon_racing", "GLASS_DAMAGE_F": "glass_damage", "THEFT_FLAG_UNST": "THEFT_UNST_F",
    "FIRE_FLAG_UNST": "FIRE_UNST_F", "TOTAL_FLAG_UNST": "TOTAL_LOSS_UNST_F", "CHIRO_FLAG_UNST": "CHIRO_UNST_F",
    "ATTORNEY_FLAG_UNST": "ATTORNEY_UNST_F", "INSURED_NEW_V": "INSURED_NEW_VEH", "TP_NEW_V": "TP_NEW_VEH",
}
# Inputs whose column has the same name, in any case of letters.
SAME_NAME = (
    "BI", "INSURED_OWNED", "TP_OTHER", "INSURED_RENTED", "INSURED_LISTED", "TP_RENTED", "TP_LISTED", "TP_OWNED", "FP_V_AGE", "TP_V_AGE",
    "PC_ISSUE_REPORT_LAG", "PC_REPORT_EXPRN_LAG", "PC_LOSS_EXPRN_LAG", "INCIDENTID", "CLAIM_CNT_NAME_CLM", "CLAIM_CNT_NAME_INS",
    "PREV_POL_CLAIMS", "THEFT_FLAG_FINAL", "FIRE_FLAG_FINAL", "LOCATIONOFTHEFT_DESC",
)
# Inputs that are not 0 where nothing is known.
FILLS = {"CLAIM_CNT_NAME_CLM": 1, "CLAIM_CNT_NAME_INS": 1, "LOCATIONOFTHEFT_DESC": "0"}
# An indicator that the model does not read.
UNREAD = ("EXT_LOCATIONOFLOSS_DESC_0",)


@dataclass(frozen=True)
class Input:
    """A model input: its name, the column that holds it, what stands for a missing value, and its type."""

    name: str
    source: str
    fill: object = 0
    kind: str = "double"

    def plain_name(self) -> str:
        """The name without stops, which ML stages cannot refer to."""
        return self.name.replace(".", "_")

    def column(self, known: Mapping[str, str], plain: bool = False) -> Column:
        """The input from a row with the columns `known` (by lower-case name)."""
        return F.coalesce(F.col(f"`{known[self.source.lower()]}`").cast(self.kind), F.lit(self.fill).cast(self.kind)).alias(
            self.plain_name() if plain else self.name)


def model_inputs(topics: int = TOPICS, phrases: Sequence[str] = X.KEY_PHRASES) -> list[Input]:
    """Every input in a fixed order."""
    named = {**RENAMED, **{n: n for n in SAME_NAME}}
    named |= {f"CLAIMANTDENORMID_{c}": f"CLAIMANTDENORMID_{c}" for c in CLAIMANT_TYPES}
    named |= {f"COV_ROLLUP_3_{c}": f"COV_ROLLUP_3_{c}" for c in (*CATEGORIES, "NAN")}
    named |= {n.upper(): n for n in (*B.MATCH_REASONS, *B.BODY_PARTS)}
    named |= {f"LOSSPARTYID_{p}.0": f"LOSSPARTYID_{p}" for p in PARTIES} | {"LOSSPARTYID_NAN": "LOSSPARTYID_NAN"}
    named |= {f"LOSSLOC_{place}_{side}_F": f"LOSSLOC_{place}_{side}_F" for place in ("CITY", "ZIP", "STATE") for side in ("FP", "TP")}
    for column, values in B.INDICATOR_VALUES.items():
        for value in values:
            name = B.INDICATOR_NAMES.get((column, value), f"{column}_{value}")
            if name not in UNREAD:
                named[name.upper()] = name
    named |= {f"TOPIC_MODEL_{i}": f"TOPIC_NEW_{i}" for i in range(topics)}
    named |= {f"KEY_PHRASE_{i}": f"KEY_PHRASE_NEW_{i}" for i in range(len(phrases))}
    return [Input(n, s, FILLS.get(n, 0), "string" if isinstance(FILLS.get(n), str) else "double") for n, s in named.items()]


def fact_features(fact: DataFrame) -> list[DataFrame]:
    """What the inputs take from the fact, one row a claim: three passes, each with all measures of its kind.

    Counts of rows, maxima and flags (bits of one number) per coverage category, party side, vehicle and location; different rows by vehicle
    kind; distinct incidents, exposures and parties by claimant type, where a missing incident or party is one more.
    """
    category, party, always = F.upper("cov_rollup_3"), F.col("LossParty"), F.lit(True)
    flags = {**B.location_flags(), "BI": F.col("cov_rollup_3").isin(*B.INJURY_CATEGORIES)}
    plain = fact.select("*", category.alias("__category"), *A.flag_masks(list(flags.values()))).groupBy("claimid").agg(
        *[A.count_when(F.col("__category") == c).alias(f"COV_ROLLUP_3_{c}") for c in CATEGORIES], A.count_when(F.col("__category").isNull()).alias("COV_ROLLUP_3_NAN"),
        *[A.count_when(party == p).alias(f"LOSSPARTYID_{p}") for p in PARTIES], A.count_when(party.isNull()).alias("LOSSPARTYID_NAN"),
        F.max("claimant_tenure").alias("claimant_tenure_wt"), *B.vehicle_flag_measures(), *B.side_age_measures(), F.bit_or("__mask0").alias("__mask0"))
    plain = B.clamped_ages(plain).withColumns({n: A.flag_of(i).cast("int") for i, n in enumerate(flags)}).drop("__mask0")
    distinct = A.distinct_counts(fact, ["claimid"], {
        "incidentid": {"INCIDENTID": always}, "exposureid": {"exposure_Count": always},
        "ClaimantDenormID_exp": B.claimant_type_conditions(CLAIMANT_TYPES)}, missing=True)
    return [plain, B.vehicle_kind_counts(fact), distinct]


def policy_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """(PolicyNumber, prev_renewals, PREV_POL_CLAIMS): distinct terms and claims of each policy number."""
    terms = policies.groupBy("PolicyNumber").agg(F.count_distinct("EffectiveDate").alias("prev_renewals"))
    numbered = J.null_spread_join(claims.select("ID", "PolicyID"), policies.select(F.col("ID").alias("PolicyID"), "PolicyNumber"), ["PolicyID"])
    used = numbered.groupBy("PolicyNumber").agg(F.count_distinct("ID").alias("PREV_POL_CLAIMS"))
    return terms.join(used, "PolicyNumber", "left").filter("PolicyNumber is not null")


def name_counts(claims: DataFrame, parties: DataFrame) -> DataFrame:
    """Claims of the claimant's and the insured's name; 0 for a name that no exposure has, null (then 1) without a name."""
    counts = materialise(A.prior_claims(parties.filter("name is not null"), "claimid", "name", "n"))
    out = claims
    hot = J.hot_keys(claims, ["CLAIMANT_NAME"], ["INSURED_NAME"])
    for name, side, large in zip(("CLAIM_CNT_NAME_CLM", "CLAIM_CNT_NAME_INS"), ("CLAIMANT_NAME", "INSURED_NAME"), hot):
        found = counts.select(F.col("name").alias(side), F.col("n").alias(name))
        out = J.folded_join(out, found, [side], large, by=["claimid"])
        out = out.withColumn(name, F.when(F.col(side).isNotNull(), F.coalesce(name, F.lit(0))))
    return out


def claim_head(claims: DataFrame) -> DataFrame:
    """The claim's own inputs: lags, loss hour, words of the description, and the coded columns under the names of their indicators."""
    coded = {
        "CLAIMTIERID": "ClaimTier", "EXT_LOCATIONOFLOSS_DESC": "ext_locationofloss_desc", "LITIGATIONSTATUSID": "LitigationStatus",
        "RESPONSIBLEPARTY_DESC": "responsibleparty_desc", "SUBROGATIONSTATUSID": "SubrogationStatus", "LOCATIONOFTHEFT_DESC": "LocationOfTheft_desc",
    }
    known = {c.lower(): c for c in claims.columns}
    text = lambda c: F.col(known[c.lower()]).cast("string") if c.lower() in known else F.lit(None).cast("string")
    fault = F.coalesce(text("FaultRating").try_cast("double").cast("string"), F.lit("0"))
    described = F.upper(F.coalesce("Description", F.lit("")))
    day = D.day_difference
    head = claims.select(
        "claimid", "ClaimNumber", "ReportedDate", *[c for c in ("CLAIM_CNT_NAME_CLM", "CLAIM_CNT_NAME_INS", "prev_renewals", "PREV_POL_CLAIMS")],
        day(F.col("LossDate"), F.col("ReportedDate")).alias("Report_lag"),
        day(F.col("EffectiveDate"), F.col("ReportedDate")).alias("PC_ISSUE_REPORT_LAG"),
        day(F.col("ReportedDate"), F.col("ExpirationDate")).alias("PC_REPORT_EXPRN_LAG"),
        day(F.col("LossDate"), F.col("ExpirationDate")).alias("PC_LOSS_EXPRN_LAG"),
        *[X.contains_any(described, X.RED_FLAG_WORDS[g]).alias(f"{g.upper()}_FLAG_FINAL") for g in ("theft", "fire")],
        *[F.coalesce(text(c), F.lit("0")).alias(n) for n, c in coded.items()], fault.alias("FAULTRATING"),
        D.quarter_day(F.col("LossDate")).alias("LOSS_TIMEOFDAY"), F.coalesce(F.upper(text("losscause_group")), F.lit("0")).alias("LOSSCAUSE_GROUP"))
    return B.with_indicators(head)


def input_frame(claims: DataFrame, fact: DataFrame, parts: Sequence[DataFrame], inputs: Sequence[Input], plain: bool = False) -> DataFrame:
    """claimid, ClaimNumber, ReportedDate and every input of `claims`, one row each.

    `parts` hold further columns, one row a claim. A source that no part has stops the job with its name; a claim that a part lacks
    gets the input's fill.
    """
    wide = J.assemble_packed(claim_head(claims), "claimid", [*fact_features(fact), *parts])
    known = {c.lower(): c for c in wide.columns}
    missing = sorted(i.name for i in inputs if i.source.lower() not in known)
    if missing:
        raise ValueError(f"no column for {missing}")
    return wide.select("claimid", "ClaimNumber", "ReportedDate", *[i.column(known, plain) for i in inputs])


def scoring_frame(tables: Mapping[str, DataFrame], codes: Mapping[str, DataFrame], as_of: Column, topics: DataFrame | None = None,
                  topic_count: int = TOPICS, plain: bool = False) -> DataFrame:
    """One row per open claim with its number, report date and all inputs of the referral model.

    `tables` as in claim_features(), and note (ClaimID, AuthoringDate, Body). `topics` holds claimid and TOPIC_NEW_0 and so on, from the saved topic
    model; without it the topic inputs are left out. With `plain` names have no stops, as ML stages want it.
    """
    claims, policies = tables["claim"], tables["policy"]
    base = materialise(B.claim_base(claims, tables["address"], codes))
    fact = B.exposure_fact(base, tables["exposure"], policies, tables["incident"], tables["vehicle"], tables["exposure_report"], tables["contact"],
                           tables["address"], codes)
    parties = materialise(B.party_events(tables["exposure"], claims, policies, tables["contact"]))
    fact = B.with_party_history(B.exposure_measures(fact, as_of), parties, policies)
    fact = materialise(B.with_coverage(fact, tables["coverage_map"]))
    role = lambda key, name: tables["contact"].select(F.col("ID").alias(key), F.upper("Name").alias(name))
    head = J.null_spread_join(base, role("ClaimantDenormID", "CLAIMANT_NAME"), ["ClaimantDenormID"])
    head = J.null_spread_join(head, role("InsuredDenormID", "INSURED_NAME"), ["InsuredDenormID"])
    terms = policies.select(F.col("ID").alias("PolicyID"), "PolicyNumber", "EffectiveDate", "ExpirationDate")
    head = J.folded_join(J.null_spread_join(head, terms, ["PolicyID"]), policy_claims(claims, policies), ["PolicyNumber"], by=["claimid"])
    head = name_counts(materialise(head), parties)
    open_ids = base.select(F.col("claimid").alias("ClaimID"))
    mine = lambda t: J.with_members(tables[t], open_ids, "ClaimID")
    notes = mine("note")
    parts = [
        B.collision_flags(J.with_members(claims, open_ids.withColumnRenamed("ClaimID", "ID"), "ID"), fact, contains_form=True),
        B.body_part_counts(mine("incident"), tables["body_part"]), B.match_reason_counts(mine("match_report")),
        B.contributing_factors(mine("contributing_factor")), B.note_flags(notes), B.notes_per_day(notes, claims, as_of),
    ]
    if topics is not None:
        parts.append(topics)
    return input_frame(head, fact, parts, model_inputs(topic_count if topics is not None else 0), plain)
