"""Claim features: claim base, exposure fact, party history and one wide row per claim.

Every per-claim result is folded to one row per claim before it is attached, so a claim with very many exposures,
notes or reports sends partial aggregates through the shuffle, not rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions import conditional as C
from lossloom.functions import dates as D
from lossloom.functions import maths as M
from lossloom.functions import text as X
from lossloom.operators import aggregates as A
from lossloom.operators import filters as L
from lossloom.operators import joins as J
from lossloom.operators import ordering as O
from lossloom.session import materialise

# Loss-cause label to group.
LOSS_CAUSE_GROUPS = {
    "Converted": "Converted",
    "Motor Vehicle Accident": "Motor_vehicle_accident",
    "Glass Damage Other Than Breakage": "Glass_Damage",
    "Motor Vehicle Damage Other Than Collision": "Motor_vehicle_accident",
    "Towing and Labor": "Towing_and_Labor",
    "Weather Event": "Catastrophe",
    "Animal Caused Damage or Injury": "Animal",
    "Fire Damage": "Fire_or_Explosion",
    "Struck by Falling Object": "Non_accident_damage",
    "Loading Or Unloading Damage": "Non_accident_damage",
    "Animal Damage or Injury": "Animal",
    "Mechanical Defect Or Failure": "Non_accident_damage",
    "Negligent Maintenance": "Non_accident_damage",
    "Water Damage": "Water_Damage",
    "Hanging Lines Struck": "Non_accident_damage",
    "Flood": "Catastrophe",
    "Weight Overload of Equipment": "Non_accident_damage",
    "Pollution - Environmental Damage": "Non_accident_damage",
    "Water Vehicle Crash": "Motor_vehicle_accident",
    "Explosion / Blowout or Cratering": "Fire_or_Explosion",
    "Riot Civil Commotion & Strike": "Human_violence",
    "Collapse / Sinkhole / Subsidence": "Non_accident_damage",
    "Volcanic Action": "Catastrophe",
    "Earth Movement / Landslide": "Catastrophe",
    "Vandalism and or Malicious Mischief": "Human_violence",
    "Water Vehicle Marine Perils": "Water_Damage",
    "Earthquake": "Catastrophe",
    "Terrorism Loss": "Human_violence",
}

# Coverage categories and the columns that count them.
COVERAGE_COLUMNS = {
    "AUTO_BI": "Auto BI", "AUTO_PD": "Auto PD", "AUTO_COLLISION": "Collision", "COMPREHENSIVE": "COMPREHENSIVE",
    "MEDPAY": "Med Pay", "PIP": "PIP", "RENTAL_REIMB": "Rental Reimbursement", "TOW_LABOR": "Towing and Labor",
    "ALL_OTHER": "All Other", "BUILDING": "Building", "CONTENTS": "Contents", "GL_BI": "GL BI", "GL_PD": "GL PD",
}
PD_CATEGORIES = ("Auto PD", "COMPREHENSIVE", "Collision", "Rental Reimbursement", "Towing and Labor", "NULL", "GL BI",
                 "GL PD", "Contents", "All Other", "Building")
INJURY_CATEGORIES = ("Auto BI", "PIP", "Med Pay")

# Body-part, match-reason, contributing-factor, claimant-type, exposure-type and vehicle-type codes.
BODY_PARTS = {
    "Body_Head": "10001", "Body_Neck": "10002", "Body_Upper_ext": "10003", "Body_Trunk": "10004",
    "Body_Lower_ext": "10005", "Body_Unknown": "10006", "Body_Multiple": "10007",
}
MATCH_REASONS = {
    "ISO_address": "A", "ISO_DL": "D", "ISO_Licenseplatenumber": "L", "ISO_Losslocation": "LL", "ISO_Name": "N",
    "ISO_Phone": "P", "ISO_SSN": "S", "ISO_VIN": "V",
}
CONTRIBUTING_FACTORS = {
    "glass_damage": ("10077", "10078", "10079"), "rear_end_pc": ("10153", "10024"), "intersection_accident": ("10094",),
    "speed_headon_racing": ("10083", "10154", "10169"), "parked_vehicle": ("10141",), "following_closely": ("10069",),
}
CLAIMANT_TYPES = {
    "Insured_c_cnt": "10001", "MOIH_cnt": "10002", "DOIV_cnt": "10003", "OOV_cnt": "10004", "DOV_cnt": "10005",
    "OCIV_cnt": "10006", "OCOV_cnt": "10007", "PED_cnt": "10008", "Other_third_cnt": "10014",
}
EXPOSURE_TYPES = {
    "Expo_BI": "1", "Expo_Pers_Prop": "3", "Expo_Property": "4", "Expo_Vehicle": "5", "Expo_General": "9",
    "Expo_PIP": "10", "Expo_MEDPAY": "11", "Expo_tow_labr": "10009",
}
VEHICLE_KINDS = {
    "New_veh": ("10003",), "rented": ("10005", "10006"), "owned": ("10004",), "listed": ("10002",), "other": ("10009",),
}
PARTY_SIDES = {"Insured": "10001", "Thirdparty": "10002"}
VEHICLE_FLAGS = ("VehicleDriveable", "Ext_EntireSideDamaged", "VehicleParked", "TotalLoss", "Ext_LowImpactIncident")
RECOVERIES = {
    "credit_to_expense_rec": "Ext_ITDCreditToExpenseRecovery", "credit_to_loss_rec": "Ext_ITDCreditToLossRecovery",
    "deductible_rec": "Ext_ITDDeductibleRecovery", "Total_Paid": "Ext_ITDPaid", "total_recovered": "Ext_ITDRecovered",
    "salvage_rec": "Ext_ITDSalvageRecovery", "subro_rec": "Ext_ITDSubrogationRecovery",
}

# Named values that get an indicator column of their own.
INDICATOR_VALUES = {
    "CLAIMTIERID": ("10002", "10004", "10005", "-1"),
    "EXT_LOCATIONOFLOSS_DESC": (
        "0", "In Transit - Motor Vehicles", "Premises of Others", "Insured's Premises",
        "In Transit - Messengers/Salesman", "In Transit - Air/Waterborne", "In Transit - Railroad",
        "In Transit - Surface Mail"),
    "FAULTRATING": ("0", "10005.0", "10003.0", "10001.0", "10004.0", "-1.0", "10002.0"),
    "LITIGATIONSTATUSID": ("3", "-1", "1", "2", "10002"),
    "RESPONSIBLEPARTY_DESC": (
        "0", "Unknown", "Insured", "Other", "Vandals, Vagrants, Criminals", "Employee", "Additional Insured",
        "Family Member", "Tenant", "Customer", "Subcontractor", "Vendor", "Public Protection"),
    "SUBROGATIONSTATUSID": ("-1", "10001", "10002"),
    "LOSS_TIMEOFDAY": ("0 to 5", "18 to 23", "6 to 11", "12 to 17"),
    "LOSSCAUSE_GROUP": (
        "CONVERTED", "ANIMAL", "MOTOR_VEHICLE_ACCIDENT", "CATASTROPHE", "NON_ACCIDENT_DAMAGE", "TOWING_AND_LABOR",
        "GLASS_DAMAGE", "FIRE_OR_EXPLOSION", "WATER_DAMAGE", "OTHER", "0", "HUMAN_VIOLENCE", "THEFT"),
}
INDICATOR_NAMES = {("FAULTRATING", "0"): "FAULTRATING_0.0"}

# Claim column, code table, label: the decodes of the claim base.
CLAIM_DECODES = (
    ("LOBCode", "lobcode", "LOBcode_desc"), ("State", "claimstate", "claim_status_desc"),
    ("Ext_ResponsibleParty", "responsibleparty", "responsibleparty_desc"),
    ("SubrogationStatus", "subrogationstatus", "SubrogationStatus_desc"), ("SIUStatus", "siustatus", "SIUStatus_desc"),
    ("Ext_LossLocState", "state", "Ext_LossLocState_desc"), ("JurisdictionState", "state", "JurisdictionState_desc"),
    ("LossType", "losstype", "LossType_desc"), ("LocationOfTheft", "locationoftheft", "LocationOfTheft_desc"),
    ("LitigationStatus", "litigationstatus", "litigationstatus_desc"), ("LossCause", "losscause", "LossCause_desc"),
    ("ISOStatus", "isostatus", "isostatus_desc"),
    ("SIULifeCycleState", "claimlifecyclestate", "SIULifeCycleState_desc"),
    ("Ext_LocationofLoss", "locationofloss", "ext_locationofloss_desc"),
)


def _prefixed(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in columns])


def claim_base(claims: DataFrame, addresses: DataFrame, codes: Mapping[str, DataFrame]) -> DataFrame:
    """Open claims with decoded codes, loss location, report lag and loss-cause group; litigated claims are out."""
    base = L.open_claims(claims)
    lookups = {column: (codes[table], label) for column, table, label in CLAIM_DECODES if table in codes}
    location = _prefixed(addresses, "lossloc_", ["ID", "City", "PostalCode", "State", "AddressLine1"])
    base = J.null_spread_join(
        J.decode(base, lookups), location.withColumnRenamed("lossloc_ID", "LossLocationID"), ["LossLocationID"])
    base = base.withColumns({
        "Report_lag": D.day_difference(F.col("LossDate"), F.col("ReportedDate")),
        "losscause_group": C.recode(F.trim("LossCause_desc"), LOSS_CAUSE_GROUPS) if "losscause" in codes
        else F.lit(None).cast("string"),
    })
    if "litigationstatus" in codes:
        base = base.filter(L.not_in_or_null(F.col("litigationstatus_desc"), L.LITIGATED_LABELS))
    return base.withColumnsRenamed({"ID": "claimid", "State": "claim_status_code"})


def exposure_fact(base: DataFrame, exposures: DataFrame, policies: DataFrame, incidents: DataFrame, vehicles: DataFrame,
                  reports: DataFrame, contacts: DataFrame, addresses: DataFrame, codes: Mapping[str, DataFrame]) -> DataFrame:
    """One row per exposure of the base claims, with policy, incident, vehicle, report, contacts and address."""
    exposure = exposures.select(
        F.col("ID").alias("exposureid"), F.col("ClaimID").alias("claimid"), F.col("IncidentID").alias("incidentid"),
        "CoverageID", "PrimaryCoverage", "CoverageSubType", "ExposureType", "LossParty", "ClaimantType",
        F.col("ClaimantDenormID").alias("ClaimantDenormID_exp"))
    exposure = J.decode(exposure, {c: (codes[t], n) for c, t, n in (
        ("LossParty", "losspartytype", "lossparty_desc"), ("ClaimantType", "claimanttype", "ClaimantType_DESC"),
        ("CoverageSubType", "coveragesubtype", "covsub_desc"), ("PrimaryCoverage", "coveragetype", "coveragetype_desc"),
        ("ExposureType", "exposuretype", "exposuretype_desc")) if t in codes})
    policy = policies.withColumnRenamed("ID", "PolicyID")
    policy = J.decode(policy, {c: (codes[t], n) for c, t, n in (
        ("ext_broadlobcode", "broadlobcode", "ext_broadlobcode_desc"),
        ("Ext_UWrtSubLOBCodes", "sublobcode", "Ext_UWrtSubLOBCodes_desc")) if t in codes})
    incident = incidents.drop("ClaimID").withColumnRenamed("ID", "incidentid")
    vehicle = vehicles.select(F.col("ID").alias("VehicleID"), "Make", "Model", "Vin", F.col("Year").alias("vehicle_year"))
    incident = J.null_spread_join(incident, vehicle, ["VehicleID"])
    contact = contacts.select(
        F.col("ID").alias("ClaimantDenormID_exp"), F.upper("Name").alias("Name"), "DateOfBirth", "Gender", "Occupation",
        F.col("PrimaryAddressID").alias("PrimaryAddressID"))
    place = addresses.select(
        F.col("ID").alias("PrimaryAddressID"), F.col("City").alias("contact_City"),
        F.col("PostalCode").alias("contact_PostalCode"), F.col("State").alias("contact_State"))
    contact = J.null_spread_join(contact, place, ["PrimaryAddressID"])
    role = lambda key, name: contacts.select(F.col("ID").alias(key), F.upper("Name").alias(name))
    claims = J.null_spread_join(base, role("InsuredDenormID", "INSURED_NAME"), ["InsuredDenormID"])
    claims = J.null_spread_join(claims, role("ClaimantDenormID", "CLAIMANT_NAME"), ["ClaimantDenormID"])
    claims = J.null_spread_join(claims, policy, ["PolicyID"])
    fact = exposure.join(claims, "claimid")
    fact = J.null_spread_join(fact, incident, ["incidentid"])
    fact = fact.join(reports, "exposureid", "left")
    fact = J.null_spread_join(fact, contact, ["ClaimantDenormID_exp"])
    return fact.withColumn("final_name", C.exposure_name(
        F.col("Name"), F.col("CLAIMANT_NAME"), F.col("INSURED_NAME"), F.col("LossParty")))


def exposure_measures(fact: DataFrame, as_of: Column) -> DataFrame:
    """Ages, policy lags, open days, location matches and incurred amounts of each exposure."""
    c = F.col
    return fact.withColumns({
        "vehicle_age": D.vehicle_age(c("LossDate"), c("vehicle_year")),
        "PC_issue_report": D.day_difference(c("EffectiveDate"), c("ReportedDate")),
        "PC_report_expire": D.day_difference(c("ReportedDate"), c("ExpirationDate")),
        "report_interval": D.inside(c("ReportedDate"), c("EffectiveDate"), c("ExpirationDate")),
        "Claim_Opening_days": D.open_days(c("ReportedDate"), c("CloseDate"), as_of),
        "postal_code_match": C.equal_indicator(c("lossloc_PostalCode"), c("contact_PostalCode")),
        "city_match": C.equal_indicator(c("lossloc_City"), c("contact_City")),
        "state_match": C.equal_indicator(c("lossloc_State"), c("contact_State")),
        "TotalIncurredNet": M.incurred_net(c("OpenReserves"), c("TotalPayments"), c("TotalRecoveries")),
        "TotalIncurredGross": M.incurred_gross(c("OpenReserves"), c("TotalPayments")),
    })


def party_events(exposures: DataFrame, claims: DataFrame, policies: DataFrame, contacts: DataFrame) -> DataFrame:
    """Every exposure's party with its claim, report date and policy dates: the history behind the party features."""
    exposure = exposures.select(F.col("ClaimID").alias("claimid"), F.col("ClaimantDenormID").alias("party_id"))
    claim = claims.select(F.col("ID").alias("claimid"), F.col("ReportedDate").alias("reported"), "PolicyID")
    policy = policies.select(F.col("ID").alias("PolicyID"), F.col("OrigEffectiveDate").alias("original"),
                             F.col("EffectiveDate").alias("effective"))
    contact = contacts.select(F.col("ID").alias("party_id"), F.upper("Name").alias("name"))
    claim = J.null_spread_join(claim, policy, ["PolicyID"])
    return J.null_spread_join(exposure.join(claim, "claimid", "left"), contact, ["party_id"])


def previous_claims(df: DataFrame, parties: DataFrame, name: str = "Pre_claims_cnt", hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Claims of the same party: by name, else by party id among parties without a name, else 0."""
    by_name = A.prior_claims(parties, "claimid", "name", name)
    by_id = A.prior_claims(parties.filter(F.col("name").isNull()), "claimid", "party_id", name)
    return J.lookup_fallback(df, by_name, "name", by_id, "party_id", name, default=0, hot=hot)


def party_tenure(df: DataFrame, parties: DataFrame, first_year: int = 1991, hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Days and years between a party's oldest valid policy date and the report.

    The date is the one of the name, else of the party id among parties without a usable name, else of the row's
    own policy. `df` carries name, party_id, reported, original and effective.
    """
    dated = parties.withColumn("__oldest", D.oldest_valid(F.col("original"), F.col("effective"), first_year))
    known, unknown = L.split_named(dated, "name")
    by_name = known.groupBy("name").agg(F.min("__oldest").alias("__by_name"))
    by_id = unknown.filter(F.col("party_id").isNotNull()).groupBy("party_id").agg(F.min("__oldest").alias("__by_id"))
    hot = hot or dict(zip(("name", "party_id"), J.hot_keys(df, ["name"], ["party_id"])))
    joined = J.folded_join(J.folded_join(df, by_name, ["name"], hot["name"]), by_id, ["party_id"], hot["party_id"])
    one, two, original = F.col("__by_name"), F.col("__by_id"), F.col("original")
    party_date = (
        F.when(F.year(one) >= first_year, one)
        .when((F.year(one) < first_year) & two.isNull(), original)
        .otherwise(two)
    )
    date = F.coalesce(party_date, F.when(F.year(original) >= first_year, original),
                      F.when(F.year(original) < first_year, F.col("effective")))
    return joined.withColumn("__date", date).withColumns({
        "claimant_tenure": D.day_difference(F.col("__date"), F.col("reported")),
        "claimant_tenure_yr": D.year_difference(F.col("__date"), F.col("reported"), zero_as_one=True),
    }).drop("__by_name", "__by_id", "__date")


def previous_claim_gap(df: DataFrame, parties: DataFrame, name: str = "prev_claim_duration",
                       hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Longest gap in days between the party's claims, by name, else by party id, else 0.

    Only a maximum per claim is used downstream, so the longest gap per party is attached instead of one row per
    gap; rows are not multiplied.
    """
    known, unknown = L.split_named(parties, "name")
    by_name = O.longest_gap(known, "name", "reported", name)
    by_id = O.longest_gap(unknown, "party_id", "reported", name)
    return J.lookup_fallback(df, by_name, "name", by_id, "party_id", name, default=0, hot=hot)


def with_party_history(fact: DataFrame, parties: DataFrame, policies: DataFrame) -> DataFrame:
    """Previous claims, prior renewals, tenure, claims per year and gap for each exposure; hot names, parties and policies are counted once."""
    renewals = policies.groupBy("PolicyNumber").agg(F.count_distinct("EffectiveDate").alias("prev_renewals"))
    keyed = fact.withColumns({
        "name": F.col("final_name"), "party_id": F.col("ClaimantDenormID_exp"), "reported": F.col("ReportedDate"),
        "original": F.col("OrigEffectiveDate"), "effective": F.col("EffectiveDate")})
    hot = dict(zip(("name", "party_id", "PolicyNumber"), J.hot_keys(keyed, ["name"], ["party_id"], ["PolicyNumber"])))
    out = previous_claims(keyed, parties, hot=hot)
    out = J.folded_join(out, renewals, ["PolicyNumber"], hot["PolicyNumber"])
    out = previous_claim_gap(party_tenure(out, parties, hot=hot), parties, hot=hot)
    return out.withColumn("PREV_CLM_PER_YR", M.rounded_ratio(F.col("Pre_claims_cnt"), F.col("claimant_tenure_yr"))).drop(
        "name", "party_id", "reported", "original", "effective")


def with_coverage(fact: DataFrame, coverage_map: DataFrame) -> DataFrame:
    """Coverage category by (coverage, exposure type), first line of the map first, and amounts by class."""
    lookup = coverage_map.select(
        F.trim("PrimaryCoverage").alias("__coverage"), F.col("exposuretype_desc").alias("__type"), "cov_rollup_3", "line")
    lookup = J.first_match_table(lookup, ["__coverage", "__type"], "cov_rollup_3", "line")
    joined = fact.join(
        lookup, (F.trim("PrimaryCoverage") == F.col("__coverage")) & (F.col("exposuretype_desc") == F.col("__type")), "left"
    ).drop("__coverage", "__type")
    gross, category = F.col("TotalIncurredGross"), F.col("cov_rollup_3")
    zero = F.lit(0).cast("decimal(18,2)")
    return joined.withColumns({
        "BI_Amount": F.when(category.isin("Auto BI", "PIP"), gross).otherwise(zero)
        + F.when((category == "Med Pay") & (F.col("LossParty") == "10002"), gross).otherwise(zero),
        "PD_Amount": F.when(category.isin(*PD_CATEGORIES), gross).otherwise(zero),
    })


def with_region(claims: DataFrame, state_map: DataFrame) -> DataFrame:
    """Abbreviation, region and division of the loss state; null where the map (one row a state) has none."""
    places = state_map.select(F.upper(F.trim("lossloc_State")).alias("__state"), "STATE_ABBR", "REGION", "DIVISION").dropDuplicates(["__state"])
    if places.limit(J.FIXED_ROWS_LIMIT + 1).count() <= J.FIXED_ROWS_LIMIT:
        places = F.broadcast(places)
    return claims.join(places, F.upper(F.trim("lossloc_State")) == F.col("__state"), "left").drop("__state")


def coverage_rollup(fact: DataFrame) -> DataFrame:
    """Exposures per coverage category, injury indicator and the two exclusivity flags."""
    counts = fact.groupBy("claimid").agg(
        *A.one_hot_sum(F.col("cov_rollup_3"), COVERAGE_COLUMNS),
        A.any_in(F.col("cov_rollup_3"), INJURY_CATEGORIES).alias("BI"))
    alone = lambda name: C.only_flag(F.col(name), [F.col(c) for c in COVERAGE_COLUMNS if c != name])
    return counts.withColumns({"comprehensive_only": alone("COMPREHENSIVE"), "collision_only": alone("AUTO_COLLISION")})


def body_part_counts(incidents: DataFrame, body_parts: DataFrame) -> DataFrame:
    parts = incidents.select(F.col("ID").alias("IncidentID"), F.col("ClaimID").alias("claimid")).join(
        body_parts, "IncidentID", "left")
    return parts.groupBy("claimid").agg(*[
        A.count_when(F.col("PrimaryBodyPart") == code).alias(name) for name, code in BODY_PARTS.items()])


def collision_flags(claims: DataFrame, fact: DataFrame, contains_form: bool = False) -> DataFrame:
    """Collision and rear-end flags of a claim from its description or any of its incidents.

    Written for the claims of the fact. `COLI` counts only at the end of the text unless `contains_form`.
    """
    text = F.upper(F.col("Description"))
    rear = text.contains("REAR") | text.contains("RAE")
    coli = text.contains("COLI") if contains_form else text.endswith("COLI")
    described = claims.select(
        F.col("ID").alias("claimid"), C.indicator(rear).alias("__rear"),
        C.indicator(rear | text.contains("COLL") | coli).alias("__coll"))
    incidents = fact.groupBy("claimid").agg(
        A.any_when(F.col("Ext_RearEndCollision") == 1).alias("__rear_inc"),
        A.any_when(F.col("Collision") == 1).alias("__coll_inc"))
    return described.join(incidents, "claimid").select(
        "claimid", F.greatest("__rear", "__rear_inc").alias("rear_collision_final"),
        F.greatest("__coll", "__coll_inc").alias("collision_final"))


def vehicle_flag_measures() -> list[Column]:
    return [A.tri_state(F.col(f)).alias(f) for f in VEHICLE_FLAGS]


def vehicle_flags(fact: DataFrame) -> DataFrame:
    """Five tri-state flags per claim in one pass."""
    return fact.groupBy("claimid").agg(*vehicle_flag_measures())


def match_reason_list(reports: DataFrame) -> DataFrame:
    """Distinct match reasons per claim as one sorted text."""
    codes = reports.select(F.col("ClaimID").alias("claimid"), F.explode(X.limited_split(F.col("MatchReasons"))).alias("code"))
    return A.code_list(codes, "claimid", "code", name="iso_concat")


def match_reason_counts(reports: DataFrame) -> DataFrame:
    """Reports per claim that carry each reason; a reason repeated inside one report counts once."""
    codes = reports.select(
        F.col("ClaimID").alias("claimid"), F.explode(F.array_distinct(X.limited_split(F.col("MatchReasons")))).alias("code"))
    return codes.groupBy("claimid").agg(*A.one_hot_sum(F.col("code"), MATCH_REASONS))


def claim_measures(fact: DataFrame) -> DataFrame:
    """Sums, maxima, distinct counts and conditional distinct counts per claim."""
    party, kind, vehicle = F.col("LossParty"), F.col("ClaimantType"), F.col("VehicleType")
    sums = ("RemainingReserves", "TotalPayments", "TotalRecoveries", "FuturePayments", "OpenReserves", "TotalIncurredNet",
            "TotalIncurredGross", "BI_Amount", "PD_Amount")
    maxima = {"max_speed": "Speed", "max_vehicle_age": "vehicle_age", "max_Pre_claims_cnt": "Pre_claims_cnt",
              "claimant_tenure_wt": "claimant_tenure", "previous_claim_duration": "prev_claim_duration",
              "MAX_PREV_CLM_PER_YR": "PREV_CLM_PER_YR"}
    # A distinct count of the claim itself inside its own group is 0 or 1, hence a flag.
    flags = {f"{label}_{suffix}": (party == side) & vehicle.isin(*types)
             for suffix, types in VEHICLE_KINDS.items() for label, side in PARTY_SIDES.items()}
    flags |= {f"{label.lower()}_{short}_match": (party == side) & (F.col(f"{place}_match") == 1)
              for place, short in (("postal_code", "postal"), ("city", "city"), ("state", "state"))
              for label, side in PARTY_SIDES.items()}
    masks = [f"__mask{i}" for i in range(-(-len(flags) // A.MASK_BITS))]
    plain = fact.select("claimid", *sums, *maxima.values(), *A.flag_masks(list(flags.values()))).groupBy("claimid").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(n) for n, c in maxima.items()], *[F.bit_or(m).alias(m) for m in masks])
    plain = plain.withColumns({n: A.flag_of(i).cast("int") for i, n in enumerate(flags)}).drop(*masks)
    always = F.lit(True)
    distinct = A.distinct_counts(fact, ["claimid"], {
        "exposureid": {"exposure_Count": always,
                       **{n: F.col("ExposureType") == v for n, v in EXPOSURE_TYPES.items()}},
        "incidentid": {"incident_Count": always},
        "VehicleID": {"vehicle_count": always},
        "ClaimantDenormID_exp": {
            "claimant_count": always, "Injured_passengers": F.col("BI_Amount") > 0, "insured_cnt": party == "10001",
            "thirdparty_cnt": party == "10002", **{n: kind == v for n, v in CLAIMANT_TYPES.items()}},
    })
    return plain.join(distinct, "claimid")


def recovery_amounts(reserve_lines: DataFrame) -> DataFrame:
    return reserve_lines.groupBy(F.col("ClaimID").alias("claimid")).agg(*[F.sum(c).alias(n) for n, c in RECOVERIES.items()])


def contributing_factors(factors: DataFrame) -> DataFrame:
    return factors.groupBy(F.col("ClaimID").alias("claimid")).agg(*[
        A.any_in(F.col("PriContributingFactors"), values).alias(name) for name, values in CONTRIBUTING_FACTORS.items()])


def reserve_and_payment(claims: DataFrame, transactions: DataFrame) -> DataFrame:
    """Reserve and payment totals per claim; 0 for claims without such transactions."""
    kind, amount = F.col("TransactionType"), F.col("TransactionAmount")
    totals = (
        transactions.filter(kind.isin("Payment", "Reserve")).groupBy("ClaimNumber")
        .agg(A.sum_when(kind == "Reserve", amount).alias("RESERVE"), A.sum_when(kind == "Payment", amount).alias("PAYMENT"))
    )
    joined = J.null_spread_join(claims.select(F.col("ID").alias("claimid"), "ClaimNumber"), totals, ["ClaimNumber"])
    return joined.select("claimid", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("RESERVE", "PAYMENT")])


def side_age_measures() -> list[Column]:
    age = lambda side: F.when(F.coalesce(F.col("LossParty"), F.lit("0")) == side, F.col("vehicle_age")).otherwise(0)
    return [F.max(age("10001")).alias("FP_V_AGE"), F.max(age("10002")).alias("TP_V_AGE")]


def clamped_ages(oldest: DataFrame) -> DataFrame:
    return oldest.withColumns({n: M.clamp(F.col(n), 0, 50, default=4) for n in ("FP_V_AGE", "TP_V_AGE")})


def vehicle_age_by_side(fact: DataFrame) -> DataFrame:
    """Oldest vehicle of each side: 0 for the other side's rows, 4 when unknown, kept inside 0..50."""
    return clamped_ages(fact.groupBy("claimid").agg(*side_age_measures()))


def location_flags() -> dict[str, Column]:
    flags = {}
    for label, flag in (("CITY", "city_match"), ("ZIP", "postal_code_match"), ("STATE", "state_match")):
        first, third = ((F.col("LossParty") == side) & (F.col(flag) == 1) for side in ("10001", "10002"))
        flags |= {f"LOSSLOC_{label}_FP_F": first, f"LOSSLOC_{label}_TP_F": third, f"LOSSLOC_{label}_FP_TP_F": first | third}
    return flags


def location_matches(fact: DataFrame) -> DataFrame:
    """Does the party's address match the loss location, per side and for either side."""
    return fact.groupBy("claimid").agg(*[A.any_when(c).alias(n) for n, c in location_flags().items()])


def vehicle_kind_counts(fact: DataFrame) -> DataFrame:
    """Different rows of a claim per party side and vehicle kind."""
    rows = fact.select("claimid", "exposureid", "incidentid", F.col("ClaimantDenormID_exp").alias("party"), "LossParty",
                       "cov_rollup_3", "ClaimantType", "VehicleType").distinct()
    return rows.groupBy("claimid").agg(*[
        F.sum(C.indicator((F.col("LossParty") == side) & F.col("VehicleType").isin(*codes))).alias(f"{label}_{suffix}".upper())
        for suffix, codes in VEHICLE_KINDS.items() for label, side in (("INSURED", "10001"), ("TP", "10002"))])


def claimant_type_conditions(types: Sequence[str]) -> dict[str, Column]:
    return {f"CLAIMANTDENORMID_{c}": F.col("ClaimantType") == c for c in types}


def party_counts(fact: DataFrame, types: Sequence[str] = tuple(str(c) for c in (*range(10001, 10012), 10014))) -> DataFrame:
    """Distinct parties per claimant type (a missing party counts as one) and rows per party side and vehicle kind."""
    by_type = A.distinct_counts(fact, ["claimid"], {"ClaimantDenormID_exp": claimant_type_conditions(types)}, missing=True)
    return vehicle_kind_counts(fact).join(by_type, "claimid", "left")


def injured_counts(fact: DataFrame, exclude_default: bool = False) -> DataFrame:
    """Distinct parties per side on claims with an injury coverage. Every other row stands for the id 0, which
    counts as one more value unless `exclude_default`."""
    party, side = F.col("ClaimantDenormID_exp"), F.col("LossParty")
    sides = {"FP_INJURED_CNT": "10001", "TP_INJURED_CNT": "10002"}
    zero = {n: F.coalesce(party == 0, F.lit(False)) & (side == v) for n, v in sides.items()}
    if not exclude_default:
        zero = {n: z | ~F.coalesce(side == sides[n], F.lit(False)) for n, z in zero.items()}
    flags = fact.groupBy("claimid").agg(
        A.any_in(F.col("cov_rollup_3"), INJURY_CATEGORIES).alias("__bi"),
        *[A.any_when(z).alias(f"__{n}") for n, z in zero.items()])
    known = A.distinct_counts(fact, ["claimid"], {
        "ClaimantDenormID_exp": {n: (side == v) & (party != 0) for n, v in sides.items()}})
    default = F.lit(0 if exclude_default else 1).cast("bigint")
    return flags.join(known, "claimid").select(
        "claimid", *[F.when(F.col("__bi") == 1, F.col(n) + F.col(f"__{n}")).otherwise(default).alias(n) for n in sides])


def notes_per_day(notes: DataFrame, claims: DataFrame, as_of: Column) -> DataFrame:
    """Notes of the current month divided by the days the claim was open in it."""
    counted = notes.filter(D.in_month_of(F.col("AuthoringDate"), as_of)).groupBy(F.col("ClaimID").alias("claimid")).agg(
        F.count(F.lit(1)).alias("__n"))
    days = claims.select(F.col("ID").alias("claimid"), D.days_open_in_month(F.col("ReportedDate"), as_of).alias("__days"))
    return counted.join(days, "claimid", "left").select("claimid", M.ratio(F.col("__n"), F.col("__days")).alias("avg_notes_perday"))


def note_flags(notes: DataFrame, groups: Sequence[str] = ("fire", "theft", "total_loss", "attorney", "chiro"),
               phrases: Sequence[str] = X.KEY_PHRASES) -> DataFrame:
    """Red-flag and key-phrase flags per claim, note by note.

    Words and phrases cannot reach across the separator between notes, so the maximum over notes equals the flag of
    the joined text, without building a text of unbounded length.
    """
    clean = X.clean_note(F.col("Body"))
    flagged = notes.select(
        F.col("ClaimID").alias("claimid"),
        *[X.contains_any(F.lower(clean), [w.lower() for w in X.RED_FLAG_WORDS[g]]).alias(f"{g.upper()}_UNST_F") for g in groups],
        *X.phrase_flags(clean, phrases))
    return flagged.groupBy("claimid").agg(*[F.max(c).alias(c) for c in flagged.columns if c != "claimid"])


def note_keyword_flags(notes: DataFrame, key: str, order: Sequence[str], text: str,
                       rules: Sequence[X.KeywordRule] = X.NOTE_RULES) -> DataFrame:
    """Keyword-rule flags of the joined notes of each key, without joining them.

    Joined with " , ", every note but the first has a blank before it and every note but the last a blank after it;
    the same blanks are added here, and no pattern can match the comma. `order` must tell the notes of a key apart.
    """
    place = F.struct(*order)
    ends = notes.groupBy(key).agg(F.min(place).alias("__first"), F.max(place).alias("__last"))
    joined = notes.join(ends, key)
    padded = F.concat(
        F.when(place == F.col("__first"), "").otherwise(" "), F.col(text), F.when(place == F.col("__last"), "").otherwise(" "))
    flagged = joined.select(key, *X.keyword_flags(padded, rules))
    return flagged.groupBy(key).agg(*[F.max(r.name).alias(r.name) for r in rules])


def with_indicators(claims: DataFrame, values: Mapping[str, Sequence[str]] = INDICATOR_VALUES) -> DataFrame:
    """One 0/1 column per named value of the coded columns, compared as text."""
    present = {c: v for c, v in values.items() if c in claims.columns}
    texts = claims.withColumns({c: F.col(c).cast("string") for c in present})
    rules = [(c, v, INDICATOR_NAMES.get((c, v), f"{c}_{v}")) for c, named in present.items() for v in named]
    return texts.withColumns(C.value_indicators(rules))


def with_calendar_flags(claims: DataFrame) -> DataFrame:
    """Hour bucket, combined collision flags, claim type and policy-period flags of the assembled claim row."""
    c = F.col
    flags = claims.withColumns({
        "tod": D.hour_bucket(c("LossDate")),
        "Collision_indicator": C.indicator((c("collision_final") == 1) | (c("AUTO_COLLISION") > 0)),
        "rear_end_Coll_ind": C.indicator((c("rear_collision_final") == 1) | (c("rear_end_pc") == 1)),
        "glass_damage_ind": C.indicator((c("losscause_group") == "Glass_Damage") | (c("glass_damage") == 1)),
        "claimtype": F.when(c("thirdparty_cnt") > 0, "thirdparty_claim").otherwise("insured_claim"),
        "policy_period_gt_0": D.long_policy(c("EffectiveDate"), c("ExpirationDate")),
        "weekend_flag": D.weekend(c("ReportedDate")),
        "jul_dec": D.second_half(c("ReportedDate")),
        "policy_period_extreme": D.policy_period_extreme(c("ReportedDate"), c("EffectiveDate"), c("ExpirationDate")),
    })
    collision = A.coalesce_flags([c("Collision_indicator"), c("rear_end_Coll_ind")])
    return flags.withColumns({
        "collision_ind_f": collision,
        "collision_overall": collision + c("rear_end_Coll_ind"),
        "suspicious_collision": C.indicator((collision == 1) & (c("vehicle_count") > 2)),
    })


def claim_features(tables: Mapping[str, DataFrame], codes: Mapping[str, DataFrame], as_of: Column) -> DataFrame:
    """One wide row per open claim.

    Expects claim, exposure, policy, incident, vehicle, exposure_report, contact, address, body_part, match_report,
    reserve_line, contributing_factor and coverage_map (with its line number) in the schemas of
    `lossloom.sources.schemas`.
    """
    claims, policies = tables["claim"], tables["policy"]
    base = claim_base(claims, tables["address"], codes)
    fact = exposure_fact(base, tables["exposure"], policies, tables["incident"], tables["vehicle"],
                         tables["exposure_report"], tables["contact"], tables["address"], codes)
    parties = party_events(tables["exposure"], claims, policies, tables["contact"])
    fact = with_party_history(exposure_measures(fact, as_of), parties, policies)
    # Eight aggregates read the fact: it is computed once, written to shared storage and read column by column.
    fact = materialise(with_coverage(fact, tables["coverage_map"]))
    population = base.select(F.col("claimid"))
    mine = lambda t: J.with_members(tables[t], population.withColumnRenamed("claimid", "ClaimID"), "ClaimID")
    policy = policies.select(F.col("ID").alias("PolicyID"), "EffectiveDate", "ExpirationDate", "PolicyNumber", "PolicyType")
    renewals = policies.groupBy("PolicyNumber").agg(F.count_distinct("EffectiveDate").alias("prev_renewals"))
    head = J.folded_join(J.null_spread_join(base, policy, ["PolicyID"]), renewals, ["PolicyNumber"], by=["claimid"])
    parts = [
        claim_measures(fact), coverage_rollup(fact), collision_flags(claims, fact), vehicle_flags(fact),
        body_part_counts(mine("incident"), tables["body_part"]), match_reason_list(mine("match_report")),
        match_reason_counts(mine("match_report")), recovery_amounts(mine("reserve_line")),
        contributing_factors(mine("contributing_factor")), vehicle_age_by_side(fact), location_matches(fact),
    ]
    wide = J.assemble_wide(head, "claimid", parts)
    filled = [*CONTRIBUTING_FACTORS, *[n for n in MATCH_REASONS]]
    return with_calendar_flags(wide.fillna(0, filled))
