"""The claim feature job and the recovery extract on hand-made tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lossloom.plans import features as B
from lossloom.plans import recovery
from lossloom.plans.triage import sheet_layout, triage_sheet
from lossloom.sources import schemas as S


def frame(spark, schema, rows):
    """Rows as dicts; absent columns are null."""
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(r.get(c) for c in empty.columns) for r in rows], empty.schema)


def ts(text):
    return dt.datetime.fromisoformat(text)


def money(x):
    return Decimal(str(x))


@pytest.fixture(scope="module")
def tables(spark):
    claim = dict(LossType="10001", LOBCode="10008", PolicyID=1, InsuredDenormID=1, ClaimantDenormID=2, LossLocationID=1)
    claims = [
        dict(claim, ID=1, ClaimNumber="C1", LossDate=ts("2017-03-01 00:00:05"), ReportedDate=ts("2017-03-04 09:00:00"),
             LossCause="10", Description="was rear ended"),
        dict(claim, ID=2, ClaimNumber="C2", LossDate=ts("2017-05-01 10:00:00"), ReportedDate=ts("2017-05-01 11:00:00"),
             LossCause="11", Description="hail"),
        dict(claim, ID=3, ClaimNumber="C3", LossDate=ts("2016-01-01 10:00:00"), ReportedDate=ts("2016-01-10 11:00:00"),
             CloseDate=ts("2016-02-01 00:00:00")),
        dict(claim, ID=4, ClaimNumber="C4", LossDate=ts("2017-05-01 10:00:00"), ReportedDate=ts("2017-05-01 11:00:00"),
             LitigationStatus="1"),
    ]
    exposures = [
        dict(ID=11, ClaimID=1, IncidentID=101, PrimaryCoverage="10", ExposureType="1", LossParty="10001", ClaimantType="10001", ClaimantDenormID=1),
        dict(ID=12, ClaimID=1, IncidentID=102, PrimaryCoverage="20", ExposureType="5", LossParty="10002", ClaimantType="10005", ClaimantDenormID=2),
        dict(ID=13, ClaimID=1, IncidentID=102, PrimaryCoverage="20", ExposureType="5", LossParty="10002", ClaimantType="10005", ClaimantDenormID=2),
        dict(ID=21, ClaimID=2, PrimaryCoverage=" ", ExposureType="5", LossParty="10001", ClaimantDenormID=3),
        dict(ID=31, ClaimID=3, ClaimantDenormID=1, LossParty="10001"),
    ]
    report = lambda i, o, p, r: dict(exposureid=i, OpenReserves=money(o), TotalPayments=money(p), TotalRecoveries=money(r),
                                     RemainingReserves=money(o), FuturePayments=money(0))
    return {
        "claim": frame(spark, S.CLAIM, claims), "exposure": frame(spark, S.EXPOSURE, exposures),
        "exposure_report": frame(spark, S.EXPOSURE_REPORT, [report(11, 100, 50, 10), report(12, 200, 0, 0), report(13, 1, 2, 0)]),
        "policy": frame(spark, S.POLICY, [dict(ID=1, PolicyNumber="P", EffectiveDate=ts("2017-01-01"), ExpirationDate=ts("2018-01-01"),
                                               OrigEffectiveDate=ts("1985-06-01"), PolicyType="auto"),
                                          dict(ID=2, PolicyNumber="P", EffectiveDate=ts("2016-01-01"))]),
        "incident": frame(spark, S.INCIDENT, [
            dict(ID=101, ClaimID=1, VehicleID=7, VehicleType="10003", TotalLoss=0, VehicleParked=None, Speed=30.0),
            dict(ID=102, ClaimID=1, VehicleID=8, VehicleType="10005", TotalLoss=1, Collision=1, Speed=50.0)]),
        "vehicle": frame(spark, S.VEHICLE, [dict(ID=7, Year=2010), dict(ID=8, Year=1950)]),
        "contact": frame(spark, S.CONTACT, [dict(ID=1, Name="Ann", PrimaryAddressID=1), dict(ID=2, Name=None, PrimaryAddressID=2), dict(ID=3)]),
        "address": frame(spark, S.ADDRESS, [dict(ID=1, City="X", PostalCode="1", State="S"), dict(ID=2, City="Y", PostalCode="1", State="S")]),
        "body_part": frame(spark, S.BODY_PART, [dict(IncidentID=101, PrimaryBodyPart="10002"), dict(IncidentID=102, PrimaryBodyPart="10002")]),
        "match_report": frame(spark, S.MATCH_REPORT, [dict(ClaimID=1, MatchReasons="A,N"), dict(ClaimID=1, MatchReasons="A,A"),
                                                      dict(ClaimID=1, MatchReasons="1,2,3,4,5,6,7,V"), dict(ClaimID=2)]),
        "reserve_line": frame(spark, S.RESERVE_LINE, [dict(ClaimID=1, Ext_ITDPaid=money(5)), dict(ClaimID=1, Ext_ITDPaid=money(6))]),
        "contributing_factor": frame(spark, S.CONTRIBUTING_FACTOR, [dict(ClaimID=1, PriContributingFactors="10024")]),
        "coverage_map": frame(spark, S.COVERAGE_MAP, [
            dict(PrimaryCoverage="10", exposuretype_desc="Bodily Injury", cov_rollup_3="Auto BI", line=1),
            dict(PrimaryCoverage="20", exposuretype_desc="Vehicle", cov_rollup_3="Collision", line=2),
            dict(PrimaryCoverage="20", exposuretype_desc="Vehicle", cov_rollup_3="GL PD", line=3),
            dict(PrimaryCoverage="", exposuretype_desc="Vehicle", cov_rollup_3="NA", line=4)]),
    }


@pytest.fixture(scope="module")
def codes(spark):
    table = lambda rows: spark.createDataFrame(rows, S.CODE_TABLE)
    return {
        "losscause": table([("10", "Motor Vehicle Accident"), ("11", "Weather Event")]),
        "exposuretype": table([("1", "Bodily Injury"), ("5", "Vehicle")]),
        "litigationstatus": table([("1", "In litigation")]),
    }


@pytest.fixture(scope="module")
def features(tables, codes):
    return B.claim_features(tables, codes, F.lit("2017-06-01").cast("date")).collect()


def test_claim_features(features):
    rows = {r.claimid: r for r in features}
    assert set(rows) == {1, 2}
    one, two = rows[1], rows[2]
    assert (one.Report_lag, one.losscause_group, two.losscause_group) == (3, "Motor_vehicle_accident", "Catastrophe")
    assert (one.OpenReserves, one.TotalIncurredNet, one.TotalIncurredGross) == (money("301.00"), money("343.00"), money("353.00"))
    assert (one.BI_Amount, one.PD_Amount) == (money("150.00"), money("203.00"))
    assert (one.exposure_Count, one.incident_Count, one.claimant_count, one.vehicle_count) == (3, 2, 2, 2)
    assert (one.insured_cnt, one.thirdparty_cnt, one.Injured_passengers, one.DOV_cnt) == (1, 1, 1, 1)
    assert (one.Expo_BI, one.Expo_Vehicle, one.Insured_New_veh, one.Thirdparty_rented, one.Thirdparty_New_veh) == (1, 2, 1, 1, 0)
    assert (one.insured_city_match, one.thirdparty_city_match, one.thirdparty_postal_match) == (1, 0, 1)
    assert (one.max_speed, one.max_vehicle_age, one.FP_V_AGE, one.TP_V_AGE) == (50.0, 67, 7, 50)
    assert (one.AUTO_BI, one.AUTO_COLLISION, one.BI, one.collision_only, two.AUTO_COLLISION) == (1, 2, 1, 0, 0)
    assert (one.TotalLoss, one.VehicleParked, two.TotalLoss) == (1, None, None)
    assert (one.rear_collision_final, one.collision_final, two.collision_final) == (1, 1, 0)
    assert (one.iso_concat, one.ISO_address, one.ISO_Name, one.ISO_VIN) == ("1,2,3,4,5,6,7,A,N,V", 2, 1, 1)
    assert (one.Total_Paid, one.rear_end_pc, one.glass_damage, two.rear_end_pc) == (money("11.00"), 1, 0, 0)
    assert (one.Body_Neck, one.Body_Head, one.prev_renewals) == (2, 0, 2)
    assert (one.tod, one.claimtype, two.claimtype, one.weekend_flag) == ("twelveam", "thirdparty_claim", "insured_claim", 1)
    assert (one.collision_ind_f, one.collision_overall, one.suspicious_collision) == (1, 2, 0)
    # Ann has claims 1 and 3; the longest gap is between their report days.
    assert (one.max_Pre_claims_cnt, one.previous_claim_duration) == (2, 419)
    # Original date 1985 is not valid, so the effective date counts.
    assert one.claimant_tenure_wt == 62


def test_features_do_not_depend_on_partitioning(features, tables, codes):
    as_of = F.lit("2017-06-01").cast("date")
    spread = {k: v.repartition(7) for k, v in tables.items()}
    assert sorted(map(str, B.claim_features(spread, codes, as_of).collect())) == sorted(map(str, features))


def test_party_counts_and_notes(spark, tables, codes):
    base = B.claim_base(tables["claim"], tables["address"], codes)
    fact = B.exposure_fact(base, tables["exposure"], tables["policy"], tables["incident"], tables["vehicle"],
                           tables["exposure_report"], tables["contact"], tables["address"], codes)
    fact = B.with_coverage(B.exposure_measures(fact, F.lit("2017-06-01").cast("date")), tables["coverage_map"])
    one = {r.claimid: r for r in B.party_counts(fact).collect()}[1]
    assert (one.INSURED_NEW_VEH, one.TP_RENTED, one.CLAIMANTDENORMID_10005, one.CLAIMANTDENORMID_10014) == (1, 2, 1, 0)
    hurt = {r.claimid: r for r in B.injured_counts(fact).collect()}[1]
    assert (hurt.FP_INJURED_CNT, hurt.TP_INJURED_CNT) == (2, 2)
    assert B.injured_counts(fact, exclude_default=True).filter("claimid = 1").first().FP_INJURED_CNT == 1
    notes = frame(spark, S.NOTE, [dict(ClaimID=1, AuthoringDate=ts("2017-05-10"), Body="Total Loss, soft tissue"),
                                  dict(ClaimID=1, AuthoringDate=ts("2017-05-11"), Body="fire (x)"), dict(ClaimID=2, Body="none")])
    flags = {r.claimid: r for r in B.note_flags(notes).collect()}
    assert (flags[1].FIRE_UNST_F, flags[1].TOTAL_LOSS_UNST_F, flags[1].KEY_PHRASE_NEW_9, flags[2].FIRE_UNST_F) == (1, 1, 1, 0)
    per_day = B.notes_per_day(notes, tables["claim"], F.lit("2017-05-21").cast("date")).collect()
    assert [(r.claimid, round(r.avg_notes_perday, 4)) for r in per_day] == [(1, round(2 / 21, 4))]
    paid = frame(spark, S.TRANSACTION, [dict(ClaimNumber="C1", TransactionAmount=money(5), TransactionType="Payment"),
                                        dict(ClaimNumber="C1", TransactionAmount=money(7), TransactionType="Reserve")])
    totals = {r.claimid: (r.RESERVE, r.PAYMENT) for r in B.reserve_and_payment(tables["claim"], paid).collect()}
    assert totals[1] == (money("7.00"), money("5.00")) and totals[2] == (0, 0)


def test_recovery_extract(spark):
    key = "COMPANY_CODE string, claim_br string, claim_no string, valid_flag int, valid_rec int"
    ca = key + ", POLICY_BR string, POLICY_NO string, POLICY_TYP string, clav_ca_end_date date, DATE_rept date, claim_status string, RSK_CLASS string, CLM_DESC1 string"
    base = dict(COMPANY_CODE="1", claim_br="b", valid_flag=2, valid_rec=1, POLICY_BR="p", POLICY_NO="n", POLICY_TYP="t",
                clav_ca_end_date=dt.date(9999, 12, 31), DATE_rept=dt.date(2012, 1, 1), claim_status="C", RSK_CLASS="MPA")
    claims = frame(spark, ca, [dict(base, claim_no="1"), dict(base, claim_no="2"), dict(base, claim_no="3", valid_flag=3),
                               dict(base, claim_no="4", DATE_rept=dt.date(2010, 1, 1))])
    side = lambda end, col, rows: frame(spark, f"{key}, {end} date, {col} string", [
        {"COMPANY_CODE": "1", "claim_br": "b", "valid_flag": 1, "valid_rec": 1, end: dt.date(9999, 12, 31), "claim_no": n, col: v} for n, v in rows])
    texts = frame(spark, key + ", INCIDENT_DESC string", [dict(COMPANY_CODE="1", claim_br="b", claim_no="1", valid_flag=1, valid_rec=1, INCIDENT_DESC="hit")])
    got = {r.claim_no: r for r in recovery.recovery_extract(
        claims, side("clav_mt_end_date", "clm_typ", [("1", None)]), side("clav_vc_end_date", "clm_type", [("1", "20"), ("2", "10")]),
        side("clav_va_end_date", "TYPE_CLAM", [("2", "30")]), texts).collect()}
    assert {k: (r.Claim_Type_F, r.RECOVERY_FLAG, r.INCIDENT_DESC) for k, r in got.items()} == {"1": ("20", 1, "hit"), "2": ("10", 0, None)}
    assert (got["1"].policyno, got["1"].claimno) == ("1pnt", "1b1")
    early = recovery.early_extract(claims, texts)
    assert [r.claim_no for r in early.collect()] == ["1"]
    assert "LeftOuter" not in early._jdf.queryExecution().optimizedPlan().toString()


def test_sheet_layout(spark):
    week = spark.createDataFrame(
        [("C1", 2, 0.9, "0", 0, 1, 10.0, 0, 0, "NY", ts("2017-01-01 08:00:00"), None), ("C2", 1, 0.1, "0", 1, 0, 5.0, 0, 0, "NJ", ts("2017-01-01 08:00:00"), "AFV10D19")],
        "claim_number string, changed_value bigint, predicted_prob double, classification string, previous_referral_final int, referral_final int,"
        "reserve double, siu_referral int, siu_referral_new int, jurisdiction string, reported timestamp, delivery_id string")
    sheet = sheet_layout(triage_sheet(week, F.lit("2017-01-03").cast("date"), ["m1", "m2"]))
    rows = {r["Claim Number"]: r.asDict() for r in sheet.collect()}
    assert (rows["C1"]["Delivery ID"], rows["C2"]["Delivery ID"]) == ("AFV10D11", "AFV10D20")
    assert (rows["C1"]["Pre-Triage Member"], rows["C2"]["Pre-Triage Member"], rows["C1"]["Open Days"]) == ("m1", "NA", 1)
    assert len(sheet.columns) == 21
