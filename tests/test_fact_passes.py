"""The scoring frame reads the fact in few passes; party counts against brute force."""

import random

from conftest import SF_DIR
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lossloom.operators import joins as J
from lossloom.plans import features as B
from lossloom.plans import scoring as S


def test_scoring_frame_reads_lines_once(spark):
    """Lines are made unique and written once; no part of the last plan reads the raw lines again."""
    found = queries()["scoring_frame"](spark, SF_DIR)
    assert not [f for f in found.inputFiles() if "lineitem" in f]


def test_fact_features_are_three_passes(spark):
    assert len(S.fact_features(queries_fact(spark, []))) == 3


def queries_fact(spark, rows):
    flags = ("VehicleDriveable", "Ext_EntireSideDamaged", "VehicleParked", "TotalLoss", "Ext_LowImpactIncident")
    base = spark.createDataFrame(rows, "claimid long, exposureid long, incidentid long, ClaimantDenormID_exp long, LossParty string, cov_rollup_3 string, "
                                       "ClaimantType string, VehicleType string, vehicle_age int, claimant_tenure int, city_match int")
    return base.withColumns({**{f: F.lit(1) for f in flags}, "postal_code_match": F.lit(0), "state_match": F.lit(None).cast("int")})


def test_fact_features_equal_brute_force(spark):
    rng = random.Random(3)
    pick = lambda *v: rng.choice(v)
    rows = [(rng.randrange(6), rng.randrange(4), pick(None, 1, 2), pick(None, 1, 2, 3), pick(None, "10001", "10002"), pick(None, "PIP", "Collision", "AUTO BI"),
             pick(None, "10001", "10002", "10014", "7"), pick(None, "10003", "10004", "10009"), pick(None, 3, 70), pick(None, 10, 20), pick(None, 0, 1)) for _ in range(150)]
    rows.append((99, None, None, None, None, None, None, None, None, None, None))
    fact = queries_fact(spark, rows)
    got: dict = {}
    for part in S.fact_features(fact):
        for r in part.collect():
            got.setdefault(r["claimid"], {}).update(r.asDict())
    counts = {r["claimid"]: r.asDict() for r in B.party_counts(fact, S.CLAIMANT_TYPES).collect()}
    for claim in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == claim]
        want = {"INCIDENTID": len({r[2] for r in own}), "exposure_Count": len({r[1] for r in own}),
                "COV_ROLLUP_3_COLLISION": sum(r[5] == "Collision" for r in own), "COV_ROLLUP_3_NAN": sum(r[5] is None for r in own),
                "LOSSPARTYID_10001": sum(r[4] == "10001" for r in own), "LOSSPARTYID_NAN": sum(r[4] is None for r in own),
                "BI": int(any(r[5] in B.INJURY_CATEGORIES for r in own)), "claimant_tenure_wt": max((r[9] for r in own if r[9]), default=None),
                "LOSSLOC_CITY_FP_F": int(any(r[4] == "10001" and r[10] == 1 for r in own)), "LOSSLOC_CITY_FP_TP_F": int(any(r[4] is not None and r[10] == 1 for r in own)),
                "LOSSLOC_STATE_TP_F": 0, "TotalLoss": 1}
        kinds = {"TP_OWNED": len({r[:8] for r in own if r[4] == "10002" and r[7] == "10004"})}
        types = {f"CLAIMANTDENORMID_{t}": len({r[3] for r in own if r[6] == t}) for t in S.CLAIMANT_TYPES}
        assert {n: got[claim][n] for n in {**want, **kinds, **types}} == {**want, **kinds, **types}
        assert {n: counts[claim][n] for n in {**kinds, **types}} == {**kinds, **types}


def test_packed_assembly_equals_the_plain_one(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", 2.0), (3, None, 1.0)], "k long, x string, `COV 1.0` double")
    parts = [spark.createDataFrame([(1, 5, None), (3, None, "z")], "k long, n long, s string"), spark.createDataFrame([(2, True)], "k long, f boolean")]
    plain, packed = J.assemble_wide(base, "k", parts), J.assemble_packed(base, "k", parts)
    assert packed.columns == plain.columns and sorted(map(tuple, packed.collect())) == sorted(map(tuple, plain.collect()))
