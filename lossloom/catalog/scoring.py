"""The scoring frame on the driver's tables: every declared model input of every claim, beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.catalog import claims as C
from lossloom.catalog.registry import Tables, query
from lossloom.functions import text as X
from lossloom.plans import features as B
from lossloom.plans import scoring as S
from lossloom.session import materialise

# Values that stand for the coded columns, which the driver's tables do not have; the same text is read by both sides.
_CODED = {
    "ClaimTier": "case when k % 5 > 0 then cast(10001 + k % 5 as {text}) end",
    "FaultRating": "case when k % 7 > 0 then cast(10000 + k % 7 as {text}) end",
    "LitigationStatus": "case when k % 8 > 0 then cast(k % 8 as {text}) end",
    "SubrogationStatus": "case when k % 4 = 3 then '-1' when k % 4 > 0 then cast(10000 + k % 4 as {text}) end",
    "responsibleparty_desc": "case k % 6 when 0 then 'Insured' when 1 then 'Vandals, Vagrants, Criminals' when 2 then 'Unknown' when 3 then 'Other kind' end",
    "ext_locationofloss_desc": "case k % 9 when 0 then 'In Transit - Railroad' when 1 then 'Insured''s Premises' when 2 then 'Premises of Others' end",
    "LocationOfTheft_desc": "case when k % 3 > 0 then cast(k % 3 as {text}) end",
    "losscause_group": "case k % 5 when 0 then 'Catastrophe' when 1 then 'Towing_and_Labor' when 2 then 'Theft' when 3 then 'Unlisted' end",
}
# The last day of the month whose notes are counted.
LAST_DAY = "date '2001-12-31'"
_CATEGORY = "case when line = 1 then 'PIP' when line = 2 then 'UIM/UM' when line = 3 then null when line = 4 then 'Comprehensive' else 'Collision' end"
_DESCRIBED = "case k % 6 when 0 then 'stole the car' when 1 then 'Fire, then coll' when 2 then 'was COLI' when 3 then 'rear' end"
_REASON = "case l_partkey % 4 when 0 then 'A,D,L,LL,N,P,S,V' when 1 then 'N,V' when 2 then 'P' end"
# ASCII letters only, as cleaning drops other marks: cleaned and plain notes then hold the same phrases.
_NOTE = """case doc_id % 6 when 0 then 'Arson and NECK PAIN, body shop' when 1 then 'police report of a robbery' when 2 then 'Total Loss' when 3 then 'lawyer, wage loss'
  when 4 then 'chiropractic' else 'none' end"""


def _heads(t: Tables) -> DataFrame:
    claims = C._claims(t).drop("LitigationStatus", "Description")
    terms = C._policies(t).select(F.col("ID").alias("PolicyID"), "PolicyNumber", "EffectiveDate", "ExpirationDate")
    names = C._contacts(t).select(F.col("ID").alias("id"), F.upper("Name").alias("name"))
    heads = claims.join(terms, "PolicyID", "left").join(S.policy_claims(claims, C._policies(t)), "PolicyNumber", "left")
    for role in ("Claimant", "Insured"):
        heads = heads.join(names.select(F.col("id").alias(f"{role}DenormID"), F.col("name").alias(f"{role.upper()}_NAME")), f"{role}DenormID", "left")
    heads = heads.withColumn("k", F.col("ID")).withColumnRenamed("ID", "claimid").selectExpr(
        "* except (LossDate, k)", "cast(LossDate as timestamp_ntz) + make_interval(0, 0, 0, 0, cast(k % 24 as int)) as LossDate",
        f"{_DESCRIBED} as Description", *[f"{e.format(text='string')} as {n}" for n, e in _CODED.items()])
    return S.name_counts(heads, B.party_events(C._exposures(t), C._claims(t), C._policies(t), C._contacts(t)))


def _parts(t: Tables, heads: DataFrame, fact: DataFrame) -> list[DataFrame]:
    lines = C._lines(t)
    notes = t.documents.selectExpr("doc_id as ClaimID", f"{_NOTE} as Body",
                                   "timestamp_ntz '2001-12-01' + make_interval(0, 0, 0, cast(doc_id % 60 as int)) as AuthoringDate")
    topics = lines.groupBy(F.col("l_orderkey").alias("claimid")).agg(*[
        F.try_divide(F.count_if(F.col("l_partkey") % S.TOPICS == i), F.count("l_partkey")).alias(f"TOPIC_NEW_{i}") for i in range(S.TOPICS)])
    return [
        B.collision_flags(heads.withColumnRenamed("claimid", "ID"), fact, contains_form=True),
        B.body_part_counts(lines.selectExpr("id as ID", "l_orderkey as ClaimID"), lines.selectExpr(
            "id as IncidentID", "cast(10000 + l_partkey % 9 as string) as PrimaryBodyPart")),
        B.match_reason_counts(lines.selectExpr("l_orderkey as ClaimID", f"{_REASON} as MatchReasons")),
        B.contributing_factors(lines.selectExpr("l_orderkey as ClaimID", "cast(10069 + l_partkey % 101 as string) as PriContributingFactors")),
        B.note_flags(notes), B.notes_per_day(notes, C._claims(t), F.expr(LAST_DAY)), topics,
    ]


def _sql() -> str:
    """The SQL of all inputs. Lists of codes are those of the feature plan, everything else is written out."""
    when = lambda test: f"sum(case when {test} then 1 else 0 end)"
    flag = lambda test: f"max(case when {test} then 1 else 0 end)"
    sides = (("FP", "INSURED", "10001"), ("TP", "TP", "10002"))
    fact = {"BI": flag("line = 1"), "EXPOSUREID": "count(distinct id)", "INCIDENTID": "count(distinct coalesce(incident, -1))", "CLM_TENURE": "max(line * 10)",
            "LOSSPARTYID_NAN": when("side is null"), "COV_ROLLUP_3_NAN": when("line = 3"), "VEHICLEDRIVEABLE_F": "max(case when id % 3 > 0 then id % 2 end)",
            "EXT_LOWIMPACTINCIDENT_F": flag("id % 5 = 1"), "TOTALLOSS_FINAL": flag("id % 19 = 0"), "inc_coll": flag("id % 4 = 0")}
    fact |= {f"COV_ROLLUP_3_{c}": when(f"upper({_CATEGORY}) = '{c}'") for c in S.CATEGORIES}
    fact |= {f"LOSSPARTYID_{p}_0": when(f"side = '{p}'") for p in S.PARTIES}
    fact |= {f"CLAIMANTDENORMID_{n}": f"count(distinct case when line = {int(n) - 10000} then coalesce(party, -1) end)" for n in S.CLAIMANT_TYPES}
    for short, label, side in sides:
        fact |= {f"{label}_{n}": when(f"side = '{side}' and kind in ({codes})") for n, codes in (
            ("NEW_V", "10003"), ("RENTED", "10005, 10006"), ("OWNED", "10004"), ("LISTED", "10002"), ("OTHER", "10009"))}
        fact |= {f"LOSSLOC_{place}_{short}_F": flag(f"side = '{side}' and id % {n} = 0") for place, n in (("ZIP", 2), ("CITY", 3), ("STATE", 5))}
        fact[f"{short}_V_AGE"] = f"least(greatest(coalesce(max(case when coalesce(side, '0') = '{side}' then case when line > 1 then line * 9 end else 0 end), 4), 0), 50)"
    line = {n.upper(): when(f"l_partkey % 9 = {int(c) - 10000}") for n, c in B.BODY_PARTS.items()}
    line |= {n.upper(): when(f"list_contains(string_split({_REASON}, ','), '{c}')") for n, c in B.MATCH_REASONS.items()}
    factor = lambda *codes: flag(f"10069 + l_partkey % 101 in ({', '.join(codes)})")
    line |= {"GLASS_DAMAGE_F": factor("10077", "10078", "10079"), "REAR_END_PC_F": factor("10153", "10024"), "INTERSECTION_PC1": factor("10094"),
             "SPEED_HEADON_PC_F": factor("10083", "10154", "10169"), "PARKED_VEHICLE": factor("10141"), "FOLL_CLOSELY_PC1": factor("10069")}
    line |= {f"TOPIC_MODEL_{i}": f"avg(case when l_partkey % 20 = {i} then 1.0 else 0.0 end)" for i in range(S.TOPICS)}
    words = lambda found: flag(f"regexp_matches(lower(body), '{found}')")
    note = {"FIRE_FLAG_UNST": words("fire|explosion|blast|arson"), "THEFT_FLAG_UNST": words("theft|burglary|steal|stole|robbery|larceny"),
            "TOTAL_FLAG_UNST": words("totalloss|total loss"), "ATTORNEY_FLAG_UNST": words("attorney|lawyer|counsel|advocate|litigation"),
            "CHIRO_FLAG_UNST": words("chiropractor|physiotherapy|chiropractic"),
            **{f"KEY_PHRASE_{i}": words(p.lower()) for i, p in enumerate(X.KEY_PHRASES)}}
    days = lambda a, b: f"date_diff('day', cast({a} as date), cast({b} as date))"
    head = {"REPORT_LAG": days("loss", "reported"), "PC_ISSUE_REPORT_LAG": days("effective", "reported"), "PC_REPORT_EXPRN_LAG": days("reported", "expires"),
            "PC_LOSS_EXPRN_LAG": days("loss", "expires"), "THEFT_FLAG_FINAL": "case when k % 6 = 0 then 1 else 0 end",
            "FIRE_FLAG_FINAL": "case when k % 6 = 1 then 1 else 0 end", "PREV_RENEWALS": "renewals", "PREV_POL_CLAIMS": "used",
            "COLLISION_F2": "case when inc_coll is null then 0 when k % 6 in (1, 2, 3) then 1 else inc_coll end",
            "CLAIM_CNT_NAME_CLM": "case when claimant_name is null then 1 else coalesce(n1.n, 0) end",
            "CLAIM_CNT_NAME_INS": "case when insured_name is null then 1 else coalesce(n2.n, 0) end",
            "AVG_NOTES_PER_DAY": f"in_month / case when year(reported) = 2001 and month(reported) = 12 then {days('reported', LAST_DAY)} else 31 end"}
    hours = {"0 to 5": "k % 24 < 6", "6 to 11": "k % 24 between 6 and 11", "12 to 17": "k % 24 between 12 and 17", "18 to 23": "k % 24 > 17"}
    sources = {"CLAIMTIERID": "ClaimTier", "EXT_LOCATIONOFLOSS_DESC": "ext_locationofloss_desc", "LITIGATIONSTATUSID": "LitigationStatus",
               "RESPONSIBLEPARTY_DESC": "responsibleparty_desc", "SUBROGATIONSTATUSID": "SubrogationStatus"}
    for column, values in B.INDICATOR_VALUES.items():
        for value in values:
            quoted = value.replace("'", "''")
            if column == "LOSS_TIMEOFDAY":
                test = hours[value]
            elif column == "LOSSCAUSE_GROUP":
                test = f"coalesce(upper(c_losscause_group), '0') = '{quoted}'"
            elif column == "FAULTRATING":
                test = f"coalesce(c_faultrating || '.0', '0') = '{quoted}'"
            else:
                test = f"coalesce(c_{sources[column].lower()}, '0') = '{quoted}'"
            name = "FAULTRATING_0.0" if (column, value) == ("FAULTRATING", "0") else f"{column}_{value}"
            if name != "EXT_LOCATIONOFLOSS_DESC_0":
                head[name.upper().replace(".", "_")] = f"case when {test} then 1 else 0 end"
    columns = lambda d: ", ".join(f'{e} as "{n}"' for n, e in d.items())
    given = [n for d in (fact, line, note) for n in d if not n.startswith("inc_") and n not in ("INSURED_OTHER",)]
    return f"""with {C._SIDES}, {C._CLAIMS}, {C._PARTIES},
fa as (select claimid, {columns(fact)} from f group by 1),
li as (select l_orderkey as claimid, {columns(line)} from ln group by 1),
bo as (select doc_id as claimid, {_NOTE} as body, timestamp '2001-12-01' + to_days(cast(doc_id % 60 as integer)) as written from documents),
no as (select claimid, {columns(note)}, nullif(sum(case when written < timestamp '2002-01-01' then 1 else 0 end), 0) as in_month from bo group by 1),
nm as (select k.name, count(distinct x.l_orderkey) as n from ln x join co k on x.id % 17 > 0 and x.l_suppkey = k.id where k.name is not null group by 1),
rn as (select number, count(distinct effective) as renewals from po group by 1),
us as (select po.number, count(distinct cl.id) as used from cl join po on cl.policy = po.id group by 1),
hd as (select cl.id as k, cl.loss, cl.reported, po.effective, po.expires, rn.renewals, us.used, a.name as claimant_name, i.name as insured_name
  from cl left join po on cl.policy = po.id left join rn on po.number = rn.number left join us on po.number = us.number
  left join co a on cl.claimant = a.id left join co i on cl.insured = i.id),
co2 as (select *, {", ".join(f"{e.format(text='varchar')} as c_{n.lower()}" for n, e in _CODED.items())} from hd)
select k as claimid, coalesce(c_locationoftheft_desc, '0') as "LOCATIONOFTHEFT_DESC",
  {", ".join(f'cast(coalesce({e}, 0) as double) as "{n}"' for n, e in head.items())},
  {", ".join(f'cast(coalesce("{n}", 0) as double) as "{n}"' for n in given)}
from co2 left join fa on k = fa.claimid left join li on k = li.claimid left join no on k = no.claimid
left join nm n1 on claimant_name = n1.name left join nm n2 on insured_name = n2.name"""


@query(_sql())
def scoring_frame(t: Tables):
    """All 187 inputs of every claim, from the finished fact and the claim's notes, reports, body parts and factors."""
    flag = lambda n, r=0: (F.col("exposureid") % n == r).cast("int")
    t.lines = materialise(C._lines(t))
    fact = C._side_fact(t).withColumns({
        "line": F.col("exposureid") % 10, "VehicleDriveable": F.when(F.col("exposureid") % 3 > 0, (F.col("exposureid") % 2).cast("int")),
        "Ext_EntireSideDamaged": F.lit(0), "VehicleParked": F.lit(0), "TotalLoss": flag(19), "Ext_LowImpactIncident": flag(5, 1)})
    fact = fact.withColumn("cov_rollup_3", F.expr(_CATEGORY)).drop("line")
    heads = _heads(t)
    found = S.input_frame(heads, fact, _parts(t, heads, fact), S.model_inputs(), plain=True)
    return found.drop("ClaimNumber", "ReportedDate")
