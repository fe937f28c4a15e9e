"""Claim features on the driver's tables, mapped to the claim schema: every query calls the function that a user calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.operators import filters as L
from lossloom.plans import features as B
from lossloom.session import dealt

AS_OF = "2002-01-01"


def _days(moment: str, days: str):
    return F.expr(f"{moment} + make_interval(0, 0, 0, cast({days} as int))")


def _lines(t: Tables) -> DataFrame:
    """One line per (order, number), as an exposure needs an id of its own."""
    if t.lines is not None:
        return dealt(t.lines, "l_orderkey")
    least = [F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate")]
    return dealt(t.lineitem, "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(*least).withColumns({
        "id": F.expr("l_orderkey * 10 + l_linenumber"),
        "side": F.expr("case l_returnflag when 'R' then '10001' when 'A' then '10002' end")})


_LINES = """
ln as (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_suppkey) as l_suppkey, min(l_returnflag) as l_returnflag,
  min(l_linestatus) as l_linestatus, min(l_quantity) as l_quantity, min(l_shipdate) as l_shipdate, l_orderkey * 10 + l_linenumber as id,
  case min(l_returnflag) when 'R' then '10001' when 'A' then '10002' end as side from lineitem group by l_orderkey, l_linenumber)"""


def _claims(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey as ID", "'C' || o_orderkey as ClaimNumber", "case when o_orderkey % 11 <> 0 then o_custkey end as PolicyID",
        "case when o_orderkey % 10 = 9 then '10002' else '10001' end as LossType",
        "case o_orderstatus when 'O' then '10008' when 'F' then '10014' else '10099' end as LOBCode",
        "cast(o_orderkey % 25 as string) as LossCause", "o_orderdate as LossDate",
        "o_orderdate + make_interval(0, 0, 0, cast(o_orderkey % 30 as int)) as ReportedDate",
        "case when o_orderkey % 4 = 0 then o_orderdate + make_interval(0, 0, 0, 90) end as CloseDate", "o_orderstatus as State",
        "case when o_orderkey % 8 > 0 then cast(o_orderkey % 8 as string) end as LitigationStatus", "o_orderkey % 27 as LossLocationID",
        "o_orderkey % 53 as ClaimantDenormID", "o_orderkey % 29 as InsuredDenormID", "o_orderpriority as Description")


_CLAIMS = """
cl as (select o_orderkey as id, case when o_orderkey % 11 <> 0 then o_custkey end as policy, case when o_orderkey % 10 = 9 then '10002' else '10001' end as losstype,
  case o_orderstatus when 'O' then '10008' when 'F' then '10014' else '10099' end as lob, o_orderkey % 25 as cause, o_orderdate as loss,
  o_orderdate + to_days(cast(o_orderkey % 30 as integer)) as reported, case when o_orderkey % 4 = 0 then o_orderdate + interval 90 day end as closed,
  o_orderstatus as state, case when o_orderkey % 8 > 0 then o_orderkey % 8 end as lit, o_orderkey % 27 as place, o_orderkey % 53 as claimant, o_orderkey % 29 as insured
  from orders),
opened as (select * from cl where closed is null and losstype = '10001' and lob in ('10008', '10014', '10016') and (lit is null or lit not in (1, 2)))"""


def _addresses(t: Tables) -> DataFrame:
    return t.nation.selectExpr("cast(n_nationkey as bigint) as ID", "n_name as AddressLine1", "n_name as City",
                               "cast(n_nationkey % 6 as string) as PostalCode", "cast(n_regionkey as string) as State")


def _codes(t: Tables) -> dict[str, DataFrame]:
    text = lambda label: t.nation.selectExpr("cast(n_nationkey as string) as ID", f"{label} as DESCRIPTION")
    return {"losscause": text("case n_nationkey % 4 when 0 then ' Flood' when 1 then 'Towing and Labor' when 2 then 'Fire Damage' else n_name end"),
            "litigationstatus": text("case when n_nationkey = 3 then 'In litigation' else n_name end")}


_BASE = _CLAIMS + """,
base as (select o.*, c.descr, n.n_name as city, cast(n.n_nationkey % 6 as varchar) as postal, cast(n.n_regionkey as varchar) as region, l.n_name as lit_name
  from opened o left join (select n_nationkey, case n_nationkey % 4 when 0 then ' Flood' when 1 then 'Towing and Labor' when 2 then 'Fire Damage' else n_name end as descr
    from nation) c on o.cause = c.n_nationkey left join nation n on o.place = n.n_nationkey left join nation l on o.lit = l.n_nationkey
  where lit is null or lit <> 3)"""


def _base(t: Tables) -> DataFrame:
    return B.claim_base(_claims(t), _addresses(t), _codes(t))


@query(f"with {_CLAIMS} select id as claimid, lob, lit as litigation from opened")
def open_claims(t: Tables):
    return L.open_claims(_claims(t)).select(F.col("ID").alias("claimid"), F.col("LOBCode").alias("lob"), F.col("LitigationStatus").cast("bigint").alias("litigation"))


@query(f"""with {_BASE}
select id as claimid, state as claim_status_code, descr as "LossCause_desc", lit_name as litigationstatus_desc, city as "lossloc_City", region as "lossloc_State",
  cast(date_diff('day', loss, reported) as integer) as "Report_lag",
  case trim(descr) when 'Flood' then 'Catastrophe' when 'Towing and Labor' then 'Towing_and_Labor' when 'Fire Damage' then 'Fire_or_Explosion' end as losscause_group from base""")
def claim_base(t: Tables):
    return _base(t).select("claimid", "claim_status_code", "LossCause_desc", "litigationstatus_desc", "lossloc_City", "lossloc_State",
                           "Report_lag", "losscause_group")


def _policies(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("ID"), F.expr("'P' || c_custkey % 50").alias("PolicyNumber"),
        _days("timestamp_ntz '1996-01-01'", "c_custkey % 365").alias("EffectiveDate"),
        F.when(F.col("c_custkey") % 3 > 0, _days("timestamp_ntz '1988-06-01'", "c_custkey % 2000")).alias("OrigEffectiveDate"),
        _days("timestamp_ntz '1998-01-01'", "c_custkey % 365").alias("ExpirationDate"))


def _contacts(t: Tables) -> DataFrame:
    return t.supplier.selectExpr(
        "s_suppkey as ID", "case when s_suppkey % 7 = 0 then null when s_suppkey % 11 = 0 then 'Suspense Policy' else 'Name ' || s_suppkey % 60 end as Name",
        "cast(null as date) as DateOfBirth", "cast(null as string) as Gender", "cast(null as string) as Occupation",
        "cast(s_nationkey as bigint) as PrimaryAddressID")


_PARTIES = """
po as (select c_custkey as id, 'P' || c_custkey % 50 as number, timestamp '1996-01-01' + to_days(cast(c_custkey % 365 as integer)) as effective,
  case when c_custkey % 3 > 0 then timestamp '1988-06-01' + to_days(cast(c_custkey % 2000 as integer)) end as original,
  timestamp '1998-01-01' + to_days(cast(c_custkey % 365 as integer)) as expires from customer),
co as (select s_suppkey as id, upper(case when s_suppkey % 7 = 0 then null when s_suppkey % 11 = 0 then 'Suspense Policy' else 'Name ' || s_suppkey % 60 end) as name,
  s_nationkey as place from supplier)"""


def _exposures(t: Tables) -> DataFrame:
    return _lines(t).selectExpr(
        "id as ID", "l_orderkey as ClaimID", "case when id % 13 > 0 then id end as IncidentID", "cast(null as bigint) as CoverageID", "'' as PrimaryCoverage",
        "'' as CoverageSubType", "'' as ExposureType", "side as LossParty", "'' as ClaimantType", "case when id % 17 > 0 then l_suppkey end as ClaimantDenormID")


def _fact(t: Tables) -> DataFrame:
    lines = _lines(t)
    incidents = lines.selectExpr("id as ID", "l_orderkey as ClaimID", "l_partkey as VehicleID")
    vehicles = t.part.selectExpr("p_partkey as ID", "p_brand as Make", "p_name as Model", "p_type as Vin", "1990 + p_size as Year")
    money = [F.col("l_quantity").cast("decimal(18,2)").alias(c) for c in ("RemainingReserves", "TotalPayments", "FuturePayments", "OpenReserves")]
    reports = lines.filter("id % 5 > 0").select(F.col("id").alias("exposureid"), *money, F.lit(1).cast("decimal(18,2)").alias("TotalRecoveries"))
    return B.exposure_fact(_base(t), _exposures(t), _policies(t), incidents, vehicles, reports, _contacts(t), _addresses(t), _codes(t))


_FACT = f"""{_LINES}, {_BASE}, {_PARTIES},
fact as (select x.id as exposureid, x.l_orderkey as claimid, x.side, case when x.id % 13 > 0 then x.l_partkey end as vehicle, k.name as own, k.id as party,
  case when x.id % 17 > 0 then x.l_suppkey end as party_id, p.p_brand, 1990 + p.p_size as built, b.*, po.effective, po.original, po.expires, po.number, a.name as claimant_name, i.name as insured_name,
  n.n_name as own_city, cast(n.n_nationkey % 6 as varchar) as own_postal, cast(n.n_regionkey as varchar) as own_region,
  case when x.id % 5 > 0 then x.l_quantity end as amount,
  case when k.name is null and a.name is not null then a.name when k.name is null and a.name is null and x.side = '10001' then i.name else k.name end as final_name
  from ln x join base b on x.l_orderkey = b.id left join part p on x.id % 13 > 0 and x.l_partkey = p.p_partkey
  left join co k on x.id % 17 > 0 and x.l_suppkey = k.id left join nation n on k.place = n.n_nationkey
  left join po on b.policy = po.id left join co a on b.claimant = a.id left join co i on b.insured = i.id)"""


@query(f"""with {_FACT}
select exposureid, claimid, final_name, p_brand as "Make", cast(year(loss) - built as integer) as vehicle_age,
  cast(date_diff('day', effective, reported) as integer) as "PC_issue_report", cast(date_diff('day', reported, expires) as integer) as "PC_report_expire",
  case when reported > effective and reported < expires then 1 else 0 end as report_interval,
  cast(date_diff('day', reported, coalesce(closed, timestamp '{AS_OF}')) as integer) as "Claim_Opening_days",
  case when own_postal = postal then 1 else 0 end as postal_code_match, case when own_city = city then 1 else 0 end as city_match,
  case when own_region = region then 1 else 0 end as state_match, amount * 2 - 1 as "TotalIncurredNet", amount * 2 as "TotalIncurredGross" from fact""")
def exposure_measures(t: Tables):
    """Exposure fact and its measures, from claims, policies, incidents, vehicles, reports, contacts and addresses."""
    found = B.exposure_measures(_fact(t), F.lit(AS_OF).cast("date"))
    amounts = [F.col(c).cast("double").alias(c) for c in ("TotalIncurredNet", "TotalIncurredGross")]
    return found.select("exposureid", "claimid", "final_name", "Make", "vehicle_age", "PC_issue_report", "PC_report_expire", "report_interval",
                        "Claim_Opening_days", "postal_code_match", "city_match", "state_match", *amounts)


@query(f"""with {_FACT},
ev as (select x.l_orderkey as claimid, case when x.id % 17 > 0 then x.l_suppkey end as party_id, c.reported, po.original, po.effective, k.name
  from ln x left join cl c on x.l_orderkey = c.id left join po on c.policy = po.id left join co k on x.id % 17 > 0 and x.l_suppkey = k.id),
named as (select *, name is not null and name <> 'SUSPENSE POLICY' as known, case when original is null or year(original) < 1991 then effective else original end as oldest from ev),
n1 as (select name, count(distinct claimid) as n from ev where name is not null group by 1),
n2 as (select party_id, count(distinct claimid) as n from ev where name is null and party_id is not null group by 1),
d1 as (select name, min(oldest) as d from named where known group by 1),
d2 as (select party_id, min(oldest) as d from named where not known and party_id is not null group by 1),
g1 as (select name, max(gap) as gap from (select name, coalesce(date_diff('day', lag(d) over (partition by name order by d), d), 0) as gap
  from (select distinct name, cast(reported as date) as d from named where known)) group by 1),
g2 as (select party_id, max(gap) as gap from (select party_id, coalesce(date_diff('day', lag(d) over (partition by party_id order by d), d), 0) as gap
  from (select distinct party_id, cast(reported as date) as d from named where not known and party_id is not null)) group by 1),
rn as (select number, count(distinct effective) as n from po group by 1),
j as (select f.exposureid, f.reported, coalesce(n1.n, n2.n, 0) as pre, rn.n as renewals, coalesce(g1.gap, g2.gap, 0) as gap,
  coalesce(case when year(d1.d) >= 1991 then d1.d when year(d1.d) < 1991 and d2.d is null then f.original else d2.d end,
    case when year(f.original) >= 1991 then f.original when year(f.original) < 1991 then f.effective end) as since
  from fact f left join n1 on f.final_name = n1.name left join n2 on f.party_id = n2.party_id left join d1 on f.final_name = d1.name
  left join d2 on f.party_id = d2.party_id left join g1 on f.final_name = g1.name left join g2 on f.party_id = g2.party_id left join rn on f.number = rn.number),
y as (select *, case when year(reported) = year(since) then 1 else year(reported) - year(since) end as yr from j)
select exposureid, pre as "Pre_claims_cnt", renewals as prev_renewals, cast(gap as integer) as prev_claim_duration,
  cast(date_diff('day', since, reported) as integer) as claimant_tenure, cast(yr as integer) as claimant_tenure_yr, round(pre / yr, 2) as "PREV_CLM_PER_YR" from y""")
def party_history(t: Tables):
    """Previous claims, renewals, tenure, longest gap and claims per year of the party of each exposure."""
    parties = B.party_events(_exposures(t), _claims(t), _policies(t), _contacts(t))
    found = B.with_party_history(_fact(t), parties, _policies(t))
    return found.select("exposureid", "Pre_claims_cnt", "prev_renewals", "prev_claim_duration", "claimant_tenure", "claimant_tenure_yr", "PREV_CLM_PER_YR")


def _side_fact(t: Tables) -> DataFrame:
    """The columns of the finished fact that the aggregates per claim read."""
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    flag = lambda n: (F.col("id") % n == 0).cast("int")
    return _lines(t).select(
        F.col("l_orderkey").alias("claimid"), F.col("id").alias("exposureid"), F.when(F.col("id") % 13 > 0, F.floor(F.col("id") / 2)).alias("incidentid"),
        F.when(F.col("id") % 9 > 0, F.col("l_partkey") % 40).alias("VehicleID"), F.when(F.col("id") % 6 > 0, F.col("l_suppkey") % 30).alias("ClaimantDenormID_exp"),
        F.col("side").alias("LossParty"), (10000 + line).cast("string").alias("ClaimantType"), (10002 + F.col("l_partkey") % 8).cast("string").alias("VehicleType"),
        line.cast("string").alias("ExposureType"), F.when(line == 1, "PIP").otherwise("Collision").alias("cov_rollup_3"),
        *[quantity.alias(c) for c in ("RemainingReserves", "TotalPayments", "TotalRecoveries", "FuturePayments", "OpenReserves", "TotalIncurredNet",
                                      "TotalIncurredGross", "PD_Amount")],
        F.when(line < 3, quantity).otherwise(0.0).alias("BI_Amount"), quantity.alias("Speed"), F.when(line > 1, line * 9).alias("vehicle_age"),
        line.alias("Pre_claims_cnt"), (line * 10).alias("claimant_tenure"), (line * 3).alias("prev_claim_duration"), (quantity / 4).alias("PREV_CLM_PER_YR"),
        flag(2).alias("postal_code_match"), flag(3).alias("city_match"), flag(5).alias("state_match"), flag(7).alias("Ext_RearEndCollision"), flag(4).alias("Collision"))


_SIDES = f"""{_LINES},
f as (select l_orderkey as claimid, id, case when id % 13 > 0 then id // 2 end as incident, case when id % 9 > 0 then l_partkey % 40 end as vehicle,
  case when id % 6 > 0 then l_suppkey % 30 end as party, side, l_linenumber as line, 10002 + l_partkey % 8 as kind, l_quantity as q from ln)"""
_BOTH = (("Insured", "10001"), ("Thirdparty", "10002"))
_KINDS = (("New_veh", "10003"), ("rented", "10005, 10006"), ("owned", "10004"), ("listed", "10002"), ("other", "10009"))
_TYPES = (("Insured_c_cnt", 1), ("MOIH_cnt", 2), ("DOIV_cnt", 3), ("OOV_cnt", 4), ("DOV_cnt", 5), ("OCIV_cnt", 6), ("OCOV_cnt", 7), ("PED_cnt", 8), ("Other_third_cnt", 14))
_EXPOSED = (("Expo_BI", 1), ("Expo_Pers_Prop", 3), ("Expo_Property", 4), ("Expo_Vehicle", 5), ("Expo_General", 9), ("Expo_PIP", 10), ("Expo_MEDPAY", 11), ("Expo_tow_labr", 10009))
_flag = lambda test, name: f"""max(case when {test} then 1 else 0 end) as "{name}\""""
_distinct = lambda column, test, name: f"""count(distinct case when {test} then {column} end) as "{name}\""""
_MEASURES = ", ".join([
    *[f"""sum(q) as "{c}\"""" for c in ("RemainingReserves", "TotalPayments", "TotalRecoveries", "FuturePayments", "OpenReserves", "TotalIncurredNet",
                                        "TotalIncurredGross", "PD_Amount")],
    'sum(case when line < 3 then q else 0 end) as "BI_Amount", max(q) as max_speed, max(case when line > 1 then line * 9 end) as max_vehicle_age',
    'max(line) as "max_Pre_claims_cnt", max(line * 10) as claimant_tenure_wt, max(line * 3) as previous_claim_duration, max(q / 4) as "MAX_PREV_CLM_PER_YR"',
    *[_flag(f"side = '{side}' and kind in ({kinds})", f"{label}_{name}") for name, kinds in _KINDS for label, side in _BOTH],
    *[_flag(f"side = '{side}' and id % {n} = 0", f"{label.lower()}_{name}_match") for name, n in (("postal", 2), ("city", 3), ("state", 5)) for label, side in _BOTH],
    _distinct("id", "true", "exposure_Count"), *[_distinct("id", f"line = {n}", name) for name, n in _EXPOSED],
    _distinct("incident", "true", "incident_Count"), _distinct("vehicle", "true", "vehicle_count"), _distinct("party", "true", "claimant_count"),
    _distinct("party", "line < 3 and q > 0", "Injured_passengers"), _distinct("party", "side = '10001'", "insured_cnt"),
    _distinct("party", "side = '10002'", "thirdparty_cnt"), *[_distinct("party", f"line = {n}", name) for name, n in _TYPES]])


@query(f"with {_SIDES} select claimid, {_MEASURES} from f group by claimid")
def claim_measures(t: Tables):
    return B.claim_measures(_side_fact(t))


@query(f"""with {_SIDES},
a as (select claimid, max(case when side = '10001' then case when line > 1 then line * 9 end else 0 end) as fp,
  max(case when side = '10002' then case when line > 1 then line * 9 end else 0 end) as tp from f group by 1)
select claimid, cast(least(greatest(coalesce(fp, 4), 0), 50) as integer) as "FP_V_AGE", cast(least(greatest(coalesce(tp, 4), 0), 50) as integer) as "TP_V_AGE" from a""")
def vehicle_age_by_side(t: Tables):
    return B.vehicle_age_by_side(_side_fact(t))


_PARTY_TYPES = (*range(10001, 10012), 10014)
_PARTY_COLUMNS = ", ".join([
    *[f"""count(*) filter (where side = '{side}' and kind in ({kinds})) as "{label}_{name.upper()}\"""" for name, kinds in _KINDS for label, side in (("INSURED", "10001"), ("TP", "10002"))],
    *[f"""count(distinct case when line = {n - 10000} then coalesce(party, -1) end) as "CLAIMANTDENORMID_{n}\"""" for n in _PARTY_TYPES]])


@query(f"with {_SIDES} select claimid, {_PARTY_COLUMNS} from f group by claimid")
def party_counts(t: Tables):
    return B.party_counts(_side_fact(t))


@query(f"""with {_SIDES},
d as (select doc_id, upper(text) as x from documents where text is not null),
i as (select claimid, max(case when id % 7 = 0 then 1 else 0 end) as rear, max(case when id % 4 = 0 then 1 else 0 end) as coll from f group by 1)
select claimid, greatest(rear, case when contains(x, 'REAR') or contains(x, 'RAE') then 1 else 0 end) as rear_collision_final,
  greatest(coll, case when contains(x, 'REAR') or contains(x, 'RAE') or contains(x, 'COLL') or ends_with(x, 'COLI') then 1 else 0 end) as collision_final
from i join d on i.claimid = d.doc_id""")
def collision_flags(t: Tables):
    claims = t.documents.filter("text is not null").select(F.col("doc_id").alias("ID"), F.col("text").alias("Description"))
    return B.collision_flags(claims, _side_fact(t))


_PART_COUNTS = ", ".join(f"""count(*) filter (where code = {n}) as "{name}\"""" for name, n in (
    ("Body_Head", 1), ("Body_Neck", 2), ("Body_Upper_ext", 3), ("Body_Trunk", 4), ("Body_Lower_ext", 5), ("Body_Unknown", 6), ("Body_Multiple", 7)))


@query(f"""with {_LINES}, b as (select l.id, l.l_orderkey as claimid, case when p.id % 3 > 0 then p.l_partkey % 9 end as code
  from ln l left join ln p on l.id = p.id and p.id % 3 > 0) select claimid, {_PART_COUNTS} from b group by 1""")
def body_part_counts(t: Tables):
    lines = _lines(t)
    return B.body_part_counts(lines.selectExpr("id as ID", "l_orderkey as ClaimID"), lines.filter("id % 3 > 0").selectExpr(
        "id as IncidentID", "cast(10000 + l_partkey % 9 as string) as PrimaryBodyPart"))


_REASONS = "case l_partkey % 4 when 0 then 'A,D,L,LL,N,P,S,V' when 1 then 'N,N,V' when 2 then 'P' end"
_CODES = ", ".join(f"""count(distinct case when code = '{code}' then id end) as "{name}\"""" for name, code in (
    ("ISO_address", "A"), ("ISO_DL", "D"), ("ISO_Licenseplatenumber", "L"), ("ISO_Losslocation", "LL"), ("ISO_Name", "N"), ("ISO_Phone", "P"), ("ISO_SSN", "S"), ("ISO_VIN", "V")))


@query(f"""with {_LINES}, x as (select l_orderkey as claimid, id, unnest(string_split({_REASONS}, ',')) as code from ln),
u as (select distinct claimid, code from x)
select x.claimid, {_CODES}, (select string_agg(code, ',' order by code) from u where u.claimid = x.claimid) as iso_concat from x group by x.claimid""")
def match_reasons(t: Tables):
    """All eight reasons: reports that carry each, and the list of a claim."""
    reports = _lines(t).selectExpr("l_orderkey as ClaimID", f"{_REASONS} as MatchReasons")
    return B.match_reason_counts(reports).join(B.match_reason_list(reports), "claimid", "left")


_RECOVERED = (("credit_to_expense_rec", 1), ("credit_to_loss_rec", 2), ("deductible_rec", 3), ("Total_Paid", 4), ("total_recovered", 5), ("salvage_rec", 6), ("subro_rec", 7))


@query(f"""with {_LINES} select l_orderkey as claimid, {", ".join(f'sum(l_quantity * {n}) as "{name}"' for name, n in _RECOVERED)} from ln group by 1""")
def recovery_amounts(t: Tables):
    lines = _lines(t).select(F.col("l_orderkey").alias("ClaimID"), *[
        (F.col("l_quantity") * n).cast("decimal(18,2)").alias(B.RECOVERIES[name]) for name, n in _RECOVERED])
    return B.recovery_amounts(lines).select("claimid", *[F.col(name).cast("double").alias(name) for name, _ in _RECOVERED])


_FACTORS = (("glass_damage", "10077, 10078, 10079"), ("rear_end_pc", "10153, 10024"), ("intersection_accident", "10094"),
            ("speed_headon_racing", "10083, 10154, 10169"), ("parked_vehicle", "10141"), ("following_closely", "10069"))


@query(f"""with {_LINES}, x as (select l_orderkey as claimid, 10069 + l_partkey % 101 as code from ln)
select claimid, {", ".join(_flag(f"code in ({codes})", name) for name, codes in _FACTORS)} from x group by 1""")
def contributing_factors(t: Tables):
    return B.contributing_factors(_lines(t).selectExpr("l_orderkey as ClaimID", "cast(10069 + l_partkey % 101 as string) as PriContributingFactors"))


@query(f"""with {_CLAIMS}, {_LINES}, x as (select case when id % 4 > 0 then l_orderkey end as claimid, case l_linestatus when 'O' then 'Payment' else 'Reserve' end as kind, l_quantity as q
  from ln where l_linenumber <> 3),
s as (select claimid, sum(case when kind = 'Reserve' then q else 0 end) as r, sum(case when kind = 'Payment' then q else 0 end) as p from x group by 1)
select cl.id as claimid, coalesce(r, 0) as "RESERVE", coalesce(p, 0) as "PAYMENT" from cl left join s on cl.id % 6 > 0 and cl.id = s.claimid""")
def reserve_and_payment(t: Tables):
    """Claims and transactions without a number meet nothing."""
    claims = _claims(t).withColumn("ClaimNumber", F.expr("case when ID % 6 > 0 then ClaimNumber end"))
    moved = _lines(t).selectExpr("case when id % 4 > 0 then 'C' || l_orderkey end as ClaimNumber", "cast(l_quantity as decimal(18,2)) as TransactionAmount",
                                 "case when l_linenumber = 3 then 'Other' when l_linestatus = 'O' then 'Payment' else 'Reserve' end as TransactionType")
    return B.reserve_and_payment(claims, moved).select("claimid", *[F.col(c).cast("double").alias(c) for c in ("RESERVE", "PAYMENT")])


@query("""
with x as (select conv_id as claimid, lower(text) as x from conversations where text is not null)
select claimid, max(case when regexp_matches(x, 'attorney|lawyer|counsel|advocate|litigation') then 1 else 0 end) as "ATTORNEY_UNST_F",
  max(case when regexp_matches(x, 'fire|explosion|blast|arson') then 1 else 0 end) as "FIRE_UNST_F" from x group by 1""")
def note_flags(t: Tables):
    """Red flags of a claim's notes, for texts that cleaning leaves as they are but for marks and digits."""
    notes = t.conversations.filter("text is not null").select(F.col("conv_id").alias("ClaimID"), F.col("text").alias("Body"))
    return B.note_flags(notes, groups=("fire", "attorney")).select("claimid", "ATTORNEY_UNST_F", "FIRE_UNST_F")


@query("""
with c as (select o_orderkey as claimid, o_custkey % 27 as s, o_totalprice from orders)
select claimid, case when n_nationkey is not null then 'A' || n_nationkey end as "STATE_ABBR", r.r_name as "REGION", case when n_nationkey is not null then n_nationkey % 3 || '' end as "DIVISION"
from c left join nation on c.s = n_nationkey left join region r on n_regionkey = r.r_regionkey""")
def loss_region(t: Tables):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "'state ' || n_nationkey as lossloc_State", "'A' || n_nationkey as STATE_ABBR", "r_name as REGION", "'' || n_nationkey % 3 as DIVISION")
    claims = t.orders.selectExpr("o_orderkey as claimid", "' State ' || o_custkey % 27 as lossloc_State")
    return B.with_region(claims, places).select("claimid", "STATE_ABBR", "REGION", "DIVISION")


@query("""
with x as (select l_orderkey as claimid, l_linenumber as line, case l_returnflag when 'R' then '10001' when 'A' then '10002' end as side, l_partkey % 5 as cov, l_quantity as q from lineitem),
m as (select *, case cov when 0 then 'Auto BI' when 1 then 'Med Pay' when 2 then 'Auto PD' when 3 then 'Collision' end as cat from x)
select claimid, line, cat as cov_rollup_3, q, case when cat = 'Auto BI' then q else 0 end + case when cat = 'Med Pay' and side = '10002' then q else 0 end as "BI_Amount",
  case when cat in ('Auto PD', 'Collision') then q else 0 end as "PD_Amount" from m""")
def coverage_amounts(t: Tables):
    """The first line of the coverage map decides; amounts by class."""
    names = "case n_nationkey % 5 when 0 then 'Auto BI' when 1 then 'Med Pay' when 2 then 'Auto PD' when 3 then 'Collision' end"
    pairs = t.nation.selectExpr("' ' || n_nationkey % 5 as PrimaryCoverage", "'type' as exposuretype_desc",
                                f"case when n_nationkey < 5 then {names} else 'PIP' end as cov_rollup_3", "cast(n_nationkey as int) as line").filter("cov_rollup_3 is not null")
    fact = t.lineitem.selectExpr(
        "l_orderkey as claimid", "l_linenumber", "case l_returnflag when 'R' then '10001' when 'A' then '10002' end as LossParty",
        "case when l_partkey % 5 < 4 then '' || l_partkey % 5 end as PrimaryCoverage", "'type' as exposuretype_desc", "cast(l_quantity as decimal(18,2)) as TotalIncurredGross")
    return B.with_coverage(fact, pairs).select("claimid", F.col("l_linenumber").alias("line"), "cov_rollup_3", F.col("TotalIncurredGross").cast("double").alias("q"),
                                               *[F.col(c).cast("double").alias(c) for c in ("BI_Amount", "PD_Amount")])
