"""Whole jobs on the driver's tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.functions import conditional as C
from lossloom.functions import dates as D
from lossloom.functions import maths as M
from lossloom.operators import joins as J
from lossloom.operators import model as G
from lossloom.plans import features as B
from lossloom.plans import jobs, training, triage
from lossloom.session import scratch_path
from lossloom.sources import runs, sinks


@query("""
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.p_brand, n.n_name as contact_nation,
  cast(year(l.l_shipdate) - (1990 + p.p_size) as integer) as vehicle_age,
  cast(date_diff('day', o.o_orderdate, l.l_shipdate) as integer) as pc_issue_report,
  case when l.l_shipdate > o.o_orderdate and l.l_shipdate < o.o_orderdate + interval 60 day then 1 else 0 end as report_interval,
  case when s.s_nationkey = c.c_nationkey then 1 else 0 end as state_match,
  cast(cast(l.l_extendedprice as decimal(18,2)) + cast(l.l_quantity as decimal(18,2)) - cast(l.l_tax as decimal(18,2)) as double) as incurred_net
from lineitem l join orders o on l.l_orderkey = o.o_orderkey left join customer c on o.o_custkey = c.c_custkey
left join part p on l.l_partkey = p.p_partkey left join supplier s on l.l_suppkey = s.s_suppkey
left join nation n on s.s_nationkey = n.n_nationkey""")
def exposure_fact(t: Tables):
    """Claim, exposure, insured, part, claimant and code tables with derived measures."""
    claims = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    suppliers = J.decode(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
                         {"s_nationkey": (t.nation, "contact_nation")}, "n_nationkey", "n_name")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                              "l_quantity", "l_tax")
    fact = lines.join(claims, "l_orderkey").join(parts, "l_partkey", "left").join(suppliers, "l_suppkey", "left")
    money = lambda c: F.col(c).cast("decimal(18,2)")
    end = F.col("o_orderdate") + F.expr("interval 60 days")
    return fact.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_brand", "contact_nation",
        D.vehicle_age(F.col("l_shipdate"), 1990 + F.col("p_size")).alias("vehicle_age"),
        D.day_difference(F.col("o_orderdate"), F.col("l_shipdate")).alias("pc_issue_report"),
        D.inside(F.col("l_shipdate"), F.col("o_orderdate"), end).alias("report_interval"),
        C.equal_indicator(F.col("s_nationkey"), F.col("c_nationkey")).alias("state_match"),
        M.incurred_net(money("l_extendedprice"), money("l_quantity"), money("l_tax")).cast("double").alias("incurred_net"))


def _claim_fact(t: Tables):
    """The driver's tables in the shape of the exposure fact: party sides from the return flag."""
    claims = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("claimid"), F.col("c_nationkey").alias("nation"))
    side = F.when(F.col("l_returnflag") == "R", "10001").when(F.col("l_returnflag") == "A", "10002")
    lines = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("claimid"), side.alias("LossParty"), F.col("l_suppkey").alias("ClaimantDenormID_exp"),
        F.col("s_nationkey").alias("s_nation"), "l_linenumber", "l_partkey", "l_linestatus", "l_quantity", "l_shipdate")
    return lines.join(claims, "claimid")


@query("""
with x as (select l_orderkey as claimid, l_returnflag as f, case when s_nationkey = c_nationkey then 1 else 0 end as city,
  case when s_nationkey % 5 = c_nationkey % 5 then 1 else 0 end as zip, case when s_nationkey % 2 = c_nationkey % 2 then 1 else 0 end as state
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey)
select claimid, max(case when f = 'R' then city else 0 end) as "LOSSLOC_CITY_FP_F", max(case when f = 'A' then city else 0 end) as "LOSSLOC_CITY_TP_F",
  max(case when f in ('R', 'A') then city else 0 end) as "LOSSLOC_CITY_FP_TP_F",
  max(case when f = 'R' then zip else 0 end) as "LOSSLOC_ZIP_FP_F", max(case when f = 'A' then zip else 0 end) as "LOSSLOC_ZIP_TP_F",
  max(case when f in ('R', 'A') then zip else 0 end) as "LOSSLOC_ZIP_FP_TP_F",
  max(case when f = 'R' then state else 0 end) as "LOSSLOC_STATE_FP_F", max(case when f = 'A' then state else 0 end) as "LOSSLOC_STATE_TP_F",
  max(case when f in ('R', 'A') then state else 0 end) as "LOSSLOC_STATE_FP_TP_F"
from x group by 1""")
def location_match(t: Tables):
    a, b = F.col("s_nation"), F.col("nation")
    fact = _claim_fact(t).withColumns({
        "city_match": C.equal_indicator(a, b), "postal_code_match": C.equal_indicator(a % 5, b % 5),
        "state_match": C.equal_indicator(a % 2, b % 2)})
    return B.location_matches(fact)


@query("""
with x as (select l_orderkey as claimid, case l_returnflag when 'R' then '10001' when 'A' then '10002' end as party, l_suppkey,
   case when l_linestatus = 'O' then 'Med Pay' else 'Collision' end as cov from lineitem),
b as (select claimid, max(case when cov = 'Med Pay' then 1 else 0 end) as bi from x group by 1)
select x.claimid, count(distinct case when party = '10001' and bi = 1 then l_suppkey else 0 end) as "FP_INJURED_CNT",
  count(distinct case when party = '10002' and bi = 1 then l_suppkey else 0 end) as "TP_INJURED_CNT"
from x join b on x.claimid = b.claimid group by 1""")
def injured_parties(t: Tables):
    fact = _claim_fact(t).withColumn("cov_rollup_3", F.when(F.col("l_linestatus") == "O", "Med Pay").otherwise("Collision"))
    return B.injured_counts(fact)


@query("""
with x as (select l_orderkey as claimid, case when l_returnflag = 'R' then 1 when l_returnflag = 'A' then 0 end as a,
  case when l_linestatus = 'O' then 1 when l_quantity > 40 then 0 end as b from lineitem)
select claimid, max(a) as "VehicleDriveable", max(b) as "VehicleParked", max(a) as "TotalLoss", max(b) as "Ext_EntireSideDamaged",
  max(case when a is not null then 1 - a end) as "Ext_LowImpactIncident" from x group by 1""")
def vehicle_flags(t: Tables):
    a = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    b = F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_quantity") > 40, 0)
    fact = t.lineitem.select(
        F.col("l_orderkey").alias("claimid"), a.alias("VehicleDriveable"), b.alias("VehicleParked"), a.alias("TotalLoss"),
        b.alias("Ext_EntireSideDamaged"), (1 - a).alias("Ext_LowImpactIncident"))
    return B.vehicle_flags(fact)


@query("""
with x as (select l_orderkey as claimid, case l_linenumber when 1 then 'Auto BI' when 2 then 'Auto PD' when 3 then 'Collision'
   when 4 then 'COMPREHENSIVE' when 5 then 'Med Pay' when 6 then 'GL PD' end as cov from lineitem),
c as (select claimid, count(*) filter (where cov = 'Auto BI') as "AUTO_BI", count(*) filter (where cov = 'Auto PD') as "AUTO_PD",
  count(*) filter (where cov = 'Collision') as "AUTO_COLLISION", count(*) filter (where cov = 'COMPREHENSIVE') as "COMPREHENSIVE",
  count(*) filter (where cov = 'Med Pay') as "MEDPAY", count(*) filter (where cov = 'GL PD') as "GL_PD",
  max(case when cov in ('Auto BI', 'Med Pay') then 1 else 0 end) as "BI" from x group by 1)
select *, case when "COMPREHENSIVE" > 0 and "AUTO_BI" + "AUTO_PD" + "AUTO_COLLISION" + "MEDPAY" + "GL_PD" = 0 then 1 else 0 end as comprehensive_only,
  case when "AUTO_COLLISION" > 0 and "AUTO_BI" + "AUTO_PD" + "COMPREHENSIVE" + "MEDPAY" + "GL_PD" = 0 then 1 else 0 end as collision_only from c""")
def coverage_rollup(t: Tables):
    names = {1: "Auto BI", 2: "Auto PD", 3: "Collision", 4: "COMPREHENSIVE", 5: "Med Pay", 6: "GL PD"}
    fact = t.lineitem.select(F.col("l_orderkey").alias("claimid"), C.recode(F.col("l_linenumber"), names).alias("cov_rollup_3"))
    unused = ["PIP", "RENTAL_REIMB", "TOW_LABOR", "ALL_OTHER", "BUILDING", "CONTENTS", "GL_BI"]
    return B.coverage_rollup(fact).drop(*unused)


@query("""
with old as (select doc_id, text as description, 0 as is_new from documents where doc_id % 2 = 0),
new as (select doc_id, text, 1 from documents where doc_id % 2 = 1),
txt as (select * from old union all select * from new),
notes as (select conv_id as doc_id, string_agg(text, ' , ' order by turn, role, text) as notes from conversations group by 1)
select t.doc_id, t.is_new, l.quality,
  case when contains(lower(t.description), 'loss') then 1 else 0 end as totalloss_flag,
  case when regexp_matches(lower(t.description), 'replac | repair') then 1 else 0 end as glass_flag,
  case when contains(lower(t.description), 'rear') then 1 else 0 end as rear_flag,
  case when contains(lower(t.description), 'person') then 1 else 0 end as unknownperson_flag,
  case when regexp_matches(lower(t.description), 'claim | shop') then 1 else 0 end as remark_flag,
  case when contains(lower(t.description), 'stolen') then 1 else 0 end as stolen_flag,
  case when regexp_matches(coalesce(lower(n.notes), ''), 'repo|rpt') then 1 else 0 end as policereport_flag,
  case when regexp_matches(coalesce(lower(n.notes), ''), 'pay | auth | record') then 1 else 0 end as med_flag,
  case when contains(coalesce(lower(n.notes), ''), 'loss') then 1 else 0 end as wageloss_flag,
  case when regexp_matches(coalesce(lower(n.notes), ''), 'protect | person') then 1 else 0 end as injuri_flag,
  case when contains(coalesce(lower(n.notes), ''), 'therapi') then 1 else 0 end as softtissue_flag,
  case when contains(coalesce(lower(n.notes), ''), 'attorney') then 1 else 0 end as attorney_flag,
  case when contains(coalesce(lower(n.notes), ''), 'key') then 1 else 0 end as keys_flag, x.n_turns
from txt t join labels l on t.doc_id = l.doc_id left join notes n on t.doc_id = n.doc_id
left join (select conv_id, count(*) as n_turns from conversations group by 1) x on t.doc_id = x.conv_id""")
def train_frame(t: Tables):
    """Old and new rows, texts, topic columns and keyword flags on one key."""
    half = lambda df, part: df.filter(F.col("doc_id") % 2 == part)
    structured = training.old_and_new(half(t.labels.select("doc_id", "quality"), 0), half(t.labels.select("doc_id", "quality"), 1))
    notes = t.conversations.withColumnRenamed("conv_id", "doc_id")
    flags = B.note_keyword_flags(notes, "doc_id", ["turn", "role", "text"], "text")
    texts = t.documents.select("doc_id", F.col("text").alias("Description"))
    texts = training.old_and_new(half(texts, 0), half(texts, 1))
    turns = t.conversations.groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_turns"))
    return training.training_frame(structured, texts, flags, turns, "doc_id").drop("Description")


_WEEK_SQL = """
cur as (select 'C' || o_orderkey as claim_number, o_orderstatus as s, o_totalprice as p from orders where o_orderdate >= timestamp '1997-01-01'),
prev as (select 'C' || o_orderkey as claim_number, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as s, o_totalprice as p
         from orders where o_orderdate < timestamp '2000-01-01'),
both_weeks as (select * from cur where claim_number in (select claim_number from prev)
               union select * from prev where claim_number in (select claim_number from cur)),
changes as (select cur.claim_number, coalesce(n, 0) as changed_value from cur left join
            (select claim_number, count(*) as n from both_weeks group by 1) b on cur.claim_number = b.claim_number),
scores as (select 'C' || o_orderkey as claim_number, round((o_orderkey * 7919 % 10007) / 10007.0, 4) as predicted_prob,
                  cast(o_totalprice as double) as reserve, cast(o_orderdate as timestamp) as reported from orders),
hist as (select 'C' || o_orderkey as claim_number, cast(o_orderkey % 2 as integer) as previous_referral, cast(o_orderkey % 7 = 0 as integer) as siu_referral,
                'AFV10D' || (o_orderkey % 50) as delivery_id,
                case o_orderkey % 4 when 0 then 'SIU Investigation' when 2 then 'Rejected Referral' end as classification
         from orders where o_orderkey % 5 <> 0),
wk as (select s.*, c.changed_value, coalesce(previous_referral, 0) as previous_referral, coalesce(siu_referral, 0) as siu_referral,
              coalesce(classification, '0') as classification, delivery_id
       from scores s join changes c on s.claim_number = c.claim_number left join hist h on s.claim_number = h.claim_number),
ranked as (select *, rank() over (order by predicted_prob desc) as rk, count(*) over () as n from wk),
ref as (select *, case when rk <= cast(floor(n * 0.05) as bigint) + 1 then 1 else 0 end as referred from ranked),
fin as (select *, case when referred = 0 or classification = 'SIU Investigation' or (classification = 'Rejected Referral' and changed_value = 1)
                  then 0 else 1 end as referral_final,
               case when (previous_referral = 0 and siu_referral = 1) or previous_referral = 1 then 1 else 0 end as previous_referral_final from ref)"""


def _week(t: Tables):
    o = t.orders
    claim = F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("claim_number")
    key = F.col("o_orderkey")
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    current = o.filter(F.col("o_orderdate") >= at("1997-01-01")).select(claim, F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    previous = o.filter(F.col("o_orderdate") < at("2000-01-01")).select(
        claim, F.when(key % 3 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"), F.col("o_totalprice").alias("p"))
    scores = o.select(claim, F.round((key * 7919 % 10007) / F.lit(10007.0), 4).alias("predicted_prob"),
                      F.col("o_totalprice").alias("reserve"), F.col("o_orderdate").alias("reported"))
    known = o.filter(key % 5 != 0)
    sheet = known.select(claim, (key % 2).cast("int").alias("previous_referral"), F.lit(0).alias("model_referral"),
                         (key % 7 == 0).cast("int").alias("siu_referral"),
                         F.concat(F.lit("AFV10D"), (key % 50).cast("string")).alias("delivery_id"))
    status = known.select(claim, F.when(key % 4 == 0, "SIU Investigation").when(key % 4 == 2, "Rejected Referral").alias("classification"))
    return triage.referrals(current, previous, scores, triage.triage_history(sheet, status), 0.05)


@query(f"""
with {_WEEK_SQL},
dealt as (select claim_number, row_number() over (order by reserve desc, claim_number) as seq from fin where referral_final = 1)
select fin.claim_number, changed_value, predicted_prob, referred, referral_final, previous_referral_final, reserve,
  coalesce(case dealt.seq % 3 when 1 then 'first' when 2 then 'second' when 0 then 'third' end, 'NA') as member,
  'AFV10D' || (cast(substr(coalesce(delivery_id, 'AFV10D10'), 7, 4) as integer) + 1) as delivery_id,
  cast(date_diff('day', reported, timestamp '2001-09-01') as integer) as open_days, 'AFV10' as model_id, 'Open' as claim_status
from fin left join dealt on fin.claim_number = dealt.claim_number""")
def triage_sheet(t: Tables):
    """Change value, history, top 5 % with ties, override, ids, members and open days."""
    sheet = triage.triage_sheet(_week(t), F.lit("2001-09-01").cast("date"), ["first", "second", "third"])
    return sheet.select("claim_number", "changed_value", "predicted_prob", "referred", "referral_final", "previous_referral_final",
                        "reserve", "member", "delivery_id", "open_days", "model_id", "claim_status")


@query("""
select o_orderkey as "CLAIMID", 'C' || o_orderkey as "CLAIMNUMBER", round((o_orderkey * 7919 % 10007) / 10007.0, 4) as "PREDICTED_PROB",
  cast(o_orderdate as date) as "REPORTED_DAY", cast(date_diff('day', o_orderdate, timestamp '2002-01-01') as integer) as "OPEN_DAYS",
  'AFV10D' || ((select max(o_orderkey % 37) from orders where o_orderstatus = 'F') + 1) as "DELIVERYID", 'Open' as "CLAIM_STATUS"
from orders where o_orderstatus = 'O'""")
def scored_output(t: Tables):
    """Delivery id after the highest of the earlier output, written to and read from a dated run."""
    earlier = t.orders.filter("o_orderstatus = 'F'").select(
        F.concat(F.lit("AFV10D"), (F.col("o_orderkey") % 37).cast("string")).alias("DELIVERYID"))
    root = scratch_path(t.spark, "scored")
    sinks.write_run(earlier, root, "2001-12-25")
    delivery = triage.next_delivery(t.spark.read.schema("DELIVERYID string").parquet(root))
    scores = t.orders.filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("CLAIMID"), F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("CLAIMNUMBER"),
        F.col("o_orderdate").alias("REPORTEDDATE"), ((F.col("o_orderkey") * 7919 % 10007) / F.lit(10007.0)).alias("PREDICTED_PROB"))
    out = triage.scored_output(scores, F.lit("2002-01-01").cast("date"), delivery)
    sinks.write_run(out, root, "2002-01-01")
    return out.select("CLAIMID", "CLAIMNUMBER", "PREDICTED_PROB", F.to_date("REPORTEDDATE").alias("REPORTED_DAY"), "OPEN_DAYS",
                      "DELIVERYID", "CLAIM_STATUS")


@query("""
with o as (select *, case when o_totalprice > 150000 then 1 else 0 end as large,
             case when o_orderdate < timestamp '1997-01-01' then 1 else 2 end as delivery from orders),
rate as (select o_orderpriority, avg(large) as p from o where delivery = 1 group by 1)
select o_orderkey as "CLAIMID", round(p, 2) as "PREDICTED_PROB", 'AFV10D' || delivery as "DELIVERYID",
  case delivery when 1 then date '2001-12-25' else date '2002-01-01' end as "SCORING_DATE", 2::bigint as runs, (select count(*) from orders) as back_scored
from o join rate using (o_orderpriority)""")
def scoring_job(t: Tables):
    """Two weekly runs over files, the second one repeated: back-scores of all rows, one delivery for each claim.

    The saved model is a logistic regression on one text column, whose fitted probabilities are the shares of its values.
    """
    frame = t.orders.select(
        F.col("o_orderkey").alias("CLAIMID"), F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("CLAIMNUMBER"),
        F.col("o_orderdate").alias("REPORTEDDATE"), "o_orderpriority", (F.col("o_totalprice") > 150000).cast("double").alias("label"))
    first = frame.filter(F.col("REPORTEDDATE") < F.lit("1997-01-01").cast("timestamp_ntz"))
    root = scratch_path(t.spark, "scoring")
    stages = [*G.encoder(first, ["o_orderpriority"], []).getStages(), LogisticRegression(maxIter=200, tol=1e-10)]
    sinks.save_model(Pipeline(stages=stages).fit(first), f"{root}/model")
    for run_date, rows in (("2001-12-25", first), ("2002-01-01", frame), ("2002-01-01", frame)):
        last = jobs.scoring_run(t.spark, root, run_date, rows.drop("label"), f"{root}/model")
    return runs.read_published(t.spark, root, "output").select(
        "CLAIMID", F.round("PREDICTED_PROB", 2).alias("PREDICTED_PROB"), "DELIVERYID", "SCORING_DATE",
        F.lit(len(runs.published_runs(t.spark, root))).cast("bigint").alias("runs"), F.lit(last["scored"]).cast("bigint").alias("back_scored"))
