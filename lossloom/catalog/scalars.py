"""Conditional, date and math functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.functions import conditional as C
from lossloom.functions import dates as D
from lossloom.functions import maths as M
from lossloom.functions import text as X
from lossloom.operators import aggregates as A
from lossloom.operators import joins as J


@query("""
with lookup(line, kind, size_class, category) as (values
  (1, 'STANDARD', 'small', 'Auto BI'), (2, 'ECONOMY', 'small', 'Auto PD'), (3, 'PROMO', 'large', 'Building'),
  (4, 'PROMO', 'large', 'GL PD'), (5, 'MEDIUM', 'large', 'Med Pay')),
dedup as (select *, row_number() over (partition by kind, size_class order by line) as rn from lookup)
select p.p_partkey, d.category, case p.p_type when 'SMALL' then 'Glass_Damage' when 'LARGE' then 'Catastrophe' end as cause_group,
       case when p.p_size > 25 and p.p_retailprice > 1000 then 'big' when p.p_size > 25 then 'bulky' else 'plain' end as shape
from part p left join dedup d on p.p_type = d.kind and case when p.p_size <= 25 then 'small' else 'large' end = d.size_class and d.rn = 1""")
def category_lookup(t: Tables):
    """First-match lookup on two keys: the table is deduplicated by line, then joined; no long CASE."""
    lines = [(1, "STANDARD", "small", "Auto BI"), (2, "ECONOMY", "small", "Auto PD"), (3, "PROMO", "large", "Building"),
             (4, "PROMO", "large", "GL PD"), (5, "MEDIUM", "large", "Med Pay")]
    table = J.fixed_table(t.spark, lines, "line int, kind string, size_class string, category string")
    lookup = F.broadcast(J.first_match_table(table, ["kind", "size_class"], "category", "line"))
    part = t.part.withColumns({
        "kind": F.col("p_type"), "size_class": F.when(F.col("p_size") <= 25, "small").otherwise("large")})
    return part.join(lookup, ["kind", "size_class"], "left").select(
        "p_partkey", "category",
        C.recode(F.col("p_type"), {"SMALL": "Glass_Damage", "LARGE": "Catastrophe"}).alias("cause_group"),
        F.when((F.col("p_size") > 25) & (F.col("p_retailprice") > 1000), "big").when(F.col("p_size") > 25, "bulky")
        .otherwise("plain").alias("shape"))


@query("""
with m as (select l_orderkey, count(*) filter (where l_returnflag = 'R') as r, count(*) filter (where l_returnflag = 'A') as a,
  count(*) filter (where l_returnflag = 'N') as n,
  count(distinct case when l_returnflag = 'R' then l_suppkey else 0 end) as injured,
  count(distinct case when l_returnflag = 'R' then l_suppkey end) as injured_known,
  max(case when l_returnflag = 'R' and l_linestatus = 'O' then 1 else 0 end) as insured_new,
  max(case when l_returnflag = 'A' and l_linestatus in ('O', 'F') then 1 else 0 end) as tp_rented
  from lineitem group by 1)
select o.o_orderkey, case when nullif(o.o_orderstatus, 'P') = 'F' then 1 else 0 end as status_f,
  case when o.o_orderstatus = 'O' then 1 else 0 end as status_o, case when o.o_orderpriority = '5-LOW' then 1 else 0 end as low,
  case when nullif(o.o_orderstatus, 'P') = substr(o.o_orderpriority, 3, 1) then 1 else 0 end as equal_codes,
  m.insured_new, m.tp_rented, case when m.r > 0 and m.a = 0 and m.n = 0 then 1 else 0 end as returned_only,
  m.injured, m.injured_known, case when m.r > 0 or m.a > 0 then 1 else 0 end as collision_ind,
  case when m.r > 0 or m.a > 0 then 1 else 0 end + m.tp_rented as collision_overall,
  case when (m.r > 0 or m.a > 0) and m.r + m.a > 2 then 1 else 0 end as suspicious
from orders o join m on o.o_orderkey = m.l_orderkey""")
def indicator_columns(t: Tables):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    party = C.party_keyed(flag, "R", F.col("l_suppkey"))
    m = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        A.count_when(flag == "R").alias("r"), A.count_when(flag == "A").alias("a"), A.count_when(flag == "N").alias("n"),
        A.any_when((flag == "R") & (status == "O")).alias("insured_new"),
        A.any_when((flag == "A") & status.isin("O", "F")).alias("tp_rented"))
    known = A.distinct_counts(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_returnflag",
                                                party.alias("slot")), ["o_orderkey"], {
        "slot": {"injured": F.lit(True)}, "l_suppkey": {"injured_known": flag == "R"}})
    o = t.orders.withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    flags = C.value_indicators([("status", "F", "status_f"), ("o_orderstatus", "O", "status_o"), ("o_orderpriority", "5-LOW", "low")])
    collision = A.coalesce_flags([C.indicator(F.col("r") > 0), C.indicator(F.col("a") > 0)])
    return (
        o.select("o_orderkey", *[c.alias(n) for n, c in flags.items()],
                 C.equal_indicator(F.col("status"), F.substring("o_orderpriority", 3, 1)).alias("equal_codes"))
        .join(m, "o_orderkey").join(known, "o_orderkey")
        .withColumns({
            "returned_only": C.only_flag(F.col("r"), [F.col("a"), F.col("n")]),
            "collision_ind": collision,
            "collision_overall": collision + F.col("tp_rented"),
            "suspicious": C.indicator((collision == 1) & (F.col("r") + F.col("a") > 2)),
        })
        .drop("r", "a", "n")
    )


@query("""
with p as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_returnflag when 'R' then '10001' when 'A' then '10002' else '0' end as party,
  case when l_linenumber % 2 = 0 then 'S' || l_suppkey end as own, case when l_partkey % 3 = 0 then 'P' || l_partkey end as claimant,
  case when l_orderkey % 2 = 0 then 'O' || l_orderkey end as insured from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case when own is null and claimant is not null then claimant when own is null and claimant is null and party = '10001' then insured else own end as final_name,
  case when own is null and claimant is not null and party = '10002' then claimant
       when own is null and claimant is null and insured is not null and party = '10001' then insured else own end as final_name_1,
  case when insured is null and own is null and claimant is not null and party = '10001' then claimant
       when insured is null and own is not null and party = '10001' then own else insured end as insured_name_f,
  case when own is not null and party = '10002' then own else claimant end as claimant_name_f
from p""")
def name_precedence(t: Tables):
    flag = F.col("l_returnflag")
    party = F.when(flag == "R", "10001").when(flag == "A", "10002").otherwise("0")
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    p = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", party.alias("party"),
        F.when(F.col("l_linenumber") % 2 == 0, text("S", "l_suppkey")).alias("own"),
        F.when(F.col("l_partkey") % 3 == 0, text("P", "l_partkey")).alias("claimant"),
        F.when(F.col("l_orderkey") % 2 == 0, text("O", "l_orderkey")).alias("insured"))
    own, claimant, insured, side = F.col("own"), F.col("claimant"), F.col("insured"), F.col("party")
    return p.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.exposure_name(own, claimant, insured, side).alias("final_name"),
        C.exposure_name(own, claimant, insured, side, claimant_party="10002").alias("final_name_1"),
        C.insured_name(own, claimant, insured, side).alias("insured_name_f"),
        C.claimant_name(own, claimant, side).alias("claimant_name_f"))


@query("""
with x as (select *, cast(l_extendedprice as decimal(18,2)) as gross, cast(l_quantity as decimal(18,2)) as recovered from lineitem),
a as (select *, case when l_returnflag in ('A') then gross else 0 end + case when l_returnflag = 'R' and l_linestatus = 'F' then gross else 0 end as bi,
  case when l_returnflag in ('N') then gross else 0 end as pd from x)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(bi as double) as bi_amount, cast(pd as double) as pd_amount,
  cast(gross - recovered as double) as net, round(l_quantity / l_linenumber, 2) as rate,
  round(l_quantity / nullif(l_linenumber - 1, 0), 4) as safe_rate
from a""")
def amount_split(t: Tables):
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    flag = F.col("l_returnflag")
    zero = F.lit(0).cast("decimal(18,2)")
    first = F.when(flag.isin("A"), gross).otherwise(zero)
    second = F.when((flag == "R") & (F.col("l_linestatus") == "F"), gross).otherwise(zero)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (first + second).cast("double").alias("bi_amount"),
        F.when(flag.isin("N"), gross).otherwise(zero).cast("double").alias("pd_amount"),
        M.incurred_net(gross, zero, F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("net"),
        M.rounded_ratio(F.col("l_quantity"), F.col("l_linenumber")).alias("rate"),
        F.round(M.ratio(F.col("l_quantity"), F.col("l_linenumber") - 1), 4).alias("safe_rate"))


@query("""
select c_custkey, lower(c_name) as low, upper(c_name) || '|' || cast(c_nationkey as varchar) as key_text,
  'AFV10D' || cast(c_custkey * 1000 + c_nationkey + 1 as varchar) as delivery_id,
  array_to_string(list_reverse(string_split(c_mktsegment, 'I')), ' ') as joined
from customer""")
def case_concat(t: Tables):
    delivery = F.concat(F.lit("AFV10D"), (F.col("c_custkey") * 1000 + F.col("c_nationkey")).cast("string"))
    return t.customer.select(
        "c_custkey", F.lower("c_name").alias("low"),
        F.concat(F.upper("c_name"), F.lit("|"), F.col("c_nationkey").cast("string")).alias("key_text"),
        X.bump_suffix(delivery).alias("delivery_id"),
        F.array_join(F.reverse(F.split("c_mktsegment", "I")), " ").alias("joined"))


@query("""
with x as (select o_orderkey, o_orderdate + (o_orderkey % 86400) * interval 1 second as moment,
  cast(o_orderdate as date) as d, cast(o_orderdate as date) - cast(o_orderkey % 400 as integer) as eff,
  cast(o_orderdate as date) - cast(o_orderkey % 400 as integer) + cast(355 + o_orderkey % 10 as integer) as exp,
  case when o_orderkey % 4 = 0 then cast(o_orderdate as date) + 30 end as closed from orders)
select o_orderkey,
  case when hour(moment) = 0 and minute(moment) = 0 and second(moment) > 0 then 'twelveam'
       when hour(moment) >= 22 or hour(moment) < 4 then 'midnight'
       when hour(moment) >= 4 and hour(moment) < 8 then 'early morning' else 'dayhours' end as tod,
  case when hour(moment) <= 5 then '0 to 5' when hour(moment) <= 11 then '6 to 11' when hour(moment) <= 17 then '12 to 17' else '18 to 23' end as quarter,
  cast(hour(moment) as integer) as hod,
  case when dayofweek(d) in (0, 5, 6) then 1 else 0 end as weekend_flag,
  case when month(d) > 6 then 1 else 0 end as jul_dec,
  case when date_diff('day', eff, exp) > 359 then 1 else 0 end as long_policy,
  case when d <= eff + cast(round(0.2 * date_diff('day', eff, exp)) as integer)
         or d >= exp - cast(round(0.3 * date_diff('day', eff, exp)) as integer) then 1 else 0 end as period_extreme,
  case when d > eff and d < exp then 1 else 0 end as report_interval,
  cast(year(d) * 100 + month(d) as integer) as yr_mnth,
  cast(date_diff('day', d, coalesce(closed, date '2002-01-01')) as integer) as open_days,
  cast(case when year(d) = year(eff) then 1 else year(d) - year(eff) end as integer) as tenure_years,
  cast(case when year(d) * 100 + month(d) <> 200108 then 15 else date_diff('day', d, date '2001-08-15') end as integer) as month_days
from x""")
def date_parts(t: Tables):
    key = F.col("o_orderkey")
    x = t.orders.select(
        "o_orderkey",
        (F.col("o_orderdate") + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))).alias("moment"),
        F.to_date("o_orderdate").alias("d"),
        F.date_sub(F.to_date("o_orderdate"), (key % 400).cast("int")).alias("eff"),
    ).withColumns({
        "exp": F.date_add("eff", (355 + key % 10).cast("int")),
        "closed": F.when(key % 4 == 0, F.date_add("d", 30)),
    })
    moment, d, eff, exp = F.col("moment"), F.col("d"), F.col("eff"), F.col("exp")
    return x.select(
        "o_orderkey", D.hour_bucket(moment).alias("tod"), D.quarter_day(moment).alias("quarter"), F.hour(moment).alias("hod"),
        D.weekend(d).alias("weekend_flag"), D.second_half(d).alias("jul_dec"), D.long_policy(eff, exp).alias("long_policy"),
        D.policy_period_extreme(d, eff, exp).alias("period_extreme"), D.inside(d, eff, exp).alias("report_interval"),
        D.year_month(d).alias("yr_mnth"),
        D.open_days(d, F.col("closed"), F.lit("2002-01-01").cast("date")).alias("open_days"),
        D.year_difference(eff, d, zero_as_one=True).alias("tenure_years"),
        D.days_open_in_month(d, F.lit("2001-08-15").cast("date")).alias("month_days"))


@query("""
select event_id, cast(floor((epoch_us(timestamp '2024-02-01 12:00:00') - epoch_us(ts)) / 86400000000.0) as integer) as days,
  cast(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-15 06:30:00')) / 86400000000.0) as integer) as signed_days,
  cast(coalesce(case when event_id % 3 = 0 then null else floor((epoch_us(timestamp '2024-02-01') - epoch_us(ts)) / 86400000000.0) end, 1625) as integer) as filled
from events""")
def elapsed_days(t: Tables):
    moment = lambda text: F.lit(text).cast("timestamp_ntz")
    known = F.when(F.col("event_id") % 3 != 0, F.col("ts"))
    return t.events.select(
        "event_id",
        D.elapsed_days(F.col("ts"), moment("2024-02-01 12:00:00")).alias("days"),
        D.elapsed_days(moment("2024-01-15 06:30:00"), F.col("ts")).alias("signed_days"),
        D.elapsed_days(known, moment("2024-02-01 00:00:00"), default=1625).alias("filled"))


@query("""
with p as (select o.o_orderkey, o.o_custkey, cast(o.o_orderdate as date) as reported, c.c_mktsegment as segment, c.c_nationkey as nation,
   cast(o.o_orderdate as date) - 300 as eff,
   case when o.o_orderkey % 3 = 0 then null when o.o_orderkey % 3 = 1 then cast(o.o_orderdate as date) - 5000 else cast(o.o_orderdate as date) - 700 end as orig
   from orders o join customer c on o.o_custkey = c.c_custkey),
 n as (select *, case when segment <> 'BUILDING' then segment || nation end as name,
   case when orig is null or year(orig) < 1991 then eff else orig end as oldest from p),
 by_name as (select name, min(oldest) as d1 from n where name is not null group by 1),
 by_id as (select o_custkey, min(oldest) as d2 from n where name is null group by 1),
 j as (select n.*, d1, d2 from n left join by_name b on n.name = b.name left join by_id i on n.o_custkey = i.o_custkey),
 f as (select *, case when d1 is not null and year(d1) > 1990 then d1 when year(d1) < 1991 and d2 is null then orig else d2 end as f1 from j),
 g as (select *, case when f1 is null and orig is not null and year(orig) > 1990 then orig
                      when f1 is null and orig is not null and year(orig) < 1991 then eff else f1 end as f2 from f)
select o_orderkey, cast(date_diff('day', f2, reported) as integer) as tenure_days,
  cast(case when year(reported) = year(f2) then 1 else year(reported) - year(f2) end as integer) as tenure_years from g""")
def claimant_tenure(t: Tables):
    """Days since the oldest valid policy date of the same party, by name, else by id, else of the claim itself."""
    from lossloom.plans.features import party_tenure

    day = F.to_date("o_orderdate")
    part = F.col("o_orderkey") % 3
    p = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("o_custkey").alias("party_id"), day.alias("reported"), F.date_sub(day, 300).alias("effective"),
        F.when(part == 1, F.date_sub(day, 5000)).when(part == 2, F.date_sub(day, 700)).alias("original"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))).alias("name"))
    return party_tenure(p, p).select("o_orderkey", F.col("claimant_tenure").alias("tenure_days"),
                                     F.col("claimant_tenure_yr").alias("tenure_years"))


@query("""
with c as (select vec_id, generate_subscripts(embedding, 1) - 1 as pos, abs(cast(unnest(embedding) as double)) as x,
                  unnest(embedding)::double as raw from embeddings),
s as (select *, sum(x) over (partition by vec_id) as total, sqrt(sum(raw * raw) over (partition by vec_id)) as len from c)
select vec_id, cast(pos as integer) as pos, round(x / total, 4) as share, round(raw / len, 4) as unit,
  case when abs(raw / len) > 0.1 then 1 else 0 end as above from s""")
def vector_math(t: Tables):
    e = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    e = e.select("vec_id", M.share_of_sum(F.transform("v", F.abs)).alias("s"), M.unit_length(F.col("v")).alias("u"))
    e = e.select("vec_id", F.posexplode(F.arrays_zip("s", "u")).alias("pos", "c"))
    return e.select("vec_id", "pos", F.round("c.s", 4).alias("share"), F.round("c.u", 4).alias("unit"),
                    M.threshold_class(F.abs("c.u"), 0.1).alias("above"))
