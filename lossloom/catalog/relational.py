"""Populations, joins and set changes. Claim = orders, exposure = lineitem, insured = customer, claimant = supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.functions.conditional import indicator, longer_text, recode
from lossloom.functions.dates import day_difference, in_month_of, weekend
from lossloom.operators import aggregates as A
from lossloom.operators import filters as L
from lossloom.operators import joins as J
from lossloom.operators import sets as U
from lossloom.sources import readers, sinks
from lossloom.session import scratch_path

AS_OF = "1999-01-01"


def _money(column):
    return F.col(column).cast("decimal(18,2)")


@query("""
with lines as (
  select l_orderkey,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total_price,
         cast(max(l_discount) as double) as max_discount,
         count(*) as exposure_count,
         count(*) filter (where l_linestatus = 'O') as open_lines,
         count(distinct l_suppkey) as claimant_count,
         count(distinct case when l_returnflag = 'R' then l_suppkey end) as returned_claimants,
         max(case when l_returnflag = 'R' then 1 else 0 end) as any_returned
  from lineitem group by l_orderkey)
select o.o_orderkey as claim_id, n.n_name as nation_name, r.r_name as region_name,
       cast(date_diff('day', o.o_orderdate, timestamp '1999-01-01') as integer) as report_lag,
       l.total_price, l.max_discount,
       coalesce(l.exposure_count, 0) as exposure_count, coalesce(l.open_lines, 0) as open_lines,
       coalesce(l.claimant_count, 0) as claimant_count, coalesce(l.returned_claimants, 0) as returned_claimants,
       coalesce(l.any_returned, 0) as any_returned,
       case when coalesce(l.returned_claimants, 0) > 0 then 'thirdparty_claim' else 'insured_claim' end as claimtype,
       case when dayofweek(o.o_orderdate) in (0, 5, 6) then 1 else 0 end as weekend_flag
from orders o
left join customer c on o.o_custkey = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey
left join lines l on o.o_orderkey = l.l_orderkey
where o.o_orderstatus in ('O', 'P')""")
def claim_summary(t: Tables):
    """Open claims, decoded, with exposures folded to one row per claim before the join."""
    claims = t.orders.filter(F.col("o_orderstatus").isin("O", "P")).select("o_orderkey", "o_custkey", "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_linestatus", "l_returnflag")
    per_supplier = lines.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(_money("l_extendedprice")).alias("price"),
        F.max("l_discount").alias("discount"),
        F.count(F.lit(1)).alias("lines"),
        A.count_when(F.col("l_linestatus") == "O").alias("open"),
        A.any_when(F.col("l_returnflag") == "R").alias("returned"),
    )
    measures = per_supplier.groupBy("l_orderkey").agg(
        F.sum("price").cast("double").alias("total_price"),
        F.max("discount").alias("max_discount"),
        F.sum("lines").alias("exposure_count"),
        F.sum("open").alias("open_lines"),
        F.count(F.lit(1)).alias("claimant_count"),
        F.sum("returned").alias("returned_claimants"),
        F.max("returned").alias("any_returned"),
    )
    base = J.decode(
        claims.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left"),
        {"c_nationkey": (t.nation, "nation_name")}, code="n_nationkey", label="n_name",
    )
    regions = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    base = J.decode(base.join(regions, "c_nationkey", "left"), {"n_regionkey": (t.region, "region_name")},
                    code="r_regionkey", label="r_name")
    counts = ["exposure_count", "open_lines", "claimant_count", "returned_claimants", "any_returned"]
    return (
        base.withColumnRenamed("o_orderkey", "claim_id")
        .join(measures.withColumnRenamed("l_orderkey", "claim_id"), "claim_id", "left")
        .fillna(0, counts)
        .select(
            "claim_id", "nation_name", "region_name",
            day_difference(F.col("o_orderdate"), F.lit(AS_OF).cast("date")).alias("report_lag"),
            "total_price", "max_discount", *counts,
            F.when(F.col("returned_claimants") > 0, "thirdparty_claim").otherwise("insured_claim").alias("claimtype"),
            weekend(F.col("o_orderdate")).alias("weekend_flag"),
        )
    )


@query("""
select n.n_nationkey as "N_NATIONKEY", n.n_name as "N_NAME", r.r_name as "R_NAME"
from nation n join region r on n.n_regionkey = r.r_regionkey""")
def csv_roundtrip(t: Tables):
    """Write CSV with a header in an older encoding, read it with a schema, upper-case the header."""
    path = scratch_path(t.spark, "csv")
    out = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name", F.lit("x").alias("Unnamed: 0"))
    sinks.write_csv(out, path)
    back = readers.read_csv(t.spark, path, "n_nationkey int, n_name string, r_name string, `Unnamed: 0` string",
                            encoding="ISO-8859-1")
    return readers.with_header_case(readers.drop_artefacts(back))


@query("""
select c_custkey as claim_id, upper(c_mktsegment) as segment_name,
       cast(trunc(c_acctbal) as integer) as whole_balance, 'AFV10' as model_id,
       case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 end as segment_map,
       case c_mktsegment when 'BUILDING' then 'BLD' else c_mktsegment end as segment_replaced,
       cast(c_nationkey as varchar) as nation_code
from customer""")
def project_rename_recode(t: Tables):
    segment = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey",
        F.upper(segment).alias("segment_name"),
        F.col("c_acctbal").cast("int").alias("whole_balance"),
        F.lit("AFV10").alias("model_id"),
        recode(segment, {"BUILDING": 1, "MACHINERY": 2}).alias("segment_map"),
        recode(segment, {"BUILDING": "BLD"}, keep_unmapped=True).alias("segment_replaced"),
        F.col("c_nationkey").cast("string").alias("nation_code"),
    ).withColumnsRenamed({"c_custkey": "claim_id"})


@query("""
with parsed as (
  select event_id, nullif(event_type, 'view') as kind,
         regexp_extract(props, '"k": ([0-9]+)', 1) as k,
         regexp_extract(props, '"missing": ([0-9]+)', 1) as missing
  from events)
select event_id, coalesce(kind, 'none') as kind, try_cast(k as integer) as k,
       coalesce(try_cast(missing as integer), -1) as missing,
       try_cast('2024-01-' || k as date) as day_guess,
       coalesce(try_cast('2024-01-' || k as date), date '2024-01-31') as day_filled,
       coalesce(nullif(missing, ''), kind, 'none') as first_text
from parsed""")
def tolerant_parse_fill(t: Tables):
    e = t.events.select(
        "event_id", "event_type",
        F.regexp_extract("props", '"k": ([0-9]+)', 1).alias("k"),
        F.regexp_extract("props", '"missing": ([0-9]+)', 1).alias("missing"),
    ).replace(["view"], [None], subset=["event_type"])
    guess = F.concat(F.lit("2024-01-"), F.col("k")).try_cast("date")
    return e.select(
        "event_id",
        F.coalesce("event_type", F.lit("none")).alias("kind"),
        F.col("k").try_cast("int").alias("k"),
        F.coalesce(F.col("missing").try_cast("int"), F.lit(-1)).alias("missing"),
        guess.alias("day_guess"),
        F.coalesce(guess, F.lit("2024-01-31").cast("date")).alias("day_filled"),
        F.coalesce(F.nullif(F.col("missing"), F.lit("")), "event_type", F.lit("none")).alias("first_text"),
    )


@query("""
select doc_id, case when text is null or length(text) < 60 then source else text end as chosen,
       cast(length(text) as integer) as n
from documents""")
def text_choice(t: Tables):
    return t.documents.select(
        "doc_id", longer_text(F.col("text"), F.col("source"), 60).alias("chosen"), F.length("text").alias("n"))


@query("""
select c.c_custkey as id, c.c_name as name, n.n_name as nation
from customer c join nation n on c.c_nationkey = n.n_nationkey""")
def dedupe_columns(t: Tables):
    left = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_nationkey")
    right = t.nation.select(F.col("n_nationkey").alias("id_n"), F.col("n_name").alias("nation"), F.lit("-").alias("w"))
    joined = left.join(right, F.col("c_nationkey") == F.col("id_n")).select("id", "name", "nation", F.col("w").alias("NAME"))
    return readers.keep_first_columns(joined)


@query("""
select o_orderkey, nullif(o_orderstatus, 'P') as status from orders
where nullif(o_orderstatus, 'P') is null or nullif(o_orderstatus, 'P') not in ('F')""")
def keep_null_notin(t: Tables):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.select("o_orderkey", status.alias("status")).filter(L.not_in_or_null(F.col("status"), ["F"]))


@query("""
with versions as (
  select o_custkey, o_orderkey, o_totalprice,
         lead(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as next_key
  from orders)
select o_custkey, o_orderkey, cast(o_totalprice as double) as price from versions where next_key is null""")
def current_records(t: Tables):
    """Last version per customer found by an aggregate, then marked and filtered like a slowly changing table."""
    o = t.orders
    last = o.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("row"))
    versions = last.select(
        "o_custkey", "row.o_orderkey", F.col("row.o_totalprice").alias("price"), F.lit(1).alias("is_current"),
        F.lit(L.OPEN_END).alias("end_date"), F.lit(1).alias("valid_rec"), F.lit(2).alias("valid_flag"))
    current = L.current_records(versions, "is_current", "end_date", "valid_rec", "valid_flag")
    return current.select("o_custkey", "o_orderkey", "price")


@query("""
select p_partkey, p_type from part
where p_size between 10 and 20 and p_type in ('PROMO', 'SMALL')
  and (p_name like '%ring%' or p_name like 'red%' or p_name like '%bolt')""")
def range_membership(t: Tables):
    name = F.col("p_name")
    return t.part.filter(
        F.col("p_size").between(10, 20) & F.col("p_type").isin("PROMO", "SMALL")
        & (name.contains("ring") | name.like("red%") | name.like("%bolt"))
    ).select("p_partkey", "p_type")


@query("""
select o_orderkey, cast(o_orderdate as date) as order_day from orders
where year(o_orderdate) >= 1998 and year(o_orderdate) = 1999 and month(o_orderdate) = 3""")
def month_and_year_bounds(t: Tables):
    moment = F.col("o_orderdate")
    as_of = F.lit("1999-03-15").cast("date")
    return t.orders.filter(L.from_year(moment, 1998) & in_month_of(moment, as_of)).select(
        "o_orderkey", F.to_date(moment).alias("order_day"))


@query("""
select case when nullif(upper(c_mktsegment), 'BUILDING') is not null
             and upper(c_mktsegment) not in ('MACHINERY') then 'named' else 'unnamed' end as side,
       count(*) as n, cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance
from customer group by 1""")
def named_unnamed_split(t: Tables):
    name = F.nullif(F.upper("c_mktsegment"), F.lit("BUILDING"))
    c = t.customer.select(
        F.when(name == "MACHINERY", "Suspense Policy").otherwise(name).alias("name"), _money("c_acctbal").alias("b"))
    return (
        c.groupBy(F.when(L.named(F.col("name")), "named").otherwise("unnamed").alias("side"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("b").cast("double").alias("balance"))
    )


@query("""
with pairs as (select p_brand, p_type from part group by 1, 2 having avg(p_size) > 25.5)
select l.l_orderkey, l.l_linenumber, l.l_partkey from lineitem l join part p on l.l_partkey = p.p_partkey
where (p.p_brand, p.p_type) in (select (p_brand, p_type) from pairs)""")
def pair_population(t: Tables):
    """Semi join to (brand, type) pairs that come from data."""
    pairs = t.part.groupBy("p_brand", "p_type").agg(F.avg("p_size").alias("mean")).filter("mean > 25.5").drop("mean")
    parts = L.in_pairs(t.part.select("p_partkey", "p_brand", "p_type"), pairs, ["p_brand", "p_type"])
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return J.with_members(lines, parts.select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


@query("""
select c.c_custkey, n.n_name as nation_desc, r.r_name as region_desc
from customer c left join nation n on nullif(c.c_nationkey, 3) = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey""")
def decode_codes(t: Tables):
    nations = J.decode(t.nation, {"n_regionkey": (t.region, "region_desc")}, "r_regionkey", "r_name").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("nation_desc"), "region_desc")
    c = t.customer.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("code"))
    return c.join(nations, "code", "left").drop("code")


@query("""
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, nc.n_name as insured_nation, ns.n_name as claimant_nation
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
left join customer c on o.o_custkey = c.c_custkey left join nation nc on c.c_nationkey = nc.n_nationkey
left join supplier s on l.l_suppkey = s.s_suppkey left join nation ns on s.s_nationkey = ns.n_nationkey""")
def role_playing(t: Tables):
    """One dimension under two roles, each attached to its own side before the large join."""
    insured, claimant = J.in_role(t.nation, "insured"), J.in_role(t.nation, "claimant")
    customers = t.customer.join(insured, F.col("c_nationkey") == F.col("insured_n_nationkey"), "left").select(
        F.col("c_custkey").alias("o_custkey"), F.col("insured_n_name").alias("insured_nation"))
    suppliers = t.supplier.join(claimant, F.col("s_nationkey") == F.col("claimant_n_nationkey"), "left").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("claimant_n_name").alias("claimant_nation"))
    claims = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(customers, "o_custkey", "left")
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .join(claims.drop("o_custkey"), "l_orderkey").join(suppliers, "l_suppkey", "left")
    )


@query("""
with agg as (select l_partkey, l_suppkey, count(*) as n, sum(l_quantity) as qty from lineitem group by 1, 2)
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, a.n as pair_lines, cast(a.qty as double) as pair_qty
from lineitem l left join agg a on l.l_partkey = a.l_partkey and l.l_suppkey = a.l_suppkey""")
def composite_join(t: Tables):
    """Join on two columns with the aggregate of the same columns."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("pair_lines"), F.sum("l_quantity").alias("pair_qty"))
    return J.folded_join(lines.drop("l_quantity"), pairs, ["l_partkey", "l_suppkey"], by=["l_orderkey", "l_linenumber"])


@query("""
select o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey
from orders o left join lineitem l
  on '1' || 'B' || cast(o.o_orderkey as varchar) = '1' || 'B' || cast(l.l_orderkey as varchar)""")
def concat_key_join(t: Tables):
    claims = t.orders.select("o_orderkey", "o_custkey", F.lit("1").alias("company"), F.lit("B").alias("branch"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.lit("1").alias("company_l"), F.lit("B").alias("branch_l"))
    joined = J.concat_key_join(claims, lines, ["company", "branch", "o_orderkey"], ["company_l", "branch_l", "l_orderkey"])
    return joined.select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey")


@query("""
select o_orderkey,
       case when o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') then 1 else 0 end as has_return
from orders""")
def semi_anti(t: Tables):
    claims = t.orders.select("o_orderkey")
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return U.append_by_name(
        J.with_members(claims, returned, "o_orderkey").withColumn("has_return", F.lit(1)),
        J.without_members(claims, returned, "o_orderkey").withColumn("has_return", F.lit(0)),
    )


@query("""
with c as (select c_nationkey as k, count(*) as n_c from customer where c_nationkey < 20 group by 1),
     s as (select s_nationkey as k, count(*) as n_s from supplier where s_nationkey > 4 group by 1)
select cast(coalesce(c.k, s.k) as integer) as nation, coalesce(n_c, 0) as n_customers, coalesce(n_s, 0) as n_suppliers
from c full join s on c.k = s.k""")
def full_outer(t: Tables):
    customers = t.customer.filter("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    suppliers = t.supplier.filter("s_nationkey > 4").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    return customers.join(suppliers, "nation", "full").fillna(0)


@query("""
with by_name as (select c_mktsegment as name, max(c_custkey) as v from customer where c_mktsegment <> 'FURNITURE' group by 1),
     by_id as (select s_nationkey as id, max(s_suppkey) as v from supplier where s_nationkey % 2 = 0 group by 1)
select c.c_custkey, coalesce(a.v, b.v, -1) as value
from customer c left join by_name a on nullif(c.c_mktsegment, 'BUILDING') = a.name
left join by_id b on c.c_nationkey = b.id""")
def lookup_fallback(t: Tables):
    """Value by name, else by id, else a default; customers without a name are spread, not gathered."""
    by_name = t.customer.filter("c_mktsegment <> 'FURNITURE'").groupBy(F.col("c_mktsegment").alias("name")).agg(
        F.max("c_custkey").alias("value"))
    by_id = t.supplier.filter("s_nationkey % 2 = 0").groupBy(F.col("s_nationkey").alias("id")).agg(
        F.max("s_suppkey").alias("value"))
    c = t.customer.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("name"),
                          F.col("c_nationkey").alias("id"))
    return J.lookup_fallback(c, by_name, "name", by_id, "id", "value", default=-1).select("c_custkey", "value")


@query("""
with party as (select o.o_orderkey as claim, nullif(c.c_mktsegment, 'BUILDING') || c.c_nationkey as name
               from orders o join customer c on o.o_custkey = c.c_custkey),
     per_name as (select name, count(distinct claim) as n from party where name is not null group by 1)
select p.claim, coalesce(q.n, 0) as prior_claims from party p left join per_name q on p.name = q.name""")
def party_name_match(t: Tables):
    """Claims of the same party name. The many-to-many match is only counted, so names are counted first and each
    claim meets one row per name."""
    party = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("claim"),
        F.concat(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.col("c_nationkey").cast("string")).alias("name"))
    counts = A.prior_claims(party, "claim", "name")
    return J.folded_join(party, counts, ["name"], by=["claim"]).select("claim", F.coalesce("prior_claims", F.lit(0)).alias("prior_claims"))


@query("""
select o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey from orders o left join lineitem l on o.o_orderkey = l.l_orderkey
where o.o_totalprice >= 200000 and l.l_returnflag = 'R' and l.l_quantity <= 10""")
def degenerate_outer(t: Tables):
    """A left join narrowed by a filter on its right side; the optimizer turns it into an inner join."""
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.filter("o_totalprice >= 200000 and l_returnflag = 'R' and l_quantity <= 10").select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""
with base as (
  select l_orderkey, max(l_shipdate) as ship, min(case when l_returnflag = 'A' then '10' end) as typ_a,
         min(case when l_returnflag = 'R' then '20' end) as typ_r, min(case when l_linestatus = 'O' then '30' end) as typ_o
  from lineitem group by 1)
select '1' || cast(o.o_orderkey as varchar) as claimno, c.c_mktsegment as class_name,
       coalesce(b.typ_a, b.typ_r, b.typ_o) as claim_type_f,
       case when coalesce(b.typ_a, b.typ_r, b.typ_o) in ('20', '30') then 1 else 0 end as recovery_flag
from orders o left join customer c on o.o_custkey = c.c_custkey and c.c_mktsegment in ('BUILDING', 'MACHINERY')
left join base b on o.o_orderkey = b.l_orderkey
where o.o_orderdate between timestamp '1996-01-01' and timestamp '1998-12-31' and o.o_orderstatus = 'F'""")
def recovery_types(t: Tables):
    """Filtered derived tables, left-joined, with the first known type deciding the flag."""
    claims = t.orders.filter(
        F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-12-31").cast("timestamp_ntz"))
        & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_custkey")
    types = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.when(F.col("l_returnflag") == "A", "10")).alias("typ_a"),
        F.max(F.when(F.col("l_returnflag") == "R", "20")).alias("typ_r"),
        F.max(F.when(F.col("l_linestatus") == "O", "30")).alias("typ_o"))
    classes = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("class_name"))
    kind = F.coalesce("typ_a", "typ_r", "typ_o")
    return claims.join(types, "o_orderkey", "left").join(classes, "o_custkey", "left").select(
        J.concat_key(F.lit("1"), F.col("o_orderkey")).alias("claimno"), "class_name", kind.alias("claim_type_f"),
        indicator(kind.isin("20", "30")).alias("recovery_flag"))


@query("""
with a as (select l_orderkey k, count(*) n from lineitem group by 1),
     b as (select l_orderkey k, max(l_quantity) q from lineitem where l_returnflag = 'R' group by 1),
     c as (select l_orderkey k, min(l_shipdate) d from lineitem group by 1),
     d as (select l_orderkey k, count(distinct l_partkey) p from lineitem group by 1),
     v as (select o_custkey, count(*) versions, min(cast(o_orderdate as date)) first_day from orders group by 1)
select o.o_orderkey as claim, coalesce(a.n, 0) as lines, cast(b.q as double) as max_returned, cast(c.d as date) as first_ship,
       coalesce(d.p, 0) as parts, v.versions, v.first_day
from orders o left join a on o.o_orderkey = a.k left join b on o.o_orderkey = b.k left join c on o.o_orderkey = c.k
left join d on o.o_orderkey = d.k left join v on o.o_custkey = v.o_custkey""")
def wide_assembly(t: Tables):
    """Several per-claim results on one key, and the versions of each policy folded before they are attached."""
    lines = t.lineitem.withColumnRenamed("l_orderkey", "claim")
    general = lines.groupBy("claim").agg(
        F.count(F.lit(1)).alias("lines"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("max_returned"),
        F.to_date(F.min("l_shipdate")).alias("first_ship"))
    parts = lines.groupBy("claim").agg(F.count_distinct("l_partkey").alias("parts"))
    versions = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("versions"), F.min(F.to_date("o_orderdate")).alias("first_day"))
    base = t.orders.select(F.col("o_orderkey").alias("claim"), "o_custkey")
    hot = J.hot_keys(base, ["o_custkey"])[0]
    wide = J.folded_join(J.assemble_wide(base, "claim", [general, parts]), versions, ["o_custkey"], hot, by=["claim"])
    return wide.drop("o_custkey").fillna(0, ["lines", "parts"])


@query("""
select d.doc_id, l.quality, coalesce(l.toxic, 0) as toxic,
       round((d.doc_id * 7919 % 1000) / 1000.0, 4) as predicted_prob
from documents d left join labels l on d.doc_id = l.doc_id""")
def score_attach(t: Tables):
    """Scores stay beside their key; labels are attached by key with a default."""
    scored = t.documents.select("doc_id", F.round((F.col("doc_id") * 7919 % 1000) / F.lit(1000.0), 4).alias("predicted_prob"))
    return J.latest_status(scored, t.labels, "doc_id", {"toxic": 0})


@query("""
select 'c' as kind, c_custkey as id, c_name as name, cast(null as double) as balance from customer
union select 's', s_suppkey, s_name, s_acctbal from supplier""")
def append_distinct(t: Tables):
    customers = t.customer.select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = t.supplier.select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                  F.col("s_acctbal").alias("balance"))
    return U.append_by_name(customers, suppliers, suppliers).distinct()


@query("""
with cur as (select o_orderkey as k, o_orderstatus as s, o_totalprice as p from orders where o_orderdate >= timestamp '1996-01-01'),
     prev as (select o_orderkey as k, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as s, o_totalprice as p
              from orders where o_orderdate < timestamp '2000-01-01'),
     both_weeks as (select * from cur where k in (select k from prev) union select * from prev where k in (select k from cur)),
     n as (select k, count(*) as n from both_weeks group by 1)
select cur.k as claim, coalesce(n.n, 0) as changed_value from cur left join n on cur.k = n.k""")
def snapshot_change(t: Tables):
    """Two weekly snapshots; last week's is written and read back as a dated run."""
    o = t.orders
    cut = lambda d: F.lit(d).cast("timestamp_ntz")
    current = o.filter(F.col("o_orderdate") >= cut("1996-01-01")).select(
        F.col("o_orderkey").alias("claim"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    last = o.filter(F.col("o_orderdate") < cut("2000-01-01")).select(
        F.col("o_orderkey").alias("claim"),
        F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").alias("price"))
    root = scratch_path(t.spark, "weekly")
    sinks.write_run(last, root, "1999-12-25")
    return U.snapshot_change(current, readers.read_run(t.spark, root, "1999-12-25"), "claim")
