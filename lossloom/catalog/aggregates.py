"""Per-claim aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.functions.dates import days_open_in_month, in_month_of, vehicle_age
from lossloom.functions.maths import clamp, ratio
from lossloom.functions.text import limited_split
from lossloom.operators import aggregates as A
from lossloom.operators import sets as U


@query("""
select o_custkey, count(distinct o_orderkey) as claims, count(distinct cast(o_orderdate as date)) as report_days,
       count(distinct o_orderstatus) as statuses from orders group by 1""")
def distinct_counts(t: Tables):
    o = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"), "o_orderstatus")
    always = F.lit(True)
    return A.distinct_counts(o, ["o_custkey"], {
        "o_orderkey": {"claims": always}, "day": {"report_days": always}, "o_orderstatus": {"statuses": always}})


@query("""
with u as (select distinct o_custkey, o_orderpriority from orders)
select o_custkey, count(*) as n from u group by 1""")
def distinct_then_count(t: Tables):
    """Distinct pairs first, then rows per key: prior claims of a party."""
    return A.prior_claims(t.orders.select("o_custkey", "o_orderpriority"), "o_orderpriority", "o_custkey", "n")


@query("""
select l_orderkey,
  count(case when l_returnflag = 'A' then 1 end) as part_a, count(case when l_returnflag = 'N' then 1 end) as part_n,
  count(case when l_returnflag = 'R' then 1 end) as part_r,
  count(distinct case when l_linestatus = 'O' then l_suppkey end) as open_suppliers,
  count(distinct case when l_linestatus = 'F' then l_suppkey end) as closed_suppliers,
  count(distinct case when l_returnflag = 'R' and l_linestatus = 'F' then l_suppkey end) as returned_suppliers,
  count(distinct case when l_quantity > 25 then l_partkey end) as large_parts,
  count(distinct case when l_discount = 0.05 then l_partkey end) as discounted_parts
from lineitem group by 1""")
def wide_counts(t: Tables):
    """Conditional counts, and conditional distinct counts over two id columns in one pass."""
    lines = t.lineitem
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    plain = lines.groupBy("l_orderkey").agg(*[
        A.count_when(flag == v).alias(f"part_{v.lower()}") for v in ("A", "N", "R")])
    distinct = A.distinct_counts(lines, ["l_orderkey"], {
        "l_suppkey": {"open_suppliers": status == "O", "closed_suppliers": status == "F",
                      "returned_suppliers": (flag == "R") & (status == "F")},
        "l_partkey": {"large_parts": F.col("l_quantity") > 25, "discounted_parts": F.col("l_discount") == 0.05},
    })
    return plain.join(distinct, "l_orderkey")


@query("""
select l.l_orderkey,
  sum(case when p_type = 'STANDARD' then 1 else 0 end)::bigint as auto_bi,
  sum(case when p_type = 'ECONOMY' then 1 else 0 end)::bigint as auto_pd,
  sum(case when p_type = 'MEDIUM' then 1 else 0 end)::bigint as medpay,
  sum(case when p_type is null then 1 else 0 end)::bigint as type_nan
from lineitem l left join (select p_partkey, nullif(p_type, 'LARGE') as p_type from part) p on l.l_partkey = p.p_partkey
group by 1""")
def one_hot_sum(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.nullif(F.col("p_type"), F.lit("LARGE")).alias("kind"))
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(part, "l_partkey", "left")
    return A.dummy_sums(lines, "l_orderkey", "kind",
                        {"auto_bi": "STANDARD", "auto_pd": "ECONOMY", "medpay": "MEDIUM"}, null_name="type_nan")


@query("""
select l_orderkey,
  case when sum(case when l_returnflag = 'R' then 1 else 0 end) = 0 then 0 else 1 end as any_returned,
  max(case when l_returnflag in ('A', 'N') then 1 else 0 end) as any_in_set,
  case when sum(case when l_quantity > 45 or l_tax = 0.08 then 1 else 0 end) > 0 then 1 else 0 end as any_large
from lineitem group by 1""")
def any_flag(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(
        A.any_when(F.col("l_returnflag") == "R").alias("any_returned"),
        A.any_in(F.col("l_returnflag"), ["A", "N"]).alias("any_in_set"),
        A.any_when((F.col("l_quantity") > 45) | (F.col("l_tax") == 0.08)).alias("any_large"))


@query("""
with x as (select *, cast(l_extendedprice as decimal(18,2)) as amount from lineitem)
select l_orderkey, cast(sum(case when l_linestatus = 'O' then amount else 0 end) as double) as reserve,
  cast(sum(case when l_linestatus = 'F' then amount else 0 end) as double) as payment,
  cast(sum(amount) as double) as total, cast(max(l_discount) as double) as max_discount, cast(min(l_tax) as double) as min_tax
from x group by 1""")
def cond_sum(t: Tables):
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    return t.lineitem.groupBy("l_orderkey").agg(
        A.sum_when(F.col("l_linestatus") == "O", amount).cast("double").alias("reserve"),
        A.sum_when(F.col("l_linestatus") == "F", amount).cast("double").alias("payment"),
        F.sum(amount).cast("double").alias("total"),
        F.max("l_discount").alias("max_discount"), F.min("l_tax").alias("min_tax"))


@query("""
with f as (select l_orderkey as claim, case when l_returnflag = 'R' then 1 when l_returnflag = 'A' then 0 end as flag from lineitem),
known as (select claim, case when count(distinct case when flag = 1 then claim end) > 0 then 1 else 0 end as state
          from f where flag is not null group by 1)
select claim, state from known
union select distinct claim, null from f where flag is null and claim not in (select claim from known)""")
def tri_state(t: Tables):
    """Known-and-set, known-and-unset, unknown: one aggregate instead of two branches and an exclusion list."""
    flag = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    return t.lineitem.groupBy(F.col("l_orderkey").alias("claim")).agg(A.tri_state(flag).alias("state"))


@query("""
with f as (select l_orderkey, nullif(l_returnflag, 'N') as flag from lineitem)
select l_orderkey, count(distinct flag) + max(case when flag is null then 1 else 0 end) as n from f group by 1""")
def distinct_with_null(t: Tables):
    f = t.lineitem.select("l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"))
    return f.groupBy("l_orderkey").agg(A.count_distinct_with_null(F.col("flag")).alias("n"))


@query("""
select user_id, count(*) filter (where event_type = 'view') as n_view, count(*) filter (where event_type = 'click') as n_click,
  count(*) filter (where event_type = 'purchase') as n_purchase, count(*) filter (where event_type = 'refund') as n_refund
from events group by 1""")
def pivot_counts(t: Tables):
    """Counts by listed value; a value that never occurs still has its column."""
    return A.pivot_counts(t.events.select("user_id", "event_type"), "user_id", "event_type",
                          ["view", "click", "purchase", "refund"], "n_")


@query("""
select conv_id, string_agg(text, ' , ' order by turn, role, text) as document from conversations group by 1""")
def note_concat(t: Tables):
    return A.note_documents(t.conversations, "conv_id", ["turn", "role"], "text")


@query("""
with reports as (select user_id, event_type || ',' || regexp_extract(props, '"k": ([0-9])', 1) || ',' ||
                   (event_id % 9) || ',' || (event_id % 7) || ',' || (event_id % 11) || ',' || (event_id % 13) || ',' || (event_id % 17)
                   as reasons from events),
parts as (select user_id, unnest(string_split(reasons, ',')) as code from reports)
select user_id, string_agg(distinct code, ',' order by code) as codes from parts group by 1""")
def code_concat(t: Tables):
    """Split reason lists of seven parts and more, distinct codes per key, sorted list."""
    k = F.regexp_extract("props", '"k": ([0-9])', 1)
    reasons = F.concat_ws(",", "event_type", k, *((F.col("event_id") % n).cast("string") for n in (9, 7, 11, 13, 17)))
    codes = U.distinct_codes(t.events, ["user_id"], limited_split(reasons))
    return A.code_list(codes, "user_id", "code")


@query("""
with reports as (select event_id, user_id, event_type || ',' || (event_id % 5) || ',' || (event_id % 3) as reasons from events),
parts as (select distinct event_id, user_id, unnest(string_split(reasons, ',')) as code from reports)
select user_id, sum(case when code = 'click' then 1 else 0 end)::bigint as iso_click,
  sum(case when code = '0' then 1 else 0 end)::bigint as iso_zero, sum(case when code = '1' then 1 else 0 end)::bigint as iso_one
from parts group by 1""")
def report_code_counts(t: Tables):
    """Reports per key that carry a code, each code once per report. Duplicates are removed inside the row, so no
    report id has to be made."""
    reasons = F.concat_ws(",", "event_type", (F.col("event_id") % 5).cast("string"), (F.col("event_id") % 3).cast("string"))
    codes = t.events.select("user_id", F.explode(F.array_distinct(limited_split(reasons))).alias("code"))
    return codes.groupBy("user_id").agg(*A.one_hot_sum(F.col("code"), {"iso_click": "click", "iso_zero": "0", "iso_one": "1"}))


@query("""
with c as (select label, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding) as x from embeddings)
select label, cast(pos as integer) as pos, round(avg(cast(x as double)), 4) as mean from c group by 1, 2""")
def mean_vector(t: Tables):
    means = A.mean_vectors(t.embeddings, "label", "embedding")
    return means.select("label", F.posexplode("mean").alias("pos", "m")).select("label", "pos", F.round("m", 4).alias("mean"))


@query("""
select event_type, count(*) as n, cast(sum(count(*)) over () as bigint) as total from events group by 1""")
def value_counts(t: Tables):
    """Counts per value beside the whole-frame count, which is one number."""
    return A.value_counts(t.events, "event_type").withColumn("total", F.lit(t.events.count()).cast("bigint"))


@query("""select distinct l_returnflag, l_linestatus, l_discount, l_tax from lineitem""")
def distinct_projection(t: Tables):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_discount", "l_tax").distinct()


@query("""
with n as (select user_id, count(*) as cnt from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01' group by 1),
     r as (select user_id, cast(min(ts) as date) as reported from events group by 1),
     d as (select user_id, case when year(reported) * 100 + month(reported) <> 202401 then 20
                                else date_diff('day', reported, date '2024-01-20') end as days_open from r)
select n.user_id, n.cnt, cast(d.days_open as integer) as days_open,
       round(case when d.days_open = 0 then null else n.cnt * 1.0 / d.days_open end, 4) as notes_per_day
from n left join d on n.user_id = d.user_id""")
def notes_per_day(t: Tables):
    as_of = F.lit("2024-01-20").cast("date")
    events = t.events.select("user_id", "ts")
    notes = events.filter(in_month_of(F.col("ts"), as_of)).groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    opened = events.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("reported"))
    days = days_open_in_month(F.col("reported"), as_of).alias("days_open")
    return notes.join(opened.select("user_id", days), "user_id", "left").withColumn(
        "notes_per_day", F.round(ratio(F.col("cnt"), F.col("days_open")), 4))


@query("""
with x as (select c_custkey, case when c_custkey % 5 = 0 then null else c_acctbal end as b from customer)
select c_custkey, round(coalesce(b, (select avg(b) from x)), 4) as balance from x""")
def mean_impute(t: Tables):
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("b"))
    return A.fill_with_mean(c, ["b"]).select("c_custkey", F.round("b", 4).alias("balance"))


@query("""
with x as (select l_orderkey as claim, l_returnflag, year(l_shipdate) - (1990 + l_linenumber * 3) as age from lineitem),
g as (select o.o_orderkey as claim, max(case when l_returnflag = 'R' then age else 0 end) as fp,
             max(case when l_returnflag = 'A' then age else 0 end) as tp
      from orders o left join x on o.o_orderkey = x.claim group by 1)
select claim, cast(case when fp < 1 then 1 when fp > 8 then 8 else fp end as integer) as fp_age,
       cast(case when coalesce(tp, 4) < 1 then 1 when coalesce(tp, 4) > 8 then 8 else coalesce(tp, 4) end as integer) as tp_age
from g""")
def age_clamp(t: Tables):
    """Oldest vehicle per side, default and clamp applied after the aggregate."""
    age = vehicle_age(F.col("l_shipdate"), 1990 + F.col("l_linenumber") * 3)
    per_claim = t.lineitem.groupBy(F.col("l_orderkey").alias("claim")).agg(
        F.max(F.when(F.col("l_returnflag") == "R", age).otherwise(0)).alias("fp"),
        F.max(F.when(F.col("l_returnflag") == "A", age).otherwise(0)).alias("tp"))
    joined = t.orders.select(F.col("o_orderkey").alias("claim")).join(per_claim, "claim", "left")
    return joined.fillna(0, ["fp", "tp"]).select(
        "claim", clamp(F.col("fp"), 1, 8).alias("fp_age"), clamp(F.col("tp"), 1, 8, default=4).alias("tp_age"))
