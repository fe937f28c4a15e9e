"""Windows, cut-offs, order statistics and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.functions.maths import largest_components
from lossloom.operators import ordering as O


@query("""
with w as (select o_custkey, o_orderkey, cast(o_orderdate as date) as d,
  row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn,
  lag(cast(o_orderdate as date)) over (partition by o_custkey order by o_orderdate, o_orderkey) as prev from orders)
select o_custkey, o_orderkey, rn, cast(coalesce(date_diff('day', prev, d), 0) as integer) as gap_days from w""")
def prev_claim_gap(t: Tables):
    """Rank and gap to the previous claim per customer."""
    return O.event_sequence(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey").select(
        "o_custkey", "o_orderkey", "rn", "gap_days")


@query("""
with w as (select o_custkey, cast(o_orderdate as date) as d,
  lag(cast(o_orderdate as date)) over (partition by o_custkey order by o_orderdate, o_orderkey) as prev from orders)
select o_custkey, cast(max(coalesce(date_diff('day', prev, d), 0)) as integer) as gap_days from w group by 1""")
def longest_claim_gap(t: Tables):
    return O.longest_gap(t.orders, "o_custkey", "o_orderdate")


@query("""select event_id, row_number() over (order by ts, event_id) as report_row from events""")
def row_id(t: Tables):
    """Report ids in time order without a one-task window."""
    return O.row_index(t.events.select("event_id", "ts"), [F.col("ts"), F.col("event_id")], "report_row").select("event_id", "report_row")


@query("""
select o_custkey, o_orderkey, cast(o_totalprice as double) as price from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders) where rn = 1""")
def top_by_key(t: Tables):
    """Best order per customer as an aggregate."""
    return O.first_by_key(t.orders, ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"]).select(
        "o_custkey", "o_orderkey", F.col("o_totalprice").alias("price"))


@query("""select o_custkey, cast(min(o_orderdate) as date) as first_day from orders group by 1""")
def earliest_by_key(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("first_day"))


@query("""
with s as (select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as seq from orders)
select o_orderkey, seq, case seq % 3 when 1 then 'first' when 2 then 'second' else 'third' end as member from s""")
def round_robin(t: Tables):
    o = t.orders.select("o_orderkey", "o_totalprice")
    return O.round_robin(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], ["first", "second", "third"]).select(
        "o_orderkey", "seq", "member")


@query("""
with r as (select o_orderkey, o_totalprice, rank() over (order by o_totalprice desc) as rk, count(*) over () as n from orders)
select o_orderkey, case when rk <= cast(floor(n * 0.05) as bigint) + 1 then 1 else 0 end as referred from r""")
def top_fraction(t: Tables):
    return O.top_fraction(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 0.05).select("o_orderkey", "referred")


@query("""
with r as (select user_id, cast(round(sum(cast(value as decimal(18,2))), 0) as double) as score from events group by 1),
k as (select *, rank() over (order by score desc) as rk, count(*) over () as n from r)
select user_id, score, case when rk <= cast(floor(n * 0.1) as bigint) + 1 then 1 else 0 end as referred from k""")
def top_fraction_ties(t: Tables):
    """Rounded scores, so that rows tie at the cut."""
    scores = t.events.groupBy("user_id").agg(F.round(F.sum(F.col("value").cast("decimal(18,2)")), 0).cast("double").alias("score"))
    return O.top_fraction(scores, "score", 0.1)


@query("""
with p as (select l_extendedprice as price, l_quantity as qty, row_number() over (order by l_extendedprice) - 1 as i,
                  count(*) over () as n, l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem),
cut as (select min(price) filter (where i = floor(0.01 * n)) as low, min(price) filter (where i = n - 1 - floor(0.01 * n)) as high from p),
q as (select l_quantity as v, row_number() over (order by l_quantity) - 1 as i, count(*) over () as n from lineitem),
cut_q as (select min(v) filter (where i = n - 1 - floor(0.05 * n)) as high from q)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, least(greatest(price, cut.low), cut.high) as price, least(qty, cut_q.high) as qty
from p, cut, cut_q""")
def winsorize(t: Tables):
    """Two columns clamped in the same passes."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                              F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"))
    return O.winsorize(lines, {"price": (0.01, 0.01), "qty": (0.0, 0.05)})


@query("""select p_partkey, p_name, p_retailprice from part order by p_retailprice desc, p_partkey limit 20""")
def topk(t: Tables):
    return O.top_rows(t.part.select("p_partkey", "p_name", "p_retailprice"), [F.col("p_retailprice").desc(), F.col("p_partkey")], 20)


@query("""
with c as (select vec_id, generate_subscripts(embedding, 1) - 1 as pos, cast(unnest(embedding) as double) as value from embeddings),
r as (select *, row_number() over (partition by vec_id order by value desc, pos) as rk from c)
select vec_id, cast(pos as integer) as pos, value, cast(rk as integer) as rk from r where rk <= 5""")
def topk_in_vector(t: Tables):
    """Five largest components, found inside the row."""
    e = t.embeddings.select("vec_id", F.posexplode(largest_components(F.col("embedding"), 5)).alias("i", "c"))
    return e.select("vec_id", "c.pos", "c.value", (F.col("i") + 1).alias("rk"))


@query("""
select o_orderkey, row_number() over (order by (case when o_orderpriority = '1-URGENT' then 1 else 0 end) desc,
  case when o_orderpriority = '1-URGENT' then o_totalprice else 0 end desc, o_orderkey) as seq from orders""")
def referred_first(t: Tables):
    """Referred rows by reserve, then the others, as positions."""
    referred = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    reserve = F.when(referred == 1, F.col("o_totalprice")).otherwise(0.0)
    o = t.orders.select("o_orderkey", referred.alias("referred"), reserve.alias("reserve"))
    return O.row_index(o, [F.col("referred").desc(), F.col("reserve").desc(), F.col("o_orderkey")]).select("o_orderkey", "seq")


@query("""
select o_orderkey, cast(sum(cast(o_totalprice as decimal(18,2))) over (order by o_totalprice, o_orderkey
  rows between unbounded preceding and current row) as double) as running from orders""")
def running_total(t: Tables):
    """Running sum over the whole table, the primitive behind indexes and ROC curves."""
    o = t.orders.select("o_orderkey", "o_totalprice")
    return O.running_totals(o, [F.col("o_totalprice"), F.col("o_orderkey")], {"running": F.col("o_totalprice").cast("decimal(18,2)")}).select(
        "o_orderkey", F.col("running").cast("double"))
