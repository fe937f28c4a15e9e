"""Registered queries of the operators, with SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.llm import conversations, infill, language, minhash, mixing, packing, paragraphs, quality, scoring, simhash, token_counts, topk, wrappers
from lossloom.llm.common import table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op2_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return quality.score_quality(table(spark, sf_dir, "documents"), trusted)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_texts(table(spark, sf_dir, "documents"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraphs.drop_repeated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "has_repeated", "n_paragraphs", "n_repeated", "n_removed", "n_passages", "words_removed", "kept_in", "text")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.fill_in_middle(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_main_text, op2_top_inner_products, op3_quality_rules, op4_mix_sources, op5_token_counts, op6_simhash,
                            op7_lm_scores, op8_pack, op9_repeated_paragraphs, op10_language, op11_fill_in_middle, op12_fingerprints, op13_prefix_trie, pipeline)}

ORACLES = {
    "op2_top_inner_products": """
with v as (
  select vec_id, [floor(1024 * x::double) for x in embedding] as e from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 10""",
    "op11_fill_in_middle": """
with d as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, ''))::bigint as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
g as (
  select *, ('0x' || substr(h, 1, 8))::ubigint::bigint % (n + 1) as x, ('0x' || substr(h, 9, 8))::ubigint::bigint % (n + 1) as y,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or ('0x' || substr(h, 17, 8))::ubigint % 100 >= 90 then 'plain'
      when ('0x' || substr(h, 25, 8))::ubigint % 100 < 20 then 'spm' else 'psm' end as form from d),
c as (
  select *, t[1:least(x, y)] as p, t[least(x, y) + 1:greatest(x, y)] as m, t[greatest(x, y) + 1:] as s from g)
select doc_id, n, form, case when form <> 'plain' then least(x, y) end as prefix_chars,
  case when form <> 'plain' then greatest(x, y) - least(x, y) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from c""",
    "op13_prefix_trie": """
with t as (
  select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x, row_number() over (
    partition by conv_id order by turn nulls first, substr(sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) as k
  from conversations where conv_id is not null),
ids as (
  select distinct c, xor(list_reduce(list_prepend(4294967295::bigint, [ord(ch)::bigint for ch in string_split(c::varchar, '')]), lambda a, b:
    list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: xor(v >> 1, case when v % 2 = 1 then 3988292384::bigint else 0::bigint end))),
    4294967295::bigint) % 6 as h from t),
rebuilt as (
  select i.c, t.k, t.r, t.x from ids i join t on t.c = i.c - i.c % 100 and t.k <= i.h
  union all select i.c, t.k + 1000000000, t.r, t.x from ids i join t on t.c = i.c and t.k > i.h),
step as (
  select c, row_number() over (partition by c order by k) as d, length(x)::bigint as n,
    list(sha256(length(r)::varchar || ':' || r || x)) over (partition by c order by k rows unbounded preceding) as path from rebuilt),
steps as (
  select c, d, n, path from step union all select c, 0, 0, [] from ids),
tops as (select c, max(d) as top from steps group by c),
p as (
  select s.c, s.d, s.n, s.path, t.top, min(s.c) over (partition by s.d, s.path) as node from steps s join tops t using (c)),
nodes as (
  select d, node, count(*) as n_convs, max(top) as deepest, any_value(n) as n,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where top = d), '')) as ends from p group by d, node),
up as (select d, c, node from p),
kids as (
  select q.d - 1 as d, p.node, count(*) as n_children from nodes q join up p on p.c = q.node and p.d = q.d - 1 group by q.d - 1, p.node),
below as (
  select p.d, p.node, count(*) filter (where q.deepest = q.d) as n_leaves, sum((q.n_convs - 1) * q.n)::bigint as saved_tokens
  from nodes q join up p on p.c = q.node and p.d <= q.d group by p.d, p.node)
select n.node as conv_id, n.d::bigint as depth, u.node as parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::bigint as n_children, b.n_leaves, b.saved_tokens, n.ends as ends_sha256
from nodes n join below b using (d, node) left join kids k using (d, node) left join up u on u.c = n.node and u.d = n.d - 1""",
}
