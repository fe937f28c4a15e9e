"""Encoding, splits, weights, evaluation and models. Target = labels, inputs = documents or orders."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.catalog.texts import documents_with_tokens
from lossloom.functions import text as X
from lossloom.functions.maths import threshold_class
from lossloom.operators import evaluate as E
from lossloom.operators import model as G
from lossloom.operators import neighbours as N
from lossloom.operators import terms as V
from lossloom.operators import topics as P
from lossloom.session import materialise, scratch_path
from lossloom.sources import readers, sinks

_SCORE_SQL = "(doc_id * 7919 % 1000 + 300 * quality) / 1300.0"


def _scored(t: Tables):
    return t.labels.select("doc_id", "quality", "toxic", (
        (F.col("doc_id") * 7919 % 1000 + 300 * F.col("quality")) / F.lit(1300.0)).alias("score"))


def _model_frame(t: Tables):
    """Labelled documents with a few numeric and coded inputs."""
    text = F.col("text")
    docs = t.documents.select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(X.words(text)).cast("double").alias("n_words"),
        X.phrase_count(text, "\n").cast("double").alias("n_lines"), X.contains_any(text, ["http"]).alias("has_link"))
    frame = docs.join(t.labels, "doc_id").withColumn("label", F.col("quality").cast("double"))
    return materialise(frame)


@query("""
select o_orderkey,
  case when o_orderstatus = 'F' then 1 else 0 end as status_f, case when o_orderstatus = 'O' then 1 else 0 end as status_o,
  case when o_orderstatus = 'P' then 1 else 0 end as status_p,
  case when c_nationkey is null then 1 else 0 end as nation_missing,
  round(coalesce(balance, (select avg(balance) from (select case when c_custkey % 7 <> 0 then c_acctbal end as balance
     from orders join customer on o_custkey = c_custkey))), 4) as balance
from (select o_orderkey, o_orderstatus, nullif(c_nationkey, 3) as c_nationkey, case when c_custkey % 7 <> 0 then c_acctbal end as balance
      from orders join customer on o_custkey = c_custkey)""")
def encode_features(t: Tables):
    """One-hot text, mean-imputed number, one vector; read back by component."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderstatus", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"))
    rows = G.categorical(rows, ["nation"])
    encoded = G.encoder(rows, ["o_orderstatus", "nation"], ["balance"]).fit(rows).transform(rows)
    names = G.feature_names(encoded)
    at = lambda suffix: F.col("v")[names.index(suffix)]
    return encoded.select("o_orderkey", vector_to_array("features").alias("v")).select(
        "o_orderkey", *[at(f"o_orderstatus__v_{s}").cast("int").alias(f"status_{s.lower()}") for s in "FOP"],
        at("nation__v_nan").cast("int").alias("nation_missing"), F.round(at("balance__n"), 4).alias("balance"))


@query("""
with h as (select doc_id, quality, doc_id * 48271 % 2147483647 as h from labels),
r as (select *, row_number() over (partition by quality order by h) as rn, count(*) over (partition by quality) as n from h)
select doc_id, case when h % 10000 < 7000 then 'train' else 'test' end as side,
  case when rn <= round_even(n * 0.1, 0) then 1 else 0 end as sampled, coalesce(case when quality = 2 then 1 else quality end, 0) as target
from r""")
def split_sample(t: Tables):
    """70/30 split and an exact 10 % sample per class, both from a hash of the key."""
    order = F.col("doc_id") * 48271 % 2147483647
    labels = G.binary_target(t.labels.select("doc_id", "quality").withColumn("target", F.col("quality")), "target")
    train, test = G.split(labels, "doc_id", 0.7, bucket=order % 10_000)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    sampled = G.stratified_sample(labels, "quality", 0.1, order).select("doc_id", F.lit(1).alias("sampled"))
    return both.join(sampled, "doc_id", "left").fillna(0, ["sampled"]).select("doc_id", "side", "sampled", "target")


@query("""
with n as (select quality, count(*) as n, sum(count(*)) over () as total, count(*) over () as k from labels group by 1)
select l.doc_id, case when l.quality = 1 then 39.0::double else 1.0::double end as fixed_weight,
  round(n.total::double / (n.k * n.n), 4) as balanced_weight from labels l join n on l.quality = n.quality""")
def class_weights(t: Tables):
    weighted = G.balanced_weights(t.labels.select("doc_id", "quality"), "quality", "w")
    return weighted.select("doc_id", G.fixed_weight(F.col("quality")).alias("fixed_weight"), F.round("w", 4).alias("balanced_weight"))


@query(f"""
with s as (select quality as a, case when {_SCORE_SQL} > 0.5 then 1 else 0 end as p from labels),
c as (select count(*) filter (where a = 1 and p = 1) as tp, count(*) filter (where a = 0 and p = 0) as tn,
             count(*) filter (where a = 0 and p = 1) as fp, count(*) filter (where a = 1 and p = 0) as fn from s)
select tp, tn, fp, fn, round(tn / (tn + fp), 4) as accuracy_0, round(tp / (tp + fn), 4) as accuracy_1,
  round((tp + tn) / (tp + tn + fp + fn), 4) as accuracy,
  round(greatest((tp + fn) / (tp + tn + fp + fn), (tn + fp) / (tp + tn + fp + fn)), 4) as null_accuracy,
  round((fp + fn) / (tp + tn + fp + fn), 4) as misclassification, round(tp / (tp + fn), 4) as sensitivity,
  round(tn / (tn + fp), 4) as specificity, round(1 - tn / (tn + fp), 4) as false_positive_rate,
  round(fn / (fn + tp), 4) as false_negative_rate, round(2 * tp / (2 * tp + fp + fn), 4) as f1,
  round(tp / (tp + fp), 4) as "precision", round(tn / (tn + fn), 4) as precision_0,
  round((tp / (tp + fn) + tn / (tn + fp)) / 2, 4) as auc from c""")
def binary_metrics(t: Tables):
    s = _scored(t).withColumn("p", threshold_class(F.col("score")))
    m = E.binary_metrics(s, "quality", "p")
    return m.select(*[F.round(c, 4).alias(c) if d == "double" else F.col(c) for c, d in m.dtypes])


@query(f"""
with s as (select {_SCORE_SQL} as score, quality from labels),
g as (select score, count(*) filter (where quality = 1) as pos, count(*) filter (where quality = 0) as neg from s group by 1),
c as (select score, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp,
             sum(pos) over () as p, sum(neg) over () as n from g)
select round(score, 6) as threshold, round(fp / n, 4) as fpr, round(tp / p, 4) as tpr from c""")
def roc_points(t: Tables):
    """ROC points at every distinct, unrounded score."""
    return E.roc_points(_scored(t), "score", "quality").select(
        F.round("threshold", 6).alias("threshold"), F.round("fpr", 4).alias("fpr"), F.round("tpr", 4).alias("tpr"))


@query(f"""
with s as (select round({_SCORE_SQL}, 2) as score, quality from labels),
g as (select score, count(*) filter (where quality = 1) as pos, count(*) filter (where quality = 0) as neg from s group by 1),
c as (select *, sum(pos) over (order by score desc) - pos as above from g)
select round(sum(neg * (above + pos / 2)) / (sum(pos) * sum(neg)), 4) as auc from c""")
def roc_auc(t: Tables):
    return E.auc(_scored(t), "score", "quality", places=2).select(F.round("auc", 4).alias("auc"))


def _fitted(t: Tables, estimator):
    frame = G.balanced_weights(_model_frame(t), "label")
    train, _ = G.split(frame, "doc_id", 0.7)
    encoding = G.encoder(train, ["source"], ["n_chars", "n_words", "n_lines", "has_link"]).fit(train)
    return frame, encoding, estimator.fit(encoding.transform(train))


@query()
def gbt_score(t: Tables):
    """Weighted boosted trees trained on the split, all rows scored beside their key."""
    frame, encoding, model = _fitted(t, G.boosted_trees(trees=10, leaf=5))
    return G.score(encoding.transform(frame), model, ["doc_id", "quality"], places=4)


@query()
def rf_score(t: Tables):
    """Text choice, 1-3-gram weights and a balanced forest."""
    docs = V.in_pieces(t.documents.join(t.labels, "doc_id"), "doc_id").select(
        "doc_id", "piece", F.col("quality").cast("double").alias("label"), X.tokens(F.col("text")).alias("toks"))
    grams = docs.select("doc_id", "piece", "label", X.ngram_range(F.col("toks"), 1, 3).alias("terms"))
    vectors, _ = V.tfidf_model(grams, "terms", 500, min_df=2, output="features", by="piece")
    frame = G.balanced_weights(materialise(V.tfidf_vectors(grams, vectors).drop("terms", "toks", "piece")), "label")
    return G.score(frame, G.forest(trees=10, depth=8).fit(frame), ["doc_id", "label"], places=4)


@query()
def grid_search(t: Tables):
    """Two-point grid with cross-validation; one row per point."""
    frame = _model_frame(t)
    encoded = G.encoder(frame, [], ["n_chars", "n_words", "n_lines"]).fit(frame).transform(frame)
    found = G.grid_search(encoded, G.boosted_trees(weight=None, trees=3, leaf=3), {"maxDepth": [2, 4]}, folds=2)
    rows = [(int(p[found.getEstimator().getParam("maxDepth")]), float(m)) for p, m in zip(found.getEstimatorParamMaps(), found.avgMetrics)]
    return t.spark.createDataFrame(rows, "max_depth int, mean_auc double")


@query()
def importance(t: Tables):
    frame, encoding, model = _fitted(t, G.boosted_trees(trees=5, leaf=5))
    return G.importance(encoding.transform(frame), model)


@query()
def partial_dependence(t: Tables):
    frame, encoding, model = _fitted(t, G.boosted_trees(trees=5, leaf=5))
    return G.partial_dependence(frame, PipelineModel(stages=[*encoding.stages, model]), "n_chars", 10)


@query()
def lda_topics(t: Tables):
    """Topic shares from a fitted vocabulary and model, both saved and loaded before use."""
    # Read several times: texts are cut once, vectors made once.
    docs = materialise(documents_with_tokens(t))
    counts, _ = V.tfidf_model(docs, "toks", 500)
    path = scratch_path(t.spark, "vocabulary")
    sinks.save_model(counts, path)
    vectors = materialise(readers.load_model(path).transform(docs).select("doc_id", F.col("__counts").alias("features")))
    model = P.fit_lda(vectors, "features", topics=5, passes=4, chunk=1_000)
    return P.topic_distribution(vectors, model).drop("features")


@query()
def lda_terms(t: Tables):
    docs = materialise(documents_with_tokens(t))
    counts, table = V.tfidf_model(docs, "toks", 500)
    vectors = counts.transform(docs).select("doc_id", F.col("__counts").alias("features"))
    model = P.fit_lda(vectors, "features", topics=5, passes=2, chunk=1_000)
    return P.topic_terms(model, [r["term"] for r in table.orderBy("pos").select("term").collect()], 10)


@query()
def nmf_topics(t: Tables):
    """Topic shares per source from non-negative factors of the TF-IDF vectors."""
    # Read several times: texts are cut once, vectors made once.
    docs = materialise(t.documents.select("doc_id", "source", X.topic_words(F.col("text")).alias("toks")))
    grams = docs.select("doc_id", "source", X.ngram_range(F.col("toks"), 2, 3).alias("terms"))
    model, _ = V.tfidf_model(grams, "terms", 500)
    vectors = materialise(V.tfidf_vectors(grams, model).select("doc_id", "source", "tfidf"))
    factors = P.fit_factors(vectors, "tfidf", 500, topics=10)
    loadings = P.factor_loadings(vectors, "tfidf", factors)
    return P.topic_shares(loadings, "doc_id", "loadings", 10, "Topic_AN_")


@query("""
with e as (select vec_id, embedding::double[] as v, label from embeddings),
d as (select a.vec_id as a, b.vec_id as b, a.label as la, b.label as lb,
             row_number() over (partition by a.vec_id order by list_distance(a.v, b.v), b.vec_id) as rk
      from e a join e b on a.vec_id <> b.vec_id),
nn as (select * from d where rk = 1)
select least(x.a, x.b) as first, greatest(x.a, x.b) as second
from nn x join nn y on x.a = y.b and x.b = y.a where x.a < x.b and x.la <> x.lb""")
def tomek(t: Tables):
    """Mutual nearest neighbours of different classes."""
    return N.tomek_links(t.embeddings, "vec_id", "embedding", "label")


@query("""
with e as (select vec_id, embedding::double[] as v from embeddings),
d as (select a.vec_id as vec_id, b.vec_id as neighbour, list_distance(a.v, b.v) as distance,
             row_number() over (partition by a.vec_id order by list_distance(a.v, b.v), b.vec_id) as rk
      from e a join e b on a.vec_id <> b.vec_id)
select vec_id, neighbour, round(distance, 4) as distance, cast(rk as integer) as rank from d where rk <= 5""")
def nearest_neighbours(t: Tables):
    """Five nearest neighbours of every vector."""
    return N.nearest_neighbours(t.embeddings, "vec_id", "embedding", 5).withColumn("distance", F.round("distance", 4))


@query()
def smote(t: Tables):
    """Minority points added until the classes are equal, then Tomek links removed."""
    e = t.embeddings.withColumn("target", (F.col("label") == 0).cast("int"))
    return N.balance(e, "vec_id", "embedding", "target", 1).select(
        "vec_id", "target", "synthetic", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("component_sum"))
