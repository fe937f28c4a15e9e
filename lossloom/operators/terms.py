"""Terms of documents: counts, TF-IDF in two forms, class scores and key phrases.

Vocabularies limited to a given size are applied inside the row by the ML count vectorizer, so weighting needs no
shuffle at all. Without a limit everything stays a (document, term) frame.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossloom.functions.text import MAX_LENGTH
from lossloom.operators.joins import folded_join, hot_keys
from lossloom.session import file_parts, materialise

VOCABULARY_LIMIT = 100_000
# Up to so many kept terms are looked for inside the row.
ROW_TERMS = 2_000
# File bytes of documents whose terms one task counts, and groups of documents a task: about 1.5 million bigrams and trigrams.
TERM_BYTES, TERM_PIECES = 4 << 20, 8


def entries(terms: str) -> Column:
    """One row per entry of a term array. Exploding the bare column would make the optimizer test its size in a
    filter below the projection that computes it, and so compute every term array twice."""
    return F.explode(F.slice(F.col(terms), 1, MAX_LENGTH))


def _term_parts(docs: DataFrame) -> int:
    return max(file_parts(docs, TERM_BYTES), docs.sparkSession.sparkContext.defaultParallelism)


def in_pieces(docs: DataFrame, key: str, piece: str = "piece") -> DataFrame:
    """Documents dealt by `key` to tasks whose number grows with the files read; `piece` numbers groups of them that lie in one task."""
    parts = _term_parts(docs)
    return docs.withColumn(piece, F.pmod(F.xxhash64(key), F.lit(parts * TERM_PIECES))).repartition(parts, piece)


def vocabulary(docs: DataFrame, terms: str, max_features: int | None = None, min_df: int = 1, by: str | None = None) -> DataFrame:
    """(term, df, tf): documents that hold the term and its occurrences, one pass, combined before the shuffle.

    With `max_features` the most frequent terms stay; equal counts are kept in term order. With `by`, the piece column of documents
    that in_pieces() dealt, terms are counted in each piece first and then dealt to tasks whose number grows with the files read, so that no task has to spill.
    """
    if max_features is not None and min_df <= 1:
        return _frequent_terms(docs, terms, max_features)
    once = F.transform(F.array_distinct(terms), lambda t: F.struct(t.alias("term"), F.lit(1).alias("df"), F.lit(0).alias("tf")))
    each = F.transform(F.col(terms), lambda t: F.struct(t.alias("term"), F.lit(0).alias("df"), F.lit(1).alias("tf")))
    sums = (F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    if by is None:
        counted = docs.select(F.explode(F.concat(once, each)).alias("e")).select("e.*").groupBy("term").agg(*sums)
    else:
        # Counted in a piece of documents without an exchange, so that a frequent term is one row a piece.
        found = docs.select(by, F.explode(F.concat(once, each)).alias("e")).groupBy(by, "e.term").agg(F.sum("e.df").alias("df"), F.sum("e.tf").alias("tf"))
        counted = found.select("term", "df", "tf").repartition(_term_parts(docs), "term").groupBy("term").agg(*sums)
    if min_df > 1:
        counted = counted.filter(F.col("df") >= min_df)
    return counted if max_features is None else counted.orderBy(F.col("tf").desc(), "term").limit(max_features)


def _frequent_terms(docs: DataFrame, terms: str, max_features: int) -> DataFrame:
    """Occurrences decide which terms stay, so documents are counted for those terms only."""
    counts = docs.select(entries(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    kept = counts.orderBy(F.col("tf").desc(), "term").limit(max_features)
    if max_features <= ROW_TERMS:
        # The kept terms are a short list: only entries that are in it leave the row.
        rows = kept.collect()
        listed = F.array(*[F.lit(r["term"]) for r in rows]).cast("array<string>")
        frequency = docs.select(F.explode(F.array_intersect(terms, listed)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        table = docs.sparkSession.createDataFrame([(r["term"], r["tf"]) for r in rows], "term string, tf bigint")
        return frequency.join(F.broadcast(table), "term").select("term", "df", "tf").orderBy(F.col("tf").desc(), "term")
    kept = F.broadcast(kept)
    found = docs.select(F.explode(F.array_distinct(terms)).alias("term")).join(kept, "term")
    return (
        found.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.first("tf").alias("tf"))
        .select("term", "df", "tf").orderBy(F.col("tf").desc(), "term").limit(max_features)
    )


def smooth_idf_off(n: Column, df: Column) -> Column:
    """ln(N / df) + 1."""
    return F.log(n / df) + 1


def log2_idf(n: Column, df: Column) -> Column:
    """log2(N / df)."""
    return F.log2(n / df)


def tfidf_model(docs: DataFrame, terms: str, max_features: int = 500, min_df: int = 1,
                output: str = "tfidf", by: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """A saved-model-ready pipeline (counts, idf scaling, unit length) and its (position, term, df, tf, idf) table.

    Only the vocabulary, at most `max_features` terms, comes to the driver.
    """
    if max_features > VOCABULARY_LIMIT:
        raise ValueError("use tfidf_table for larger vocabularies")
    n = docs.count()
    rows = vocabulary(docs, terms, max_features, min_df, by).collect()
    idf = [math.log(n / r["df"]) + 1 for r in rows]
    counts = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], inputCol=terms, outputCol="__counts")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="__counts", outputCol="__scaled")
    model = PipelineModel(stages=[counts, scale, Normalizer(p=2.0, inputCol="__scaled", outputCol=output)])
    table = docs.sparkSession.createDataFrame(
        [(i, r["term"], r["df"], r["tf"], w) for i, (r, w) in enumerate(zip(rows, idf))],
        "pos int, term string, df bigint, tf bigint, idf double")
    return model, table


def tfidf_vectors(docs: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(docs).drop("__counts", "__scaled")


def vector_entries(df: DataFrame, keys: list[str], vector: str, value: str = "weight") -> DataFrame:
    """(keys, pos, value) for the stored entries of a sparse vector column."""
    raw = df.select(*keys, F.unwrap_udt(vector).alias("v"))
    return raw.select(*keys, F.explode(F.arrays_zip("v.indices", "v.values")).alias("e")).select(
        *keys, F.col("e.indices").alias("pos"), F.col("e.values").alias(value))


def tfidf_table(docs: DataFrame, key: str, terms: str, idf=smooth_idf_off, min_df: int = 1) -> DataFrame:
    """(key, term, tf, df, weight) without a vocabulary limit; zero weights are left out.

    Counts per (document, term) are combined before the shuffle and written once; document frequencies and frequent terms come from
    them, and a term that stands in very many documents meets its row in several tasks.
    """
    n = F.lit(docs.count())
    counts = materialise(docs.select(key, entries(terms).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))
    frequencies = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    met = folded_join(counts, frequencies, ["term"], hot_keys(counts, ["term"])[0], by=[key]).filter("df is not null")
    raw = met.withColumn("__raw", F.col("tf") * idf(n, F.col("df"))).filter("__raw <> 0")
    # The window group is one document's distinct terms, bounded by the document itself.
    norm = F.sqrt(F.sum(F.col("__raw") * F.col("__raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "tf", "df", (F.col("__raw") / norm).alias("weight"))


def class_counts(labels: DataFrame, label: str) -> dict[object, int]:
    """Documents per class; a short list by nature."""
    return {r[label]: r["n"] for r in labels.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()}


def chi2_scores(weights: DataFrame, classes: dict[object, int], label: str, term: str = "term") -> DataFrame:
    """Chi-square of each term against the class: observed weight per class against class share times term total.

    `weights` holds (term, df, class, weight) rows for documents that have a class. A class of two thirds of all
    rows is only a sum per term here.
    """
    total = sum(classes.values())
    sums = weights.groupBy(term).agg(
        F.sum("weight").alias("__total"), F.first("df").alias("df"),
        *[F.sum(F.when(F.col(label) == c, F.col("weight")).otherwise(0.0)).alias(f"__o{i}") for i, c in enumerate(classes)])
    score = F.lit(0.0)
    for i, n in enumerate(classes.values()):
        expected = F.col("__total") * F.lit(n / total)
        score = score + (F.col(f"__o{i}") - expected) * (F.col(f"__o{i}") - expected) / expected
    return sums.select(term, "df", score.alias("chi2"))


def chi2_tail(score: Column, degrees: int) -> Column:
    """Upper tail probability of the chi-square distribution for whole degrees of freedom."""

    @F.pandas_udf("double")
    def tail(values: pd.Series) -> pd.Series:
        half = values.to_numpy(np.float64) / 2
        if degrees % 2:
            q, term, d = np.frompyfunc(math.erfc, 1, 1)(np.sqrt(half)).astype(np.float64), 2 * np.sqrt(half / np.pi) * np.exp(-half), 1
        else:
            q, term, d = np.exp(-half), half * np.exp(-half), 2
        while d < degrees:
            q = q + term
            term = term * half / (d / 2 + 1)
            d += 2
        return pd.Series(q)

    return tail(score)


def key_phrases(docs: DataFrame, key: str, terms: str, label: str, max_features: int | None = 2000) -> DataFrame:
    """(term, chi2, p_value, idf, weight = chi2 * idf) over labelled documents, one row per vocabulary term."""
    classes = class_counts(docs, label)
    if max_features is None:
        weights = tfidf_table(docs, key, terms).join(docs.select(key, label), key)
    else:
        model, positions = tfidf_model(docs, terms, max_features)
        weights = vector_entries(tfidf_vectors(docs, model), [label], "tfidf").join(F.broadcast(positions), "pos")
    idf = smooth_idf_off(F.lit(sum(classes.values())), F.col("df"))
    scored = chi2_scores(weights, classes, label).withColumn("idf", idf)
    return scored.select("term", "chi2", chi2_tail(F.col("chi2"), len(classes) - 1).alias("p_value"), "idf",
                         (F.col("chi2") * F.col("idf")).alias("weight"))


def stem_by_table(docs: DataFrame, key: str, terms: str, stems: DataFrame) -> DataFrame:
    """(key, stem, n): tokens replaced through a (token, stem) table, unchanged where it has no row.

    Tokens are counted per document before the join, so a frequent token is one row per document; if it is still hot, its rows meet copies
    of its row of the table in several tasks. The table has one row a token.
    """
    counts = materialise(docs.select(key, entries(terms).alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("n")))
    return (
        folded_join(counts, stems, ["token"], hot_keys(counts, ["token"])[0], by=[key])
        .groupBy(key, F.coalesce("stem", "token").alias("stem")).agg(F.sum("n").alias("n"))
    )
