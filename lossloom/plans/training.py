"""Training and scoring frames: structured rows, notes, topic shares and keyword flags of old and new claims."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.functions import text as X
from lossloom.operators import model as G
from lossloom.operators import ordering as O
from lossloom.operators import terms as V
from lossloom.operators import topics as P
from lossloom.session import materialise

# Columns clamped before training, with the share cut off below and above.
OUTLIER_LIMITS = {
    "Report_lag": (0.01, 0.01), "prev_renewals": (0, 0.002), "exposure_Count": (0, 0.005), "claimant_count": (0, 0.005),
    "vehicle_count": (0, 0.005), "max_Pre_claims_cnt": (0, 0.01), "Body_Neck": (0, 0.001), "Body_Trunk": (0, 0.001),
    "Body_Unknown": (0, 0.001), "AUTO_BI": (0, 0.0005), "AUTO_PD": (0, 0.0005), "AUTO_COLLISION": (0, 0.0005),
    "ISO_address": (0, 0.001), "ISO_Name": (0, 0.001), "ISO_Phone": (0, 0.001), "ISO_VIN": (0, 0.001),
    "claimant_tenure_wt": (0.01, 0),
}


def old_and_new(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append by name; `is_new` keeps equal claim numbers of the two sets apart."""
    return old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)), allowMissingColumns=True)


def topic_frame(description: DataFrame, notes: DataFrame, key: str) -> DataFrame:
    """Topic shares of descriptions and notes side by side; a claim may have only one of them."""
    return description.join(notes, key, "full")


def training_frame(structured: DataFrame, unstructured: DataFrame, note_flags: DataFrame, topics: DataFrame, key: str) -> DataFrame:
    """Structured rows with text of the same set, topic shares and keyword flags.

    `note_flags` comes from `lossloom.plans.features.note_keyword_flags`; claims without notes get zeros.
    """
    joined = unstructured.join(structured, [key, "is_new"]).join(topics, key, "left").join(note_flags, key, "left")
    return joined.select("*", *X.keyword_flags(F.col("Description"), X.DESCRIPTION_RULES)).fillna(
        0, [r.name for r in X.NOTE_RULES])


def text_topics(docs: DataFrame, key: str, text: str, prefix: str, topics: int = 10, max_features: int = 500,
                stop_words: Sequence[str] = (), iterations: int = 500) -> tuple[DataFrame, PipelineModel, P.TopicFactors]:
    """Topic shares per claim of one text column, with the fitted vocabulary and factors for new documents."""
    words = docs.select(key, X.topic_words(F.col(text), stop_words).alias("__words"))
    grams = words.select(key, X.ngram_range(F.col("__words"), 2, 3).alias("__terms"))
    model, table = V.tfidf_model(grams, "__terms", max_features)
    vectors = V.tfidf_vectors(grams, model).select(key, "tfidf")
    factors = P.fit_factors(vectors, "tfidf", len(model.stages[0].vocabulary), topics, iterations)
    shares = P.topic_shares(P.factor_loadings(vectors, "tfidf", factors), key, "loadings", topics, prefix)
    return shares, model, factors


def fit_referral_model(frame: DataFrame, key: str, target: str, texts: Sequence[str], numbers: Sequence[str],
                       estimator=None, limits: Mapping[str, tuple[float, float]] | None = None,
                       seed: int = 398) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, scored train rows, scored test rows): clamp, encode, weight positives 39 : 1, boost, score."""
    limits = OUTLIER_LIMITS if limits is None else limits
    # Clamping, encoding and training pass over the rows many times; the clamp itself is a cheap projection.
    rows = materialise(G.binary_target(G.categorical(frame, texts), target))
    rows = O.winsorize(rows, {c: q for c, q in limits.items() if c in rows.columns})
    rows = rows.withColumns({"label": F.col(target).cast("double"), "weight": G.fixed_weight(F.col(target))})
    train, test = G.split(rows, key, 0.7, seed)
    encoding: Pipeline = G.encoder(train, texts, numbers)
    pipeline = Pipeline(stages=[*encoding.getStages(), estimator or G.boosted_trees(seed=seed)]).fit(train)
    keep = [key, target]
    return pipeline, G.score(train, pipeline, keep), G.score(test, pipeline, keep)
