"""Recovery claims: extract with claim type and flag, and the text model on top of it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.functions import text as X
from lossloom.functions.conditional import indicator, longer_text
from lossloom.operators import filters as L
from lossloom.operators import joins as J
from lossloom.operators import model as G
from lossloom.operators import terms as V
from lossloom.session import materialise

# Company, risk classes, report period, closed status and the types that count as recovery.
COMPANY = "1"
RISK_CLASSES = ("MPA", "MSA", "MVA", "MVD", "MVF")
FIRST_REPORT, LAST_REPORT = date(2011, 1, 1), date(2013, 12, 31)
CLOSED = "C"
RECOVERY_TYPES = ("20", "30")
CLAIM_KEY = ("COMPANY_CODE", "claim_br", "claim_no")
POLICY_KEY = ("COMPANY_CODE", "POLICY_BR", "POLICY_NO", "POLICY_TYP")


def _current(df: DataFrame, end_column: str | None) -> DataFrame:
    return L.current_records(df.filter(F.col("COMPANY_CODE").cast("string") == COMPANY), end_column=end_column,
                             valid_record="valid_rec", valid_flag="valid_flag")


def _keyed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(J.concat_key(*[F.col(c) for c in CLAIM_KEY]).alias("claimno"), *columns)


def recovery_extract(claims: DataFrame, motor: DataFrame, vehicle: DataFrame, accident: DataFrame,
                     incidents: DataFrame) -> DataFrame:
    """Closed claims of the period with incident text, first known claim type and recovery flag."""
    base = _current(claims, "clav_ca_end_date").filter(
        F.col("DATE_rept").between(F.lit(FIRST_REPORT), F.lit(LAST_REPORT))
        & (F.col("claim_status") == CLOSED) & F.col("RSK_CLASS").isin(*RISK_CLASSES))
    base = base.select(
        "*", J.concat_key(*[F.col(c) for c in POLICY_KEY]).alias("policyno"),
        J.concat_key(*[F.col(c) for c in CLAIM_KEY]).alias("claimno"))
    for side, end, column in ((motor, "clav_mt_end_date", "clm_typ"), (vehicle, "clav_vc_end_date", "clm_type"),
                              (accident, "clav_va_end_date", "TYPE_CLAM")):
        base = base.join(_keyed(_current(side, end), [column]), "claimno", "left")
    base = base.join(_keyed(_current(incidents, None), ["INCIDENT_DESC"]), "claimno", "left")
    kind = F.coalesce("clm_typ", "clm_type", "TYPE_CLAM")
    return base.withColumns({
        "Claim_Type_F": kind, "RECOVERY_FLAG": indicator(kind.isin(*RECOVERY_TYPES))}).drop("clm_typ", "clm_type", "TYPE_CLAM")


def early_extract(claims: DataFrame, incidents: DataFrame) -> DataFrame:
    """Claims reported since the first date with their incident text; the right-hand filters make the join inner."""
    left = claims.select("*", J.concat_key(*[F.col(c) for c in CLAIM_KEY]).alias("claimno"))
    right = incidents.select(
        J.concat_key(*[F.col(c) for c in CLAIM_KEY]).alias("claimno"), F.col("INCIDENT_DESC"),
        *[F.col(c).alias(f"b_{c}") for c in ("COMPANY_CODE", "valid_rec", "valid_flag")])
    tests = [(F.col(f"{p}COMPANY_CODE").cast("string") == COMPANY) & (F.col(f"{p}valid_rec") == 1) & (F.col(f"{p}valid_flag") <= 2)
             for p in ("", "b_")]
    return left.join(right, "claimno", "left").filter(
        tests[0] & tests[1] & (F.col("DATE_rept") >= F.lit(FIRST_REPORT)) & F.col("RSK_CLASS").isin(*RISK_CLASSES)
    ).drop("b_COMPANY_CODE", "b_valid_rec", "b_valid_flag")


def recovery_model(extract: DataFrame, stop_words: Sequence[str] = (), max_features: int = 500, trees: int = 100,
                   depth: int = 30) -> PipelineModel:
    """Balanced forest over 1-3-gram weights of the incident text (claim text when that is too short)."""
    text = longer_text(F.col("INCIDENT_DESC"), F.col("CLM_DESC1"))
    docs = extract.select(F.col("RECOVERY_FLAG").cast("double").alias("label"), X.tokens(text, stop_words).alias("toks"))
    docs = docs.select("label", X.ngram_range(F.coalesce("toks", F.array().cast("array<string>")), 1, 3).alias("terms"))
    vectors, _ = V.tfidf_model(docs, "terms", max_features, min_df=2, output="features")
    frame = G.balanced_weights(materialise(V.tfidf_vectors(docs, vectors).drop("terms")), "label")
    fitted = G.forest(trees=trees, depth=depth).fit(frame)
    return PipelineModel(stages=[*vectors.stages, fitted])
