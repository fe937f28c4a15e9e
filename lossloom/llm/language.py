"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes, fold, unused

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
MAX_LANGUAGES = 512
CHUNK = 1 << 16  # n-grams summed at once: at most CHUNK x MAX_LANGUAGES numbers, 256 MB at 512 languages, 8 MB at 16
BLANK = 32


@functools.cache
def letters() -> np.ndarray:
    """Is code point i a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def features(text: bytes) -> np.ndarray:
    """Buckets (two bytes each) of all n-grams of a whole text: lower case, every run of other than letters one blank; empty without a letter."""
    codes = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), "<u4")
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.empty(0, np.uint16)
    codes = np.where(is_letter, codes, BLANK)
    codes = codes[is_letter | np.r_[True, is_letter[:-1]]]
    codes = np.r_[codes[:0], BLANK, codes, BLANK].astype(np.uint32) if codes[0] != BLANK else np.r_[codes, BLANK].astype(np.uint32)
    out = []
    value = np.zeros(len(codes), np.uint32)
    for n in ORDERS:
        if len(codes) < n:
            break
        value = value[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:] + np.uint32(n)
        mixed = value * np.uint32(0x9E3779B1)
        out.append((mixed >> np.uint32(16)).astype(np.uint16))
    return np.concatenate(out)


def training_sample(docs: DataFrame, learn: Column, per_language: int) -> DataFrame:
    """At most `per_language` rows of each language among those that `learn` allows: the first by a hash of id and text length."""
    order = ("draw", "doc_id")
    part = F.pmod("draw", F.lit(64))
    known = docs.filter(learn & F.col("lang").isNotNull()).select(
        "lang", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), F.lit(10)).alias("draw"))
    # First within parts of a language, so that no task ranks all rows of a frequent one.
    for keys in (("lang", part), ("lang",)):
        known = known.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("r") <= per_language)
    chosen = known.select("doc_id").distinct()
    return docs.filter(learn & F.col("lang").isNotNull()).join(F.broadcast(chosen), docs["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")


def train(docs: DataFrame, learn: Column, per_language: int = 1500, smoothing: float = 0.1) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and the (bucket, language) matrix of log probabilities; the last row holds the log priors.

    Fitted on a bounded sample of `per_language` whole texts a language, so the matrix is the only thing that reaches
    the driver: BUCKETS x languages numbers, and languages are limited to MAX_LANGUAGES.
    """

    def make():
        counts: dict[str, np.ndarray] = {}

        def step(batch: dict) -> dict | None:
            if batch:
                for lang, text in zip(batch["lang"], batch["text"]):
                    found = np.bincount(features(text), minlength=BUCKETS)
                    counts[lang] = counts[lang] + found if lang in counts else found
                return None
            return {"lang": list(counts), "counts": [c.astype("<i8").tobytes() for c in counts.values()]}

        return step

    sample = training_sample(docs, learn, per_language).select("lang", as_bytes(F.col("text")).alias("text")).repartition(16, "text")
    total: dict[str, np.ndarray] = {}
    for row in arrow_pass(sample, "lang string, counts binary", make).toLocalIterator():
        found = np.frombuffer(row["counts"], "<i8")
        total[row["lang"]] = total[row["lang"]] + found if row["lang"] in total else found
        if len(total) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would outgrow its bound")
    names = sorted(total)
    prior = {r["lang"]: r["n"] for r in docs.filter(learn & F.col("lang").isin(names)).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()} if names else {}
    matrix = np.zeros((BUCKETS + 1, len(names)))
    for k, name in enumerate(names):
        matrix[:-1, k] = np.log((total[name] + smoothing) / (total[name].sum() + smoothing * BUCKETS))
        matrix[-1, k] = np.log(prior[name] / sum(prior.values()))
    return names, matrix


def identify(docs: DataFrame, learn: Column | None = None, per_language: int = 1500) -> DataFrame:
    """Every column of `docs` plus held_out, lang_pred and score, for every row of `docs(doc_id, text, lang)`.

    Learns from rows that `learn` allows (by default those outside fold 0 of the id's crc32) and that have a language;
    a prediction sees the text alone. The score is the posterior of the predicted language. A text that is null or has no
    letter, or any text when nothing could be learned, gets `und` with score 0; ties go to the first language by code
    point. A null id falls into the fold of the empty text. Existing columns of the three new names are replaced, others keep their values
    whatever their names. Repeated rows are predicted alike, a very long text is scored as a whole in bounded runs, an empty table stays empty.
    """
    held = fold(F.col("doc_id")) == 0
    names, matrix = train(docs, ~held if learn is None else learn, per_language)
    shared = docs.sparkSession.sparkContext.broadcast(matrix)
    kept = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")]

    @F.pandas_udf("struct<lang_pred string, score double>")
    def predict(texts):
        import pandas as pd

        table = shared.value
        out_lang, out_score = [], []
        for text in texts:
            found = features(text) if names else ()
            if not len(found):
                out_lang.append(UNKNOWN)
                out_score.append(0.0)
                continue
            total = table[-1].copy()
            for s in range(0, len(found), CHUNK):
                total += table[found[s:s + CHUNK]].sum(0)
            best = int(total.argmax())
            out_lang.append(names[best])
            out_score.append(float(1 / np.exp(np.minimum(total - total[best], 0)).sum()))
        return pd.DataFrame({"lang_pred": out_lang, "score": out_score})

    name = unused(docs, "guess")
    guessed = docs.select(*kept, held.alias("held_out"), predict(as_bytes(F.col("text"))).alias(name))
    return guessed.select(*kept, "held_out", F.col(name)["lang_pred"].alias("lang_pred"), F.col(name)["score"].alias("score"))
