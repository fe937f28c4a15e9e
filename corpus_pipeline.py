"""Corpus pipeline: language, near-duplicates, repeated paragraphs, source mix, packing; every stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.llm import language, mixing, packing, paragraphs, simhash
from lossloom.session import materialise, trimmed

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own, written so that every branch sees the same numbers."""
    return materialise(docs.withColumn("row", F.monotonically_increasing_id()))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay, with the language found; texts without a letter or of an unsure language go.

    Null and empty texts have no letter. Equal rows are judged alike and stay as often as they come. A very long text is read as a whole, other
    columns go, an empty table stays empty.
    """
    found = language.identify(docs).filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


@trimmed
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by fingerprints (four-word shingles, 4 of 64 bits) one stays, that with the smallest id (null last).

    Ids need not be unique and may be null: rows are told apart by a number of their own. Null and empty texts are one group. Repeated rows
    are copies. A very long text is hashed as a whole. An empty table stays empty.
    """
    rows = keyed(docs)
    found = simhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    first = rows.select("row", "doc_id").join(found, "row").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"))
    kept = materialise(first.select(F.col("first.row").alias("row")))
    # The numbers that stay are the hashed side, so that texts are streamed past them and not sorted.
    return rows.join(kept.hint("shuffle_hash"), "row", "left_semi").select(*COLUMNS)


def drop_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated paragraphs go from the texts; a document of which no word is left goes, so does one with a null or empty text.

    Rows equal in id and text are one document to the operator: what is taken from one is taken from each. Null ids come first in the order of
    which paragraph stays. A very long text is looked at as a whole, other columns go, an empty table stays empty.
    """
    found = paragraphs.drop_repeated(docs).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


@trimmed
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is repeated as often as the mix takes it; ids need not be unique and may be null.

    Repeated rows are rows of their own. A null or empty text has size 0, so the mix may take it or not; where its source is taken whole, it is.
    A very long text counts with all its words, other columns go, an empty table stays empty.
    """
    rows = keyed(docs)
    taken = materialise(mixing.mix(rows, carry=("row",)).filter("times > 0").select("row", "times"))
    return rows.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows, as packing.pack() gives them.

    A null or empty text is one end token. Repeated rows are packed as often as they come, null ids stay null, a very long text is cut into as
    many pieces as it needs, columns other than id, text and source are ignored, an empty table gives no piece.
    """
    return packing.pack(docs, keep_words=False)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_paragraphs", drop_repeated_paragraphs),
    ("mix", mix_sources),
    ("packing", pack_windows),
]


@trimmed
def written(stage, spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of a stage as a table; what the stage has written for itself goes."""
    return materialise(stage(spark, docs, sf_dir))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage, spark, docs, sf_dir)
    return STAGES[-1][1](spark, docs, sf_dir)


# Fingerprints, MinHash and the tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
