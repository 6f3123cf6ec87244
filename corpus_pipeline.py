"""The corpus pipeline: five stages over ``documents``, each one operator.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of documents; the last returns the encoded corpus.  ``run`` writes
every stage's rows to the shared scratch folder and reads them again.

All stages take null and empty texts (they stay, and give no ids), very long
texts (whole), rows that repeat, null ids, empty tables and further columns of
any name (kept up to the last stage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.llm import decontaminate, pieces, pii, shingle_join, toxicity
from featurelake.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours predict toxic go; a score of
    exactly 0.5 is toxic.  Rows that repeat go or stay together."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more)
    one document stays: the smallest id; of rows that repeat it, one.  Texts
    without words all stay."""
    return shingle_join.one_of_each(docs, shingle_join.NEAR_COPY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a
    whole shorter item, go.  Without items all stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that give it away are replaced in the
    text; every document stays."""
    out = pii.sanitised(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, score, round_trip) of each document kept."""
    return pieces.encode(docs).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "score", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", sanitise),
    ("sentencepiece", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# The neighbours, the component search over floating bounds and the encoder
# have no SQL form; tests/llm compares the rows of ``run`` with a plain-Python version.
ORACLE_SQL = None
