"""Documents to training ids: quality, near-duplicates, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import curriculum, lshforest, outliers, pieces, pii
from siltstone.llm.common import read, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject."""
    return outliers.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group with a shingle similarity of 0.8 or more."""
    return lshforest.keep_one(docs, 0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of documents that the mix takes, in training order."""
    return curriculum.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the SentencePiece ids of each copy in the mix."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "lang", "source"],
                         digests=False).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: SQL cannot express the estimates, signatures and encodings; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
