"""Corpus preparation: quality, near copies, personal data, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before
it kept. All but the last return the columns of the documents.

Defined cases: documents without text pass the near copies and the masking untouched; a
document may occur several times after mixing, and is encoded as often; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixspan.llm import bpe, mixing, neardup, pii, quality
from helixspan.llm.texts import table
from helixspan.session import hand_over


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return neardup.deduplicate(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their digest and that of the decoded text."""
    return bpe.token_table(docs)


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Classifier, signatures and field are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each handed over as Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hand_over(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
