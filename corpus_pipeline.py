"""The corpus pipeline: documents pass through the stages one after another.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that the one before
it kept. All but the last return the columns of documents; rows that they reject are gone.
An empty table passes through every stage; null texts leave at language identification.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion_marts.llm import exact_dedup, language_id, near_dedup, packing, toxicity
from medallion_marts.llm.common import id_remainder, read_table, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7; labels of one fold in three are left for testing."""
    labels = read_table(spark, sf_dir, "labels").where(id_remainder(F.col("doc_id"), 3) != 1)
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels), threshold=0.7)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told; one fold in five is left for testing."""
    model = language_id.learn(docs.where(id_remainder(F.col("doc_id"), 5) != 0))
    return language_id.keep_identified(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.8 or more the one with the smallest doc_id."""
    return near_dedup.drop_near_copies(docs, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: The classifiers, the token ids and the packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
