"""From raw documents to packed training sequences: classify, apply rules, drop near duplicates, pack.

Every stage works on all that the one before it kept. Stages take (spark, docs, sf_dir);
all but the last return documents with their columns, and the last the packed pieces. Null
and empty texts are short documents, which the rules reject; very long ones are judged whole;
of equal documents the one with the smallest doc_id stays, rows without one after all others;
an empty table passes through, and other columns of documents are kept up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coldshelf.llm import minhash, packing, quality, rules
from coldshelf.llm.cluster import rested, ship, written
from coldshelf.llm.queries import vocabulary_path

#: Percent of shared five-word shingles from which two documents are near duplicates.
SIMILAR = 80


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly labelled classifier, fitted on these documents, does not reject."""
    _freed(spark)
    return quality.passed(docs)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and lie in the compression bands."""
    _freed(spark)
    return rules.passed(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    _freed(spark)
    return minhash.one_of_each(docs, minhash.Settings(percent=SIMILAR))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows with the mixture of their sources, with their token ids."""
    _freed(spark)
    return packing.pack(docs, vocabulary_path())


def _freed(spark: SparkSession) -> None:
    """Workers begin a stage without what the one before has left with them."""
    ship(spark)
    rested(spark)


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: Tokenising and training are not for SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
