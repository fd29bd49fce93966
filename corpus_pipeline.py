"""A corpus from raw documents to packed sequences, in stages.

Every stage reads what the one before it kept, as Parquet, and passes on the
columns of documents; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepledger.llm import decontam, linededup, neardup, packing, quality
from stepledger.llm._shared import materialise, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality score accepts."""
    return quality.keep(docs, *quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; copies of a text count once."""
    return linededup.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long"))


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingle sets with a similarity of 0.8 or more."""
    return neardup.keep_similar(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any test item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(docs, *packing.vocabulary())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_neardup", simhash_neardup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained and iterative stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None
