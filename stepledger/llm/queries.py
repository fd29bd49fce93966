"""The registered queries of the training-data operators, one for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stepledger.llm import decontam, html, lattice, linededup, neardup, packing, pii, quality, topk, warc
from stepledger.llm._shared import table


def op1_html_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice scores of every document."""
    return lattice.score(table(spark, sf_dir, "documents"), lattice.vocabulary())


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    return linededup.by_site(table(spark, sf_dir, "documents"))


def op6_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test items that documents contain."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learned quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, *quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every fiftieth one."""
    return topk.search(table(spark, sf_dir, "embeddings"))


def op9_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, *pii.fit(docs))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), *packing.vocabulary())


QUERIES = {
    "op1_html_text_density": op1_html_text_density,
    "op2_warc_index": op2_warc_index,
    "op3_simhash_neardup": op3_simhash_neardup,
    "op4_subword_lattice": op4_subword_lattice,
    "op5_line_frequency": op5_line_frequency,
    "op6_pigeonhole_decontamination": op6_pigeonhole_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_histogram_topk": op8_histogram_topk,
    "op9_pii_boosting": op9_pii_boosting,
    "op10_best_fit_packing": op10_best_fit_packing,
}
ORACLE_SQL: dict[str, str] = {"op2_warc_index": warc.ORACLE_SQL, "op5_line_frequency": linededup.ORACLE_SQL, "op8_histogram_topk": topk.ORACLE_SQL}
