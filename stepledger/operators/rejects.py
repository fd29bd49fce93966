"""Histograms of rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepledger.functions.text import error_bucket

TOP_ERRORS, TOP_SEEDS = 10, 20


def rejections(log: DataFrame) -> DataFrame:
    """The rows of a log that are rejections; run markers are not."""
    return log.where(~F.coalesce(F.col("_run_start"), F.lit(False))) if "_run_start" in log.columns else log


def histogram(log: DataFrame, value: Column, name: str, order: str = "row_idx") -> DataFrame:
    """Counts of a value, with the row where each was first seen."""
    return rejections(log).groupBy(value.alias(name)).agg(F.count("*").alias("n"), F.min(order).alias("first_row"))


def by_reason(log: DataFrame) -> DataFrame:
    return histogram(log, F.coalesce(F.col("reason"), F.lit("unknown")), "reason")


def by_seed(log: DataFrame) -> DataFrame:
    return histogram(log, F.coalesce(F.col("seed_id"), F.lit("<unknown>")), "seed_id")


def by_error(log: DataFrame) -> DataFrame:
    return histogram(log, error_bucket(F.col("error")), "error")


def top(counts: DataFrame, n: int) -> DataFrame:
    """The most frequent values, those as frequent in the order seen."""
    return counts.orderBy(F.desc("n"), "first_row").limit(n)


def classify(raw: Column, ok: Column, shaped: Column, passed: Column) -> Column:
    """What becomes of a completion: its reason of rejection, or accept. No text at all is the teacher's failure."""
    return F.when(raw.isNull(), "teacher_error").when(~F.coalesce(ok, F.lit(False)), "json_decode").when(~F.coalesce(shaped, F.lit(False)), "malformed_structure").when(~F.coalesce(passed, F.lit(False)), "verifier_failed").otherwise("accept")
