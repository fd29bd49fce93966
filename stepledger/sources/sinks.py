"""Writers: line files, append logs, split folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepledger.sources.lines import exists


def write_lines(rows: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> None:
    """One text column as lines; a missing text is an empty line."""
    rows.select(F.coalesce(F.col(column), F.lit("")).alias("value")).write.mode(mode).text(path)


def write_json_lines(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as JSON lines; nulls stay as keys."""
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Rows behind those that are there."""
    write_json_lines(rows, path, "append")


def start_run(spark: SparkSession, path: str, timestamp: str, shuffle_seed: int) -> None:
    """Open a run in a log of rejections with a marker row, which reading leaves out."""
    append_log(spark.createDataFrame([(True, timestamp, shuffle_seed)], "_run_start boolean, timestamp string, shuffle_seed long"), path)


def append_partial(rows: DataFrame, path: str) -> None:
    """Finished rows of a run behind those that are there, for a resume."""
    append_log(rows, path)


def write_data_set(rows: DataFrame, seeds: DataFrame, folder: str, partial: str | None = None, column: str = "value") -> list[str]:
    """Accepted rows as train and dev and the seeds as test; returns what was there before.

    The partial log goes only once all is written, so a run that breaks off
    before leaves it for the next one.
    """
    spark = rows.sparkSession
    whole = rows.where(F.col("split").isin("train", "dev")).select(column, "split").unionByName(seeds.select(column, F.lit("test").alias("split")))
    before = write_splits(whole, folder, column=column)
    if partial is not None and exists(spark, partial):
        where = spark._jvm.org.apache.hadoop.fs.Path(partial)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return before


def write_splits(rows: DataFrame, folder: str, names=("train", "dev", "test"), column: str = "value", split: str = "split") -> list[str]:
    """A folder of lines for each split; returns those that were there before."""
    before = [n for n in names if exists(rows.sparkSession, f"{folder}/{n}")]
    for name in names:
        write_lines(rows.where(F.col(split) == name), f"{folder}/{name}", column)
    return before
