"""JSON lines, reports, saved responses and other files as DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stepledger.functions.jsontext import valid
from stepledger.functions.text import response_content, strip

LINES = "value string, file string, row_idx long"
REPORT = "run_name string, n_examples bigint, pass_at_1 double, pass_at_k double, pass_at_maj double, k int, failure_modes map<string,bigint>"
RESPONSE_PATH = r"([A-Za-z0-9_.-]+)/step-(\d+)\.(think|call)\.response\.json$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that its pattern names, is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_lines(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Lines that are not blank, stripped, with their file and an order.

    ``row_idx`` grows with the place in a file; of two files it orders them as
    the scan does. It is taken at the scan, before any exchange.
    """
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], LINES)
    rows = spark.read.text(path).select(strip(F.col("value")).alias("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row_idx"))
    return rows.where("value <> ''")


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str, bad: str = "skip", missing_ok: bool = False) -> DataFrame:
    """Lines as columns of a schema, with ok, file and row_idx.

    ``bad`` says what malformed lines do: "skip" leaves them out, "keep"
    counts them as rows with ok false, "fail" raises an error.
    """
    if bad not in ("skip", "keep", "fail"):
        raise ValueError(f"bad is skip, keep or fail, not {bad!r}")
    rows = read_lines(spark, path, missing_ok).withColumn("ok", valid(F.col("value")))
    if bad == "skip":
        rows = rows.where("ok")
    elif bad == "fail":
        rows = rows.withColumn("value", F.when(F.col("ok"), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("malformed line: "), F.substring("value", 1, 80)))))
    parsed = F.from_json("value", schema)
    return rows.select("value", parsed.alias("row"), "ok", "file", "row_idx").select("value", "row.*", "ok", "file", "row_idx")


def read_reports(spark: SparkSession, path: str, pattern: str | None = None, last: int | None = None) -> DataFrame:
    """Run reports of a folder, by name; with ``last`` only the newest of those that match the pattern."""
    glob = f"{path.rstrip('/')}/{pattern or '*.json'}"
    names = "file string, modified timestamp, value string"
    if not exists(spark, glob):
        files = spark.createDataFrame([], names)
    else:
        files = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), "value")
    if last is not None:
        files = files.orderBy(F.desc("modified"), "file").limit(last)
    rows = files.where(valid(F.col("value")) & F.startswith(strip(F.col("value")), F.lit("{")))
    return rows.select("file", F.from_json("value", REPORT).alias("r")).select("file", "r.*").orderBy("file")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """trajectory_id, step_idx and the texts of the saved think and call responses."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    rows = files.where(F.col("file").rlike(RESPONSE_PATH)).select(
        F.regexp_extract("file", RESPONSE_PATH, 1).alias("trajectory_id"), F.regexp_extract("file", RESPONSE_PATH, 2).cast("int").alias("step_idx"), F.regexp_extract("file", RESPONSE_PATH, 3).alias("part"), response_content(F.col("value")).alias("text")
    )
    rows = rows.where(~F.col("trajectory_id").isin(".", ".."))
    return rows.groupBy("trajectory_id", "step_idx").pivot("part", ["think", "call"]).agg(F.first("text"))


def read_resume(spark: SparkSession, path: str, key: str = "trajectory_id") -> DataFrame:
    """Finished rows of an interrupted run, the last of each key."""
    rows = read_json_lines(spark, path, f"{key} string", missing_ok=True).where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.max_by("value", "row_idx").alias("value"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """file and sha256 of the files of a path; no rows where there are none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, sha256 string")
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.sha2("content", 256).alias("sha256"))


def safe_component(name: str) -> bool:
    """Whether a name can be a part of a response path."""
    return bool(re.fullmatch(r"[A-Za-z0-9_.-]+", name)) and name not in (".", "..")

