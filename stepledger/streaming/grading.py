"""Grading of outputs as they arrive.

Steps are graded without state, so a stream of them is a projection; counts
by window keep state only as far as the watermark. Batches are written by
their number, so a batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stepledger.domain import DEFAULT, SUBSCORES, Domain
from stepledger.operators.verify import verify_steps


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    """Files of a folder as they appear."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def graded_stream(steps: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    """A stream of steps with their results."""
    return verify_steps(steps, domain)


def windowed_means(graded: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and mean subscores for each window; rows later than the watermark are left out."""
    rows = graded.withWatermark(time, late)
    return rows.groupBy(F.window(time, window)).agg(F.count("*").alias("n"), F.count_if("result.passed").alias("passed"), *[F.avg(f"result.{s}").alias(s) for s in SUBSCORES])


def write_batches(stream: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to a folder, a subfolder for each batch."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
