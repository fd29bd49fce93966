"""What the operators share: tables, scratch space and batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python worker turns into objects at once; the session bounds the bytes of what reaches it.
SLICE_ROWS = 512

#: Written folders that nobody has discarded yet, by the session that wrote them.
_WRITTEN: dict[SparkSession, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most so many rows, whatever the session sends."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def hash_share(column: Column, wanted: int, of: int) -> Column:
    """A condition that holds for about ``wanted`` of so many rows, by a hash; for all where they are fewer."""
    share = min(1.0, wanted / max(1, of))
    return F.lit(True) if share >= 1 else F.pmod(F.xxhash64(column), F.lit(1 << 31)) < int(share * (1 << 31))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares.

    The folder is the session's ``spark.checkpoint.dir``. Only in local mode,
    where all run on one machine, may it be unset: a temporary folder is made
    then. Elsewhere executors would write to disks of their own, so it raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="stepledger-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    keep_track(spark, path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def keep_track(spark: SparkSession, path: str) -> None:
    """Remember a written folder, so that release() finds it."""
    _WRITTEN.setdefault(spark, []).append(path)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*frames: DataFrame | None) -> None:
    """Delete what materialise() wrote for frames that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_written_to", None)
        if path and path in _WRITTEN.get(df.sparkSession, ()):
            _WRITTEN[df.sparkSession].remove(path)
            _remove(df.sparkSession, path)


def release(spark: SparkSession) -> int:
    """Delete all intermediate folders of a session, once its results are written; how many there were."""
    paths = _WRITTEN.pop(spark, [])
    for path in paths:
        _remove(spark, path)
    return len(paths)


def open_folder(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address or a local path."""
    return fs.FileSystem.from_uri(address) if "://" in address or address.startswith("file:") else (fs.LocalFileSystem(), address)


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, made longer until no column has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out
