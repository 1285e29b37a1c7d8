"""Session settings, shared scratch space and staging."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

# Repeated keys are legal JSON; the last one wins, as in most JSON readers.
SETTINGS = {
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the document functions rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Tasks that list folders, for each core.
LISTING_TASKS = 4


@contextmanager
def listing_by_few_tasks(spark: SparkSession) -> Iterator[None]:
    """While open, a task lists many folders. By default each folder is a task of its own, up to 10,000."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir() + "/docferry"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a value is fixed by one evaluation of the plan (row positions), so a
    lost executor cannot make a later pass see other values. Parquet rather than
    ``checkpoint()``, so that later passes read only the columns they need.
    """
    path = path or scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_at(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The store of a shared folder, for tasks that write files of their own, and the path in it."""
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path.removeprefix("file:")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that is used up."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
