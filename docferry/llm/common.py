"""Helpers of the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry import session

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["UPPER", "WORD", "lower_ascii", "stage", "table", "worker_store", "n_tasks", "crc_class", "recorded", "row_slices", "arrow_rows"]


#: Lists that are told of every table staged, while ``recorded`` is open.
_RECORDS: list[list[str]] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = session.scratch_dir(df.sparkSession, label)
    for record in _RECORDS:
        record.append(path)
    return session.stage(df, label, path)


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Add the folders of all tables staged meanwhile to ``paths``."""
    _RECORDS.append(paths)
    try:
        yield
    finally:
        _RECORDS.remove(paths)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """While open, what runs hands texts to Python in Arrow batches of at most so many rows.

    An executor holds a batch for each of its tasks outside its heap, twice while a buffer grows.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def crc_class(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def n_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_store(name: str, make: Callable[[], object]):
    """An object that lives as long as its Python worker, shared by all tasks it runs.

    Functions may be sent to workers by value, which gives their module's globals anew to
    every task; a module kept in ``sys.modules`` stays. When a stage makes an object, those
    that it has not asked for go, so the memories of one operator's stages do not add up
    with those of another.
    """
    kept = sys.modules.setdefault("_docferry_worker", types.ModuleType("_docferry_worker")).__dict__.setdefault("kept", {})
    context = TaskContext.get()
    stage_id = context.stageId() if context else None
    if name not in kept:
        for other in [k for k, (_, used) in kept.items() if used != stage_id]:
            del kept[other]
        kept[name] = (make(), stage_id)
    kept[name] = (kept[name][0], stage_id)
    return kept[name][0]


def row_slices(texts: pa.Array, n_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of an Arrow text column whose texts have about ``n_bytes`` together, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(ends):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + n_bytes, "right")))
        yield lo, hi
        lo = hi
