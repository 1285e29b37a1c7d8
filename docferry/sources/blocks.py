"""Records that span lines, cut within file blocks and joined over their borders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.functions.paths import plain_path


#: What a task reads at least, where there are more than ``TASKS`` splits for each core.
TASK_BYTES = 128 << 20
TASKS = 4


def gathered(rows: DataFrame) -> DataFrame:
    """The rows of a file scan, several small splits to a task.

    Splits may be set far smaller than ``TASK_BYTES``; a task, a Python worker's start and a file
    for each would then cost more than the reading. The splits stay as they are, in their order.
    """
    spark = rows.sparkSession
    n, size = rows.rdd.getNumPartitions(), spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(TASKS * spark.sparkContext.defaultParallelism, -(-n * size // TASK_BYTES))
    return rows.coalesce(tasks) if tasks < n else rows


def byte_lines(text: DataFrame) -> DataFrame:
    """``path``, ``block_start``, ``pos`` and ``value`` (bytes) of a text scan by lines."""
    return gathered(text.select(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").cast("binary").alias("value"),
    ))


def block_runs(paths: pa.Array, starts: pa.Array) -> Iterator[tuple[str, int, int, int]]:
    """``(path, block start, first row, behind the last row)`` for the file blocks of a batch."""
    coded = paths.dictionary_encode()
    code, start = coded.indices.to_numpy(), starts.to_numpy()
    cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), len(paths)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi > lo:
            yield coded.dictionary[int(code[lo])].as_py(), int(start[lo]), lo, hi


def join_pieces(pieces: DataFrame, ended: Column) -> DataFrame:
    """Whole records from the pieces at the borders of blocks: ``path``, ``block_start``, ``pos``,
    ``record`` and the first piece's other columns.

    A piece ``opens`` a record or goes on with one, and ``ends`` it or not; a block has at most
    one piece that does not open and one that does not end, so few rows move. ``record`` is
    null unless ``ended`` (of ``ends``, whether the last piece ends it) holds.
    """
    more = [c for c in pieces.columns if c not in ("path", "block_start", "pos", "record", "opens", "ends")]
    order = Window.partitionBy("path").orderBy("block_start", "pos")
    parts = pieces.where("not (opens and ends)").withColumn("number", F.sum(F.col("opens").cast("int")).over(order))
    in_order = F.array_sort(F.collect_list(F.struct("block_start", "pos", "record", *more)))
    joined = parts.groupBy("path", "number").agg(in_order.alias("parts"), F.max("ends").alias("ends"))
    first, texts = F.col("parts")[0], F.transform("parts", lambda p: p["record"])
    # Joined at once: adding one piece after another would copy a record once for every block it crosses.
    joint = F.array_join(F.transform(texts, lambda t: t.cast("string")), "\n").cast("binary")
    text = F.when(~F.exists(texts, lambda t: t.isNull()), joint)
    rest = [first[c].alias(c) for c in ("block_start", "pos")]
    return joined.select("path", *rest, F.when(ended, text).alias("record"), *[first[c].alias(c) for c in more])
