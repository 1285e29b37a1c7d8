"""Consecutive numbering, bounded batches and request bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.functions.json_text import bulk_line
from docferry.operators.validate import with_update_id
from docferry.session import stage

# Documents per request, requests in flight.
DEFAULT_BATCH_SIZE = 5_000
DEFAULT_MAX_REQUESTS = 16
READING_ORDER = ("path", "block_start", "pos")

# Layout of monotonically_increasing_id(): partition number above, row number below.
_ROW_BITS = 33


def _columns(order_by) -> list[Column]:
    names = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return [F.col(c) if isinstance(c, str) else c for c in names]


def with_row_index(df: DataFrame, order_by=READING_ORDER) -> DataFrame:
    """Number rows 0, 1, 2 … in the given order, without one task seeing all of them.

    The order is made by range partitioning, so a source that holds a third of all rows
    is still cut into equal parts. ``order_by`` should name a unique key: rows that tie
    are numbered in any order.
    """
    return number_sorted(df.orderBy(*_columns(order_by)))


def _part() -> Column:
    return F.shiftright("_place", _ROW_BITS).alias("_part")


def _part_starts(placed: DataFrame, amount: Column) -> DataFrame:
    """What comes before each partition: ``_part``, ``_start``.

    One row per partition of the sort, however many rows there are: small enough for one
    window and for a broadcast.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.groupBy(_part())
        .agg(F.sum(amount).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )


def number_sorted(df: DataFrame) -> DataFrame:
    """Number the rows of a sorted DataFrame in their order.

    Each row has a place inside its partition; a partition starts at the sum of the counts
    before it. The sorted rows are staged once, because both passes must see the same
    partitions.
    """
    placed = stage(df.withColumn("_place", F.monotonically_increasing_id()), "row-index")
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", _part())
        .join(F.broadcast(_part_starts(placed, F.lit(1))), "_part")
        .withColumn("row_index", F.col("_start") + row)
        .drop("_place", "_part", "_start")
    )


def number_as_read(df: DataFrame) -> DataFrame:
    """Number documents in reading order without moving them.

    For rows as a reader gave them, at most filtered or with other columns since: the rows
    of a file block then still follow each other in one task. So only the blocks, one row
    each, are sorted and summed, and the documents are staged but not shuffled. Refuses
    rows that have been moved.
    """
    placed = stage(df.withColumn("_place", F.monotonically_increasing_id()), "as-read")
    pos, place = F.col("pos"), F.col("_place")
    blocks = placed.groupBy("path", "block_start").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(place).alias("_first"),
        F.max(place).alias("_last"),
        ((F.min_by(pos, place) == F.min(pos)) & (F.max_by(pos, place) == F.max(pos))).alias("_ordered"),
    )
    blocks = stage(blocks.orderBy("path", "block_start").withColumn("_place", F.monotonically_increasing_id()), "blocks")
    whole = F.col("_ordered") & (F.col("_last") - F.col("_first") + 1 == F.col("_n"))
    if not blocks.where(~whole).isEmpty():
        raise ValueError("rows are not as they were read; name the order to sort by")
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.withColumn("_part", _part())
        .join(F.broadcast(_part_starts(blocks, F.col("_n"))), "_part")
        .withColumn("_base", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) - F.col("_first"))
        .select("path", "block_start", "_base")
    )
    # Staged, so that Spark knows its size: it is broadcast if that is small, joined if not.
    return (
        placed.join(stage(starts, "block-starts"), ["path", "block_start"])
        .withColumn("row_index", F.col("_base") + place)
        .select(*df.columns, "row_index")
    )


def assign_batches(
    df: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, order_by=READING_ORDER, as_read: bool = False
) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos``: consecutive batches of ``batch_size`` rows, the
    last one short.

    ``as_read`` tells that the rows are still as a reader gave them, which saves the sort.
    """
    if batch_size < 1:
        raise ValueError("batch size must be at least 1")
    numbered = number_as_read(df) if as_read else with_row_index(df, order_by)
    size = F.lit(batch_size)
    return numbered.withColumns(
        {
            "batch_id": F.call_function("div", F.col("row_index"), size),
            "batch_pos": (F.col("row_index") % size).cast("int"),
        }
    ).drop("row_index")


def checked_lines(df: DataFrame, action: str = "create", validated: bool = False) -> DataFrame:
    """Add ``line``, the text of one bulk operation, and ``error`` where there is none to send.

    An error already there stays. A null document has no line, nor has an update without a
    string ``_id``.
    """
    refused = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    refused = F.when(F.col("doc").isNull(), F.coalesce(refused, F.lit("no document"))).otherwise(refused)
    marked = df.withColumn("_refused", refused).drop("error")
    if action == "update":
        sound = F.when(F.col("_refused").isNull(), F.col("doc"))
        split = with_update_id(marked.withColumn("doc", sound), validated=validated)
        error = F.coalesce(F.col("_refused"), F.concat(F.lit("update action: "), F.col("error")))
        line = bulk_line(action, F.col("doc"), F.col("id"))
    else:
        split, error, line = marked, F.col("_refused"), bulk_line(action, F.col("doc"))
    return split.withColumn("error", error).withColumn("line", F.when(F.col("error").isNull(), line)).drop("_refused")


def bulk_lines(df: DataFrame, action: str = "create", validated: bool = False) -> DataFrame:
    """Add ``line``: the text of one bulk operation per document.

    An update needs a string ``_id`` in each document; rows without one fail the job. A
    writer that sends should take ``checked_lines``, so that no task fails after sending.
    """
    if action != "update":
        return df.withColumn("line", bulk_line(action, F.col("doc")))
    split = with_update_id(df, validated=validated)
    line = bulk_line(action, F.col("doc"), F.col("id"))
    failure = F.raise_error(F.concat(F.lit("update action: "), F.col("error")))
    return split.withColumn("line", F.when(F.col("error").isNull(), line).otherwise(failure)).drop("error")


def render_batches(df: DataFrame) -> DataFrame:
    """One request body per batch from ``batch_id``, ``batch_pos`` and ``line``.

    A group is one batch, so it never holds more than the batch size.
    """
    ordered = F.array_sort(F.collect_list(F.struct("batch_pos", "line")))
    return df.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.array_join(F.transform(ordered, lambda r: r["line"]), "").alias("body"),
    )
