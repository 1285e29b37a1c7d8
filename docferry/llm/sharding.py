"""Shards by extendible hashing, with DataFrame operations only.

Rows are placed by the leading bits of a hash. The directory starts with so few bits that
shards would be full on average, and only buckets above the byte limit are split on further
bits, round by round, until each fits. Each round reads only the rows of open buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import stage

SHARD_BYTES = 1 << 20
#: Bits of the hash, and how many of them one round looks at.
BITS, STEP = 60, 4


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key as text; null counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def prefix(depth: Column) -> Column:
    """The leading ``depth`` bits of the hash."""
    return F.call_function("shiftright", F.col("hash"), (F.lit(BITS) - depth).cast("int"))


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """For every row: ``n_bytes``, its shard (``depth``, ``prefix``, ``piece``) and that shard's bytes and rows.

    A bucket is split while it holds more than ``limit`` bytes and more than one row. Rows
    that share all bits of the hash, as rows that repeat an identifier do, cannot be split
    by it: their bucket is cut into ``piece`` 0, 1, … instead. Each of its rows above half the
    limit is a piece of its own; the others are cut by running bytes, so that no piece passes
    the limit. One row above the limit is a shard of its own. Null texts count 0 bytes. An empty table gives no rows.
    """
    rows = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("n_bytes"),
            hash_bits(F.col(f"`{id_col}`")).alias("hash"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "shard-rows",
    )
    open_rows, done, depth = rows, [], -1
    while depth < BITS:
        levels = list(range(depth + 1, min(depth + STEP, BITS) + 1))
        depth = levels[-1]
        # Sums at the deepest level of the round, rolled up to the others.
        deepest = open_rows.groupBy(prefix(F.lit(depth)).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        sums = (
            deepest.select("b", "n", "cell", F.explode(F.array(*map(F.lit, levels))).alias("depth"))
            .groupBy("depth", F.call_function("shiftright", "cell", F.lit(depth) - F.col("depth")).alias("prefix"))
            .agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
        cells = stage(sums.withColumn("fits", fits), "shard-directory")
        # A leaf fits and the bucket it was split from does not.
        parents = cells.where("not fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        split = cells.withColumn("parent", F.call_function("shiftright", "prefix", F.lit(1))).join(parents, ["depth", "parent"], "left_semi").select(cells.columns)
        directory = cells.where(F.col("depth") == levels[0]).unionByName(split.where(F.col("depth") > levels[0]))
        leaves = directory.where("fits").select("depth", "prefix", "shard_bytes", "shard_rows")
        addressed = open_rows.withColumn("depth", F.explode(F.array(*map(F.lit, levels)))).withColumn("prefix", prefix(F.col("depth")))
        done.append(addressed.join(leaves, ["depth", "prefix"]).withColumn("piece", F.lit(0).cast("long")))
        over = directory.where((F.col("depth") == depth) & ~F.col("fits")).select(F.col("prefix").alias("cell"))
        left = open_rows.withColumn("cell", prefix(F.lit(depth))).join(over, "cell", "left_semi").select("id", "n_bytes", "hash", "row")
        open_rows = stage(left, "shard-open")
        if open_rows.isEmpty():
            break
    else:
        # Rows with equal hashes: cut by running bytes, summed per block of rows as they were read.
        block = F.shiftright("row", 33)
        large = F.col("n_bytes") * 2 > limit
        up = lambda column, window: F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sized = open_rows.withColumns({"block": block, "large": large.cast("long"), "small": F.when(large, 0).otherwise(F.col("n_bytes"))})
        blocks = sized.groupBy("hash", "block").agg(F.sum("small").alias("small"), F.sum("large").alias("large"), F.max("small").alias("most"))
        whole, run = Window.partitionBy("hash"), Window.partitionBy("hash").orderBy("block")
        starts = blocks.select(
            "hash", "block", up("small", run).alias("start"), up("large", run).alias("large_start"),
            F.sum("large").over(whole).alias("n_large"), F.max("most").over(whole).alias("most"),
        )
        run = Window.partitionBy("hash", "block").orderBy("row")
        inside = sized.withColumns({"before": up("small", run), "large_before": up("large", run)})
        # Rows that start within a stretch shorter than the limit by the largest of them end within the limit.
        stretch = F.floor((F.col("before") + F.col("start")) / (F.lit(limit + 1) - F.col("most")))
        piece = F.when(F.col("large") == 1, F.col("large_before") + F.col("large_start")).otherwise(F.col("n_large") + stretch)
        cut = inside.join(starts, ["hash", "block"]).select(
            "id", "n_bytes", "hash", "row", F.lit(BITS).alias("depth"), F.col("hash").alias("prefix"), piece.alias("piece")
        )
        total = cut.groupBy("prefix", "piece").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
        done.append(cut.join(total, ["prefix", "piece"]))
    return reduce(DataFrame.unionByName, done).select(
        F.col("id").alias(id_col), "n_bytes", F.col("depth").cast("int").alias("depth"), "prefix", "piece", "shard_bytes", "shard_rows"
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Write the rows below ``path``, one folder per shard; returns the directory of shards.

    Identifiers must be unique for this form. No task holds more than the shards it writes.
    """
    placed = stage(shards(docs, id_col, text_col, limit), "shard-places")
    shard = F.concat_ws("-", F.lpad(F.bin("prefix"), F.greatest(F.col("depth"), F.lit(1)), "0"), "piece").alias("shard")
    where = placed.select(F.col(id_col).alias("_shard_id"), shard)
    joined = docs.join(where, docs[id_col].eqNullSafe(where["_shard_id"])).drop("_shard_id")
    joined.repartition("shard").write.partitionBy("shard").parquet(path)
    return placed.groupBy(shard, "depth", "prefix", "piece").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
