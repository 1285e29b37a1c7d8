"""Where in its file a refused document stands.

Readers give an order inside each file block, which costs nothing. A number counted from the
start of the file needs the blocks before, so it is made for the files that hold an error, and for
no others: each block is counted, and prefix sums over a file's blocks give where a block begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docferry.functions.markup import toon_documents
from docferry.functions.paths import extension, plain_path
from docferry.operators.validate import line_error
from docferry.sources.csv import read_csv_docs
from docferry.sources.envelope import envelope
from docferry.sources.listing import literal_path
from docferry.sources.toon import NOT_TEXT, toon_chunks, toon_files

PLACES_DDL = "path string, line bigint, document bigint, doc string, error string"
#: Files named to the reader; where more hold errors, they are read in groups of so many.
FILES_AT_ONCE = 10_000


def _scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text([literal_path(p) for p in paths], lineSep="\n").select(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def _block_starts(parts: DataFrame, amount: Column) -> DataFrame:
    """What of ``amount`` lies before each block of a file, and the place of the block's first part.

    One row per file block.
    """
    blocks = parts.groupBy("path", "block_start").agg(F.min("pos").alias("first"), F.sum(amount).alias("n"))
    before = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("path", "block_start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path``, ``line`` (from 1) and ``value`` of all lines of the files."""
    lines = _scan(spark, paths)
    starts = F.broadcast(_block_starts(lines, F.lit(1)))
    line = F.col("before") + F.col("pos") - F.col("first") + 1
    return lines.join(starts, ["path", "block_start"]).select("path", line.alias("line"), "value")


def bad_lines(spark: SparkSession, paths: list[str], skip_blank: bool = False) -> DataFrame:
    """The lines that are no JSON object, with their numbers."""
    lines = numbered_lines(spark, paths).withColumn("error", line_error(F.col("value"))).where("error is not null")
    if skip_blank:
        lines = lines.where(~F.col("value").rlike(r"\A\s*\z"))
    return lines.select("path", "line", F.lit(None).cast("bigint").alias("document"), F.col("value").alias("doc"), "error")


def bad_toon_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The TOON documents that are refused, with their numbers (from 1) in their file."""
    files = toon_files(spark.read.text([literal_path(p) for p in paths], lineSep="\n"))
    none = F.lit(None).cast("bigint")
    alone = files.where("header is not null and error is not null")
    found = alone.select("path", none.alias("line"), F.lit(1).cast("bigint").alias("document"), F.lit(None).cast("string").alias("doc"), "error")
    several = [r.path for r in files.where("header is null").select("path").collect()]
    if not several:
        return found
    chunks = toon_chunks(spark.read.text([literal_path(p) for p in several], lineSep="\n"))
    # Documents are counted per block; within a block only their places are sorted.
    blocks = chunks.groupBy("path", "block_start").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(blocks.select("path", "block_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    within = F.row_number().over(Window.partitionBy("path", "block_start").orderBy("pos"))
    places = chunks.select("path", "block_start", "pos", within.alias("within"))
    error = F.when(F.is_valid_utf8("chunk"), toon_documents(F.col("chunk"))["error"]).otherwise(NOT_TEXT)
    bad = chunks.withColumn("error", error).where("error is not null")
    placed = bad.join(starts, ["path", "block_start"]).join(places, ["path", "block_start", "pos"])
    number = (F.col("before") + F.col("within")).cast("bigint")
    return found.unionByName(placed.select("path", none.alias("line"), number.alias("document"), F.col("chunk").alias("doc"), "error"))


def bad_csv_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The CSV records that are refused, with the number of their first line."""
    bad = None
    for path in paths:
        rows = read_csv_docs(spark, literal_path(path)).where("error is not null")
        rows = rows.select("path", F.col("pos").alias("line"), F.lit(None).cast("bigint").alias("document"), "doc", "error")
        bad = rows if bad is None else bad.unionByName(rows)
    return bad


def error_places(documents: DataFrame, kind: str | None = None) -> DataFrame:
    """The refused rows of a reader's documents, each with its place: ``path``, ``line``,
    ``document``, ``doc`` and ``error``.

    ``line`` counts the lines of a file, ``document`` the documents of a TOON file; a file that
    is one document has neither. ``kind`` (``lines``, ``jsonl``, ``csv`` or ``toon``) says how
    the files were read; by default their suffix does, and a ``.json`` file whose only refused row
    is its first counts as one document. One pass finds the files that hold an
    error, and only these are read again.
    """
    spark = documents.sparkSession
    bad = documents.where("error is not null")
    suffix = extension(F.regexp_replace("path", r"(?i)\.gz$", ""))
    by_suffix = (
        F.when(suffix == "ndjson", "lines")
        .when((suffix == "json") & F.col("lines"), "lines")
        .when(suffix == "jsonl", "jsonl")
        .when(suffix.isin("csv", "toon"), suffix)
        .otherwise("whole")
    )
    # A JSON file read whole has one row, at the very start.
    files = bad.groupBy("path").agg(F.max((F.col("block_start") > 0) | (F.col("pos") > 0)).alias("lines"))
    files = files.select("path", (F.lit(kind) if kind else by_suffix).alias("kind"))
    found = spark.createDataFrame([], PLACES_DDL)
    names: dict[str, list[str]] = {}
    for row in files.toLocalIterator():
        names.setdefault(row.kind, []).append(row.path)
    read = {"lines": bad_lines, "jsonl": lambda s, p: bad_lines(s, p, skip_blank=True), "csv": bad_csv_rows, "toon": bad_toon_documents}
    for how, paths in sorted(names.items()):
        for i in range(0, len(paths), FILES_AT_ONCE):
            some = paths[i : i + FILES_AT_ONCE]
            if how == "whole":
                there = bad.join(files.where("kind = 'whole'"), "path", "left_semi") if i == 0 else None
                if there is not None:
                    none = F.lit(None).cast("bigint")
                    found = found.unionByName(there.select("path", none.alias("line"), none.alias("document"), "doc", "error"))
            else:
                found = found.unionByName(read[how](spark, some))
    return found
