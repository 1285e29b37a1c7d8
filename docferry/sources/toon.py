"""TOON files.

Documents stand between ``---`` lines. Files are read by lines in splits, each block is cut at
these lines, and a document over a border of blocks is joined from its pieces. (Reading by the
separator would not do: "---" lines in a row overlap, and a split may begin within them.) A file
that is one table is given row by row instead: its header is a side table of one row
per file, and one aggregate per file settles the declared number and the widths of its rows, so
the table is given whole or refused whole, whatever its size and however it is named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.markup import (
    ROW_WIDTH,
    is_toon_header,
    is_toon_row,
    toon_documents,
    toon_header,
    toon_length,
    toon_row,
    toon_width,
)
from docferry.functions.paths import plain_path
from docferry.session import listing_by_few_tasks, stage
from docferry.sources.blocks import block_runs, byte_lines, gathered, join_pieces
from docferry.sources.envelope import envelope
from docferry.sources.listing import literal_path, scan

_SEPARATOR = r"^[ \t]*---[ \t\r]*$"
NOT_TEXT = "not UTF-8 text"


def _none() -> Column:
    return F.lit(None).cast("string")


def _cut_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block, by the lines between separators; pieces at a block's borders.

    A place is counted in lines of the block.
    """
    names = ["path", "block_start", "pos", "record", "opens", "ends"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]
    block: tuple[str, int] | None = None
    held: list[bytes] = []
    opens, place, first = True, 0, 0

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*found, strict=True)] if found else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        paths, starts, positions, lines, separators = batch.columns
        out = []
        for path, start, lo, hi in block_runs(paths, starts):
            if block != (path, start):
                if block is not None:
                    out.append((*block, place, b"\n".join(held), opens, False))
                # A block goes on with the document before it, unless the file begins here.
                block, held, opens, place, first = (path, start), [], start == 0, 0, positions[lo].as_py()
            values, done = lines.slice(lo, hi - lo).to_pylist(), 0
            for i in np.flatnonzero(separators.slice(lo, hi - lo).to_numpy(zero_copy_only=False)).tolist():
                out.append((*block, place, b"\n".join(held + values[done:i]), opens, True))
                held, opens, place, done = [], True, positions[lo + i].as_py() - first, i + 1
            held += values[done:]
        if out:
            yield rows(out)
    if block is not None:
        yield rows([(*block, place, b"\n".join(held), opens, False)])


def toon_chunks(text: DataFrame) -> DataFrame:
    """``path``, ``block_start``, ``pos`` and ``chunk`` of the documents in a text scan by lines; blank ones are left out."""
    lines = byte_lines(text).withColumn("separates", F.col("value").cast("string").rlike(_SEPARATOR))
    schema = "path string, block_start long, pos long, record binary, opens boolean, ends boolean"
    # Staged, as whole documents and pieces are taken from it apart.
    pieces = stage(lines.mapInArrow(_cut_documents, schema), "toon-pieces")
    whole = pieces.where("opens and ends").select("path", "block_start", "pos", "record")
    documents = whole.unionByName(join_pieces(pieces, F.lit(True)))
    chunk = F.col("record").cast("string")
    return documents.select("path", "block_start", "pos", chunk.alias("chunk")).where(~F.col("chunk").rlike(r"\A\s*\z"))


def toon_results(chunks: DataFrame) -> DataFrame:
    """Envelope rows of the documents in ``chunk``."""
    decoded = toon_documents(F.col("chunk"))
    bad = F.array(F.struct(_none().alias("doc"), decoded["error"].alias("error")))
    good = F.transform(decoded["docs"], lambda d: F.struct(d.alias("doc"), _none().alias("error")))
    not_text = F.array(F.struct(_none().alias("doc"), F.lit(NOT_TEXT).alias("error")))
    results = F.when(~F.is_valid_utf8("chunk"), not_text).when(decoded["error"].isNotNull(), bad).otherwise(good)
    rows = chunks.select("path", "block_start", "pos", F.posexplode(results).alias("at", "_r"))
    # A document's rows follow each other behind its own place; of either there are fewer than 2^31.
    return envelope(rows.withColumn("pos", F.col("pos") * (1 << 31) + F.col("at")), F.col("_r.doc"), F.col("_r.error"))


def _lines(text: DataFrame) -> DataFrame:
    return gathered(text.select(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
        F.regexp_replace("value", "\r$", "").alias("line"),
    ))


def toon_files(text: DataFrame) -> DataFrame:
    """One row per file of a text scan by lines: ``path``; ``header``, where the file is one table; ``error``."""
    line = F.col("line")
    filled, row = ~line.rlike(r"^\s*$"), is_toon_row(line)
    place = F.struct("block_start", "pos")
    found = _lines(text).groupBy("path").agg(
        F.min_by(F.when(filled, line), F.when(filled, place)).alias("header"),
        F.count_if(F.col("value").rlike(_SEPARATOR)).alias("separators"),
        F.count_if(filled & ~row).alias("others"),
        F.count_if(row).alias("rows"),
        F.count_if(~F.is_valid_utf8("value")).alias("not_text"),
        F.min(F.when(row, toon_width(line))).alias("narrowest"),
        F.max(F.when(row, toon_width(line))).alias("widest"),
    )
    header = F.col("header")
    alone = F.is_valid_utf8(header) & is_toon_header(header) & (F.col("separators") == 0)
    width = F.size(toon_header(header))
    error = (
        F.when(F.col("not_text") > 0, NOT_TEXT)
        .when(F.col("others") > 1, "unsupported block")
        .when(F.col("rows") == 0, "no rows")
        .when(F.col("rows") != toon_length(header), "declared length differs")
        .when((F.col("narrowest") != width) | (F.col("widest") != width), ROW_WIDTH)
    )
    return found.select("path", F.when(alone, header).alias("header"), F.when(alone, error).alias("error"))


def toon_envelope(spark: SparkSession, text: DataFrame) -> DataFrame:
    """Envelope rows of all files of a text scan by lines."""
    files = stage(toon_files(text), "toon-files")
    is_table = "header is not null and error is null"
    n = files.agg(F.count("*").alias("all"), F.count_if(F.col("header").isNull()).alias("several"), F.count_if(F.expr(is_table)).alias("tables")).first()

    def lines_of(which: str) -> DataFrame:
        # Spark's own listing holds one entry for each file on the driver; so does this list.
        paths = [literal_path(r.path) for r in files.where(which).select("path").collect()]
        with listing_by_few_tasks(spark):
            return spark.read.text(paths, lineSep="\n")

    place = F.lit(0).cast("long")
    refused = files.where("header is not null and error is not null").select("path", "error", place.alias("block_start"), place.alias("pos"))
    parts = [envelope(refused, _none(), F.col("error"))]
    if n["several"]:
        parts.append(toon_results(toon_chunks(text if n["several"] == n["all"] else lines_of("header is null"))))
    if n["tables"]:
        # Where most files are tables the others are read too, and fall out in the join: no file is listed again.
        rows = _lines(text if 2 * n["tables"] > n["all"] else lines_of(is_table)).where(is_toon_row(F.col("line")))
        headers = files.where(is_table).select("path", "header")
        doc = toon_row(toon_header(F.col("header")), F.col("line"))
        parts.append(envelope(rows.join(headers, "path").withColumn("doc", doc), F.col("doc"), _none()))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def read_toon(spark: SparkSession, values: list[str]) -> DataFrame:
    """Documents of the TOON files the inputs name."""
    return toon_envelope(spark, scan(spark, values, lineSep="\n"))
