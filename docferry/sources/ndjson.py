"""Line-delimited JSON."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.json_text import compact, trim_json
from docferry.functions.paths import plain_path
from docferry.operators.validate import line_error
from docferry.sources.blocks import byte_lines
from docferry.sources.envelope import envelope
from docferry.sources.listing import literal_path, local_form


def _lines(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
    )


def line_documents(text: DataFrame, skip_blank: bool = False) -> DataFrame:
    """Envelope rows from a text scan of lines, document text unchanged."""
    value = F.col("value")
    error = line_error(value)
    if skip_blank:
        filled = ~value.rlike(r"\A\s*\z")
        text = text.where(filled)
        # Spark may evaluate the rule before the filter: it must not call a blank line wrong.
        error = F.when(filled, error)
    return envelope(_lines(text), trim_json(value), error)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line; plain files are split, ``.gz`` files are read whole.

    A file whose first line is just ``{`` holds one pretty-printed document, which is put on
    one line; each file of a folder is read by its own first line. A blank line is an error.
    """
    # Only "\n" ends a line: the default would also cut at a bare carriage return.
    text = spark.read.option("lineSep", "\n").text(local_form(path))
    pretty = pretty_files(spark, text)
    if not pretty:
        return line_documents(text)
    whole = _lines(spark.read.text([literal_path(p) for p in pretty], wholetext=True))
    error = line_error(F.col("value"))
    documents = envelope(whole, F.when(error.isNull(), compact(F.col("value"))).otherwise(F.col("value")), error)
    # A condition on the file alone, so the files read whole are not read by lines too.
    others = text.where(~plain_path(F.col("_metadata.file_path")).isin(pretty))
    return line_documents(others).unionByName(documents)


def pretty_files(spark: SparkSession, text: DataFrame) -> list[str]:
    """The files of a text scan whose first line is ``{``.

    Every file is one task that looks at its head and stops. Such files are read whole, so
    there is one entry on the driver for each, as in Spark's own listing.
    """
    own = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, str(1 << 40))
    files = text.inputFiles()
    if not files:
        return []
    heads = byte_lines(own.read.text([literal_path(unquote(f)) for f in files], lineSep="\n")).select("path", "value")
    return [r.path for r in heads.mapInArrow(_head, "path string, value binary").where(F.col("value") == F.lit(b"{")).select("path").collect()]


def _head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file, trimmed."""
    for batch in batches:
        if batch.num_rows:
            line = batch.column(1)[0].as_py().strip(b" \t\r\n")
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(0, 1), pa.array([line], pa.binary())], names=["path", "value"])
            return
