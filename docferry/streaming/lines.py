"""Line streams in, bulk requests or NDJSON out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from docferry.functions.json_text import trim_json
from docferry.functions.paths import file_name, plain_path
from docferry.operators.validate import line_error
from docferry.sinks.bulk import BulkTarget, write_bulk
from docferry.sinks.ledger import PARCEL_DOCS
from docferry.sinks.ndjson import check_output
from docferry.operators.validate import enforce


def stream_ndjson(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New files of a folder as an endless stream of documents, one per line.

    ``max_files`` bounds a micro-batch. There is no pretty-printed form in a stream.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = plain_path(F.col("_metadata.file_path"))
    return reader.text(folder).select(
        trim_json(F.col("value")).alias("doc"),
        path.alias("path"),
        file_name(path).alias("name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        line_error(F.col("value")).alias("error"),
    )


def stream_bulk(
    stream: DataFrame,
    target: BulkTarget,
    replies_path: str,
    checkpoint: str,
    action: str = "create",
    max_requests: int | None = None,
    errors: str = "failfast",
    parcel_docs: int = PARCEL_DOCS,
) -> DataStreamWriter:
    """Send each micro-batch. The next one starts when this one is settled, so a slow
    target slows the source.

    Each micro-batch has a ledger below ``checkpoint``: one that is repeated, as after a lost
    driver, takes up its parcels and sends only those that have no reply. ``failfast`` is the
    gate of each micro-batch here: a bad document stops the stream before its micro-batch is
    sent, so a restart does not send that one again."""
    mode = "gate" if errors == "failfast" else errors

    def send(batch: DataFrame, batch_id: int) -> None:
        limit = max_requests or batch.sparkSession.sparkContext.defaultParallelism
        write_bulk(batch, target, f"{replies_path}/batch={batch_id}", action, limit, mode, ledger=f"{checkpoint}/ledger/{batch_id}", parcel_docs=parcel_docs)

    return stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)


def stream_to_ndjson(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append the documents of a stream to a folder of NDJSON files."""
    check_output(path)
    return (
        enforce(stream)
        .select(F.col("doc").alias("value"))
        .writeStream.format("text")
        .option("path", path)
        .option("compression", "gzip" if path.lower().endswith(".gz") else "none")
        .option("checkpointLocation", checkpoint)
    )
