"""The one shape every source returns.

doc STRING          JSON object text, JSON white space trimmed at both ends
path STRING         source file
name STRING         last path segment
block_start BIGINT  first byte of the file block the row was read from, 0 for whole files
pos BIGINT          order inside (path, block_start)
error STRING        null when valid, else the rule the document breaks
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.functions.paths import file_name

ENVELOPE_DDL = "doc string, path string, name string, block_start bigint, pos bigint, error string"
COLUMNS = ["doc", "path", "name", "block_start", "pos", "error"]


def envelope(df: DataFrame, doc: Column, error: Column, path="path", block_start="block_start", pos="pos") -> DataFrame:
    return df.select(
        doc.alias("doc"),
        F.col(path).alias("path"),
        file_name(F.col(path)).alias("name"),
        F.col(block_start).cast("bigint").alias("block_start"),
        F.col(pos).cast("bigint").alias("pos"),
        error.alias("error"),
    )
