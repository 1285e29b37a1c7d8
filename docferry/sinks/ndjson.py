"""NDJSON output: one raw document per line."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.operators.validate import enforce


class OutputError(ValueError):
    """The output cannot take these documents."""


def check_output(path: str, n_inputs: int = 1) -> None:
    """Compressed output must end in ``.ndjson.gz``; several inputs need an NDJSON output."""
    low = path.lower()
    if low.endswith(".gz") and not low.endswith(".ndjson.gz"):
        raise OutputError(f"cannot write this kind of compressed file: {path}")
    if n_inputs > 1 and not re.search(r"\.ndjson(\.gz)?$", low):
        raise OutputError("several inputs need an output path ending in .ndjson or .ndjson.gz")


def write_ndjson(df: DataFrame, path: str, errors: str = "failfast") -> None:
    """Write ``doc`` as text lines, replacing what is at ``path``.

    The result is a folder of part files, gzip-compressed when ``path`` ends in
    ``.ndjson.gz``. Spark commits it only when every task has succeeded.
    """
    check_output(path)
    good = enforce(df, errors) if "error" in df.columns else df
    compression = "gzip" if path.lower().endswith(".gz") else "none"
    good.select(F.col("doc").alias("value")).write.mode("overwrite").text(
        path, compression=compression, lineSep="\n"
    )
