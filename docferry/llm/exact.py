"""Exact duplicates by a distributed content sort.

Rows are range-partitioned by (normalised text, identifier) with sampled splitters, of which
long texts give their beginning and a hash, and sorted outside memory, so equal texts are
neighbours. Each task walks its sorted rows once
and compares neighbours in full. As the identifier is part of the range, a group that
holds a third of all rows is spread over many tasks; its pieces are put together from the
first and last run of every partition, which are two records per partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.llm.common import lower_ascii, stage

#: Letters of a text that range splitters see.
HEAD = 48
PLAN = "part int, run long, first boolean, size long, sha string, edge binary"


def _walk(columns: list[str], schema: pa.Schema, all_rows: bool):
    """Cut sorted rows into runs of equal text.

    A run's rows come with identifiers descending, so its first row is the one that stays.
    With ``all_rows`` only the identifiers of the open run are held, else only its first row.
    The first and last run of a partition carry their text (``edge``).
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run, text, size = -1, None, 0
        held: list[tuple] = []  # rows of the open run
        out: list[tuple] = []

        def close(last: bool):
            if run < 0:
                return
            sha = hashlib.sha256(text).hexdigest()
            edge = text if run == 0 or last else None
            for i, row in enumerate(held):
                out.append((*row, part, run, i == 0, size, sha, edge if i == 0 else None))

        def flush():
            cols = list(zip(*out, strict=True)) if out else [[] for _ in schema]
            arrays = [pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_docferry_text"))
            rows = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)
            for value, row in zip(texts, rows, strict=True):
                value = value.as_py().lower()
                if run < 0 or value != text:
                    close(False)
                    run, text, size, held = run + 1, value, 0, []
                size += 1
                if all_rows or size == 1:
                    held.append(row)
                if len(out) >= 2000:
                    yield flush()
        close(True)
        yield flush()

    return walk


def sorted_runs(docs: DataFrame, id_col: str, text_col: str, columns: list[str], all_rows: bool) -> DataFrame:
    """One row per document (or per run) with its run, after joining runs across partitions.

    Behind ``columns`` come ``_docferry_keep``, ``_docferry_size``, ``_docferry_kept`` and ``_docferry_sha``.
    """
    inner = {c: f"_docferry_c{i}" for i, c in enumerate(dict.fromkeys([*columns, id_col]))}
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*(F.col(f"`{c}`").alias(v) for c, v in inner.items()), text.alias("_docferry_t"))
    key = F.col(inner[id_col])
    norm = lower_ascii(F.col("_docferry_t"))
    # Splitters are samples of the first letters and a hash of the rest, so that what the driver
    # sees of a text is bounded. The sort value is made after the exchange: each text is sent once.
    ranged = (
        rows.repartitionByRange(F.substring(norm, 1, HEAD), F.xxhash64(norm), key.desc())
        .withColumn("_docferry_norm", norm)
        .withColumn("_docferry_head", F.substring("_docferry_norm", 1, HEAD))
        .withColumn("_docferry_hash", F.xxhash64("_docferry_norm"))
        .sortWithinPartitions("_docferry_head", "_docferry_hash", "_docferry_norm", key.desc())
        .select(*inner.values(), F.col("_docferry_t").cast("binary").alias("_docferry_text"))
    )
    plan = T.StructType([*(f for f in ranged.schema if f.name != "_docferry_text"), *T._parse_datatype_string(PLAN)])
    from pyspark.sql.pandas.types import to_arrow_schema

    walk = _walk(list(inner.values()), to_arrow_schema(plan), all_rows)
    runs = stage(ranged.mapInArrow(walk, plan), "exact-runs")

    edges = runs.where("edge is not null").select("edge", "part", "run", "size", key.alias("keep_id"))
    best = F.max(F.struct("keep_id", (-F.col("part")).alias("p"), (-F.col("run")).alias("r")))
    whole = edges.groupBy("edge").agg(F.count("*").alias("n"), F.sum("size").alias("all"), best.alias("best"))
    # Runs that go over a border: at most two per partition, however many rows they hold.
    over = stage(
        edges.select("edge", "part", "run")
        .join(whole.where("n > 1"), "edge")
        .select(
            "part", "run", "all", F.col("best.keep_id").alias("all_keep"),
            ((F.col("part") == -F.col("best.p")) & (F.col("run") == -F.col("best.r"))).alias("wins"),
        ),
        "exact-borders",
    )
    heads = runs.where("first").select("part", "run", key.alias("run_keep")) if all_rows else None
    joined = runs.join(over, ["part", "run"], "left")
    if heads is not None:
        joined = joined.join(heads, ["part", "run"])
    local = F.col("run_keep") if heads is not None else key
    return joined.select(
        *(F.col(v).alias(c) for c, v in inner.items() if c in columns),
        F.when(F.col("all").isNull(), local).otherwise(F.col("all_keep")).alias("_docferry_keep"),
        F.coalesce("all", "size").alias("_docferry_size"),
        (F.col("first") & F.coalesce("wins", F.lit(True))).alias("_docferry_kept"),
        F.col("sha").alias("_docferry_sha"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: its identifier, the row that stays, its group's size, and the text's SHA-256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row
    with the largest identifier stays (null counts as smallest); of rows that repeat one
    identifier and text, one stays. An empty table gives an empty result.
    """
    return sorted_runs(docs, id_col, text_col, [id_col], True).toDF(id_col, "keep_id", "group_size", "kept", "text_sha256")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns unchanged."""
    out = sorted_runs(docs, id_col, text_col, docs.columns, False)
    return out.where("_docferry_kept").select(*(f"`{c}`" for c in docs.columns))
