"""Approximate nearest neighbours by cross-polytope hashing with multiprobe and exact reranking.

Each table turns unit vectors by three rounds of random signs and a fast Hadamard transform;
the nearest signed axis is the bucket. A query looks into the buckets of its nearest axes in
every table. Large buckets are dealt out to blocks of bounded size, and the queries of a bucket
too; each block of queries visits the blocks of items one by one, which give their best few by
the exact cosine, and the best of all remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import stage

TABLES, PROBES, BLOCK_ROWS, QUERY_ROWS, SEED = 4, 24, 4096, 2048, 3


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def axes(x: np.ndarray, table: int) -> np.ndarray:
    """How near each row of ``x`` is to the signed axes of a table: (rows, 2 * size)."""
    n, dim = x.shape
    size = 1 << max(0, (dim - 1).bit_length())
    draw = np.random.default_rng([SEED, table, size])
    y = np.zeros((n, size))
    y[:, :dim] = x
    for _ in range(3):
        y = _hadamard(y * draw.choice([-1.0, 1.0], size))
    return np.concatenate((y, -y), 1)


def unit_scale(x: np.ndarray) -> np.ndarray:
    """Rows with their largest component brought to about 1 by a power of two, which rounds nothing."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def _batches(batch: pa.RecordBatch):
    """(rows, matrix) of each length of vector in a batch of (row, id, vector)."""
    vectors = batch.column(2)
    length = np.diff(vectors.offsets.to_numpy())
    for dim in np.unique(length):
        at = np.flatnonzero(length == dim)
        flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, flat.astype(np.float64).reshape(-1, dim)


def _bucketed(tables: int, probes: int):
    """(row, id, vector) to one row for each table and bucket; ``probes`` nearest axes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _batches(batch):
                x = unit_scale(x)
                for t in range(tables):
                    near = axes(x, t)
                    k = min(probes, near.shape[1])
                    best = np.argsort(-near, 1, kind="stable")[:, :k].ravel()
                    rows = batch.take(pa.array(np.repeat(at, k)))
                    n = len(best)
                    extra = [np.full(n, x.shape[1], np.int32), np.full(n, t, np.int32), best.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *map(pa.array, extra)], names=[*rows.schema.names, "dim", "tab", "bucket"])

    return run


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    return unit_scale(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1))


def _best(k: int):
    """The ``k`` nearest ids of a block for each query: exact cosines, ties to the smaller id."""

    def run(key, members: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if members.num_rows and queries.num_rows:
            m, ids = _matrix(members), members.column("id").to_numpy()
            # Rows that repeat an id lie side by side, and the best of them stands for the id.
            order = np.argsort(ids, kind="stable")
            m, ids = m[order], ids[order]
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            repeated, ids = len(first) < len(ids), ids[first]
            size = np.sqrt((m * m).sum(1))
            found = []
            for q, qid in zip(_matrix(queries), queries.column("id").to_numpy(), strict=True):
                # Summed row by row in one order, so equal vectors get equal scores.
                s = (m * q).sum(1) / (size * np.sqrt((q * q).sum()))
                if repeated:
                    s = np.maximum.reduceat(s, first)
                s = np.where(ids == qid, -np.inf, s)
                floor = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
                near = np.flatnonzero((s >= floor) & (s > -np.inf))
                near = near[np.lexsort((ids[near], -s[near]))][:k]
                found.append((np.full(len(near), qid), ids[near], s[near]))
            out = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table({"query_id": out[0], "vec_id": out[1], "score": out[2]})

    return run


def usable(vector: F.Column) -> F.Column:
    """No null, not empty, only finite components, not all zero."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine & F.exists(vector, lambda c: c != 0), F.lit(False))


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """The ``k`` nearest found for each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Score is the cosine in double precision; ties go to the smaller id. A query does not
    find its own id. Vectors that are null, zero, or hold null or non-finite components take
    no part, nor do null ids; vectors meet vectors of their own length. Rows that repeat an
    id are one item, as near as its nearest vector. A query that meets fewer than ``k``
    candidates is compared with all vectors of its length, block by block. Without vectors or
    queries there are no rows.
    """

    def prepared(df: DataFrame) -> DataFrame:
        v = F.col(f"`{vector_col}`").cast("array<double>")
        picked = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vector"))
        return picked.where(usable(F.col("vector")) & F.col("id").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "id", "vector")

    schema = "row long, id long, vector array<double>, dim int, tab int, bucket int"
    items = stage(prepared(vectors).mapInArrow(_bucketed(tables, 1), schema).withColumn("vector", F.col("vector").cast("array<double>")), "ann-index")
    asked = stage(prepared(queries), "ann-queries")
    place = ["dim", "tab", "bucket"]
    blocks = items.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    members = items.join(blocks, place).withColumn("block", F.pmod("row", F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")

    def meet(probed: DataFrame) -> DataFrame:
        # Queries of a bucket are dealt to blocks too; a block of items meets each of these.
        loads = probed.groupBy(*place).agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("loads"))
        dealt = F.pmod("row", F.col("loads")).cast("int").alias("load")
        visits = probed.join(blocks, place).join(loads, place).select("id", "vector", *place, every, dealt)
        faced = members.join(loads, place).withColumn("load", F.explode(F.sequence(F.lit(0), F.col("loads") - 1)))
        keys = [*place, "block", "load"]
        found = faced.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(_best(k), "query_id long, vec_id long, score double")
        each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = stage(meet(asked.mapInArrow(_bucketed(tables, probes), schema)), "ann-found")
    short = asked.select("id").distinct().join(first.groupBy("query_id").count().where(F.col("count") == k), F.col("id") == F.col("query_id"), "left_anti")
    rest = asked.join(short, "id", "left_semi").withColumn("dim", F.size("vector"))
    everywhere = rest.join(blocks.where("tab = 0").select(*place), "dim")
    out = first
    if not rest.isEmpty():
        again = meet(everywhere.select("row", "id", "vector", *(F.col(c).alias(c) for c in place)))
        out = first.join(short, first["query_id"] == short["id"], "left_anti").unionByName(again)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
