"""Mixing sources to target weights, with DataFrame operations only.

Each row gets a hash-random key. Rows are range-sorted by source and key, each range of a
source is summed on its own, and the sums of the ranges give every row its exact place in its
source; the source is cut where its budget ends and whole epochs go before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import WORD, stage

#: Weights by place in the order of sources, repeating; a source gives at most so many epochs.
WEIGHTS, EPOCHS = (1.0, 2.0, 3.0), 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame) -> DataFrame:
    """Share the sum of all sizes by weight; no target above ``EPOCHS`` times its source.

    ``totals``: one row per source (``source``, ``source_size``). What lies above a
    limit is shared again by weight: the sources at their limit are those with the lowest
    limit per weight, so one pass in that order finds the level at which the rest stands.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (order % len(WEIGHTS) + 1).cast("int"))
    by_limit = Window.orderBy("per_weight", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(rest)
    return (
        totals.withColumn("ordinal", order)
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * EPOCHS)
        .withColumn("per_weight", F.col("limit") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("rank", F.row_number().over(by_limit))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("per_weight"), F.struct("rank", "level"))).over(everything)["level"])
        .select(
            "source", "source_size", "ordinal",
            F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("limit")), F.col("limit")).cast("double").alias("target"),
        )
    )


def _plan(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    sized = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(text).alias("digest"),
        ).withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string")).cast("binary"))),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = stage(
        source_targets(totals)
        .withColumn("epochs", whole.cast("long"))
        .withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")),
        "mix-targets",
    )
    rows = (
        sized.alias("s")
        .join(targets.alias("p"), F.col("p.source").eqNullSafe(F.col("s.source")))
        .select("id", "digest", "size", "key", "source_size", "target", "epochs", "budget", "ordinal")
    )
    # The last key tells equal rows apart, so that a hot identifier is spread over ranges too.
    order = ["ordinal", "key", "id", "digest", F.monotonically_increasing_id()]
    ranged = stage(rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "mix-ranges")
    # A row's number holds its range of the sort above its place in it.
    ranged = ranged.withColumn("range", F.shiftright("place", 33))
    sums = ranged.groupBy("ordinal", "range").agg(F.sum("size").alias("range_size"))
    upto = Window.partitionBy("ordinal").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("ordinal", "range", F.coalesce(F.sum("range_size").over(upto), F.lit(0)).alias("start"))
    inside = Window.partitionBy("ordinal", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["ordinal", "range"])
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("before") - F.col("start")))
    return placed.withColumn("taken", F.col("epochs") * F.col("size") + last)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = "mix") -> DataFrame:
    """For every row: ``size``, ``source_size``, ``target`` of its source, and ``taken``.

    ``taken`` counts the words the mix takes of the row: its size for each whole epoch, and
    in the last epoch all, none or, for the one row at the cut, a part. Sizes count words,
    null and empty texts 0. A null source is a source of its own and comes last. Rows that
    repeat an identifier are separate rows; an empty table gives no rows. Every run gives the
    same rows.
    """
    plan = _plan(docs, id_col, source_col, text_col, seed)
    return plan.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def take_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", length_col: str = "n_chars", seed: str = "mix") -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``.

    A row comes once for each time all of it is taken; the row at a source's cut comes with
    the words up to the cut. Rows without words come once when their source is used at all.
    Rows that repeat an identifier with the same text share one decision. An empty table gives
    no rows; other columns come through unchanged.
    """
    columns = docs.columns
    plan = (
        _plan(docs, id_col, source_col, text_col, seed)
        .groupBy(F.col("id").alias("_mix_id"), F.col("digest").alias("_mix_digest"))
        .agg(F.max("size").alias("_mix_size"), F.max("taken").alias("_mix_taken"), F.max("target").alias("_mix_target"))
    )
    same = docs[f"`{id_col}`"].eqNullSafe(plan["_mix_id"]) & (F.xxhash64(docs[f"`{text_col}`"]) == plan["_mix_digest"])
    joined = docs.join(plan, same)
    size, taken = F.col("_mix_size"), F.col("_mix_taken")
    whole = F.when(size > 0, F.floor(taken / size)).otherwise(F.when(F.col("_mix_target") > 0, 1).otherwise(0))
    part = F.when(size > 0, taken % size).otherwise(0)
    copies = F.concat(F.array_repeat(size, whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    pieces = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("_mix_words").cast("int")), "")
    shorter = F.col("_mix_words") < size
    out = joined.withColumn("_mix_words", F.explode(copies))
    fields = {
        text_col: F.when(shorter, cut).otherwise(F.col(f"`{text_col}`")),
        **({length_col: F.when(shorter, F.char_length(cut).cast(docs.schema[length_col].dataType)).otherwise(F.col(f"`{length_col}`"))} if length_col in columns else {}),
    }
    return out.select(*(fields.get(c, docs[f"`{c}`"]).alias(c) for c in columns))
