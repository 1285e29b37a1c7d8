"""Validation of document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.functions.json_text import is_json, is_json_object, json_map, trim_json

GATE_MESSAGE = "JSON payload is not one JSON object per line"


class DocumentError(ValueError):
    """A document broke a rule and the load asked to stop on that."""


def line_error(doc: Column) -> Column:
    """Name of the rule a line breaks, null when it is one strict JSON object."""
    which = (
        F.when(~F.is_valid_utf8(doc), "invalid UTF-8")
        .when(trim_json(doc) == "", "blank line")
        .when(~is_json(doc), "invalid JSON")
        .otherwise("not a JSON object")
    )
    # Good documents, nearly all of them, take the cheap check only.
    return F.when(~(F.is_valid_utf8(doc) & is_json_object(doc)), which)


def check_documents(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Set ``error`` from the line rules, keeping any error already there."""
    error = line_error(F.col(doc))
    if "error" in df.columns:
        error = F.coalesce(F.col("error"), error)
    return df.withColumn("error", error)


def objects_gate(df: DataFrame, doc: str = "doc") -> DataFrame:
    """One row: documents seen (``n``) and documents that are no JSON object (``n_bad``)."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~is_json_object(F.col(doc))).alias("n_bad"))


def require_all_objects(df: DataFrame, doc: str = "doc") -> None:
    """Refuse the whole data set, before any output, if one line is no JSON object."""
    if objects_gate(df, doc).first()["n_bad"]:
        raise DocumentError(GATE_MESSAGE)


def first_error(df: DataFrame) -> DataFrame:
    """One row: number of documents in error and the first of them in reading order."""
    places = [c for c in ("path", "block_start", "pos") if c in df.columns]
    order = F.struct(*places, "error")
    bad = F.col("error").isNotNull()
    return df.where(bad).agg(
        F.count(F.lit(1)).alias("n_bad"),
        F.min_by(F.struct(*[c for c in places if c != "block_start"], "error"), order).alias("first"),
    )


def enforce(df: DataFrame, mode: str = "failfast") -> DataFrame:
    """Apply the error policy and drop the ``error`` column.

    ``failfast``: the job fails on the first bad row it meets; one pass. A file sink then
    commits nothing. ``gate``: one pass over everything before any output, then pass
    through. ``keep``: keep good documents only; take the others with ``rejected``.
    """
    if mode == "failfast":
        message = F.concat_ws(": ", *[F.col(c) for c in ("path", "error") if c in df.columns])
        # Part of the document column itself, so no plan can drop the check as unused.
        checked = F.when(F.col("error").isNull(), F.col("doc")).otherwise(F.raise_error(message))
        return df.withColumn("doc", checked).drop("error")
    if mode == "gate":
        found = first_error(df).first()
        if found["n_bad"]:
            first = found["first"].asDict()
            where = f"{first['path']}: " if "path" in first else ""
            raise DocumentError(f"{where}{first['error']} ({found['n_bad']} in error)")
        return df.drop("error")
    if mode == "keep":
        return df.where(F.col("error").isNull()).drop("error")
    raise ValueError(f"unknown error mode: {mode}")


def error_totals(df: DataFrame) -> list[Column]:
    """``n_bad`` and ``first``, the text of the first error in reading order, for an Observation."""
    bad = F.col("error").isNotNull()
    text = F.when(bad, F.concat_ws(": ", *[F.col(c) for c in ("path", "error") if c in df.columns]))
    # Good documents, nearly all of them, build neither the text nor the place.
    place = F.when(bad, F.struct(*[F.col(c) for c in ("path", "block_start", "pos") if c in df.columns], "error"))
    return [F.count_if(bad).alias("n_bad"), F.min_by(text, place).alias("first")]


def rejected(df: DataFrame) -> DataFrame:
    """The documents in error, for a quarantine table."""
    return df.where(F.col("error").isNotNull())


def with_update_id(df: DataFrame, doc: str = "doc", validated: bool = False) -> DataFrame:
    """Split ``_id`` off each document for an update.

    Adds ``id``, replaces ``doc`` by the rest, and sets ``error`` when the document is no
    object, has no ``_id``, or its ``_id`` is no string. ``validated`` says that every
    document is known to be a JSON object, which saves one parse.
    """
    fields = F.col("_fields")
    id_value = F.try_element_at(fields, F.lit("_id"))
    is_text = F.schema_of_variant(id_value) == "STRING"
    error = (
        F.when(fields.isNull() if validated else fields.isNull() | ~is_json_object(F.col(doc)), "not a JSON object")
        .when(~F.map_contains_key(fields, "_id"), "_id is missing")
        .when(~is_text, "_id is not a string")
    )
    if "error" in df.columns:
        error = F.coalesce(F.col("error"), error)
    rest = F.to_json(F.map_filter(fields, lambda k, _: k != F.lit("_id")))
    return (
        df.withColumn("_fields", json_map(F.col(doc)))
        .withColumn("error", error)
        .withColumn("id", F.when(is_text, F.try_variant_get(id_value, "$", "string")))
        .withColumn(doc, F.when(F.col("error").isNull(), rest).otherwise(F.col(doc)))
        .drop("_fields")
    )
