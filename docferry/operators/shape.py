"""Row-multiplying document operators."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.markup import split_chunks, toon_documents


def split_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per non-blank chunk between ``---`` lines, with 1-based ``idx`` and ``chunk``."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(split_chunks(F.col(text))).alias("idx", "chunk")).withColumn(
        "idx", F.col("idx") + 1
    )


# How a document looks whose first value is an array.
_FIRST_IS_ARRAY = r'^\s*\{\s*"(?:[^"\\]|\\.)*+"\s*:\s*\['
_HEAD = re.compile(r'\s*\{\s*"(?:[^"\\]|\\.)*"\s*:\s*\[\s*')
_NEXT = re.compile(r"\s*(?:(,)\s*|\](\s*\}\s*\Z)?)")


def element_texts(doc: str | None, scan: Callable[[str, int], tuple[object, int]]) -> list[tuple[str, bool]] | None:
    """The texts of the elements of the only value of an object, and whether each is an object.

    Texts are slices of the document, so numbers and the order of keys stay as they are
    spelt. None for a document whose only value is no array. ``scan`` reads one JSON value from
    a place on and tells where it ends.
    """
    head = _HEAD.match(doc) if doc is not None else None
    if head is None:
        return None
    at, out = head.end(), []
    while True:
        if doc[at] != "]" or out:
            value, end = scan(doc, at)
            out.append((doc[at:end], isinstance(value, dict)))
            at = end
        step = _NEXT.match(doc, at)
        if step[1]:
            at = step.end()
        else:
            return out if step[2] is not None else None


_ELEMENTS = T.ArrayType(T.StructType([T.StructField("doc", T.StringType()), T.StructField("object", T.BooleanType())]))


@F.pandas_udf(_ELEMENTS)
def _elements(docs: pd.Series) -> pd.Series:
    scan = json.JSONDecoder(parse_int=str, parse_float=str, parse_constant=str).raw_decode
    return docs.map(lambda doc: element_texts(doc, scan))


def explode_rows(df: DataFrame, doc: str = "doc") -> DataFrame:
    """A document whose only value is an array becomes one document per element.

    Other documents stay as they are, and elements keep their text. Adds ``row`` (place in
    the array) and ``error`` when the array is empty or an element is no object. Documents
    are strict JSON, as the readers check.
    """
    others = [c for c in df.columns if c not in (doc, "error")]
    none = F.lit(None).cast("string")
    earlier = F.col("error") if "error" in df.columns else none
    # A cheap look first: only documents that begin with an array go to Python, as Arrow batches.
    elements = _elements(F.when(F.rlike(F.col(doc), F.lit(_FIRST_IS_ARRAY)), F.col(doc)))
    whole = F.array(F.struct(F.col(doc).alias("doc"), none.alias("error")))
    empty = F.array(F.struct(F.col(doc).alias("doc"), F.lit("no rows").alias("error")))
    each = F.transform("_elements", lambda e: F.struct(e["doc"].alias("doc"), F.when(~e["object"], "row is not an object").alias("error")))
    rows = F.when(F.col("_elements").isNull(), whole).when(F.size("_elements") == 0, empty).otherwise(each)
    return (
        df.withColumn("_elements", elements)
        .select(*others, earlier.alias("_e"), F.posexplode(rows).alias("row", "_r"))
        .select(*others, "row", F.col("_r.doc").alias(doc), F.coalesce("_e", "_r.error").alias("error"))
    )


def toon_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """Decode TOON text: ``idx`` (1-based document), ``row``, ``doc`` and ``error``."""
    others = [c for c in df.columns if c != text]
    decoded = split_documents(df, text).withColumn("_t", toon_documents(F.col("chunk")))
    # A document in error still gives one row, so that it can be reported.
    return decoded.select(*others, "idx", F.posexplode_outer("_t.docs").alias("row", "doc"), F.col("_t.error").alias("error"))
