"""Target configuration files as a table of ``name`` and ``body``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.json_text import compact, is_json
from docferry.functions.paths import extension, file_name, plain_path
from docferry.functions.yaml_udf import yaml_object
from docferry.sources.listing import scan

KINDS = ("template", "pipeline")


def read_configs(spark: SparkSession, *values: str, kind: str = "template") -> DataFrame:
    """``name`` (file name without its last suffix), ``body`` (JSON text), ``path``, ``error``.

    YAML and strict JSON are read. A pipeline must be one of these by suffix; a template
    of any other suffix is taken as strict JSON. JSON with comments is not supported.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind of configuration: {kind}")
    path = plain_path(F.col("_metadata.file_path"))
    files = scan(spark, list(values), wholetext=True).select(
        F.col("value").alias("text"), path.alias("path"), extension(path).alias("suffix")
    )
    is_yaml = F.coalesce(F.col("suffix").isin("yml", "yaml"), F.lit(False))
    json_suffix = F.coalesce(F.col("suffix") == "json", F.lit(False))
    by_yaml, valid = F.col("by_yaml"), is_json(F.col("text"))
    refused = F.coalesce(F.col("suffix").isin("jsonc", "json5"), F.lit(False)) if kind == "template" else ~json_suffix
    name = F.regexp_replace(file_name(F.col("path")), r"(?<=.)\.[^.]*$", "")
    error = (
        F.when(name == "", f"a {kind} needs a name")
        .when(is_yaml, by_yaml["error"])
        .when(refused, F.concat(F.lit(f"unsupported {kind} suffix: "), F.coalesce("suffix", F.lit("none"))))
        .when(~valid, f"{kind} is not valid JSON")
    )
    body = F.when(is_yaml, by_yaml["doc"]).when(valid, compact(F.col("text")))
    return (
        files.withColumn("by_yaml", yaml_object(F.when(is_yaml, F.col("text"))))
        .withColumn("error", error)
        .select(name.alias("name"), F.when(F.col("error").isNull(), body).alias("body"), "path", "error")
    )
