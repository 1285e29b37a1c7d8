"""A whole load: inputs, checks, output, summary."""

from __future__ import annotations

import time
import warnings
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docferry.functions.patterns import template_match
from docferry.operators.account import run_summary
from docferry.operators.batch import DEFAULT_MAX_REQUESTS
from docferry.operators.target import TargetOptions, check_targets
from docferry.session import configure, scratch_dir
from docferry.sinks.bulk import BulkTarget, write_bulk
from docferry.sinks.ndjson import OutputError, check_output, write_ndjson
from docferry.sources.files import read_documents
from docferry.sources.places import error_places


def load_to_ndjson(
    spark: SparkSession,
    inputs: list[str],
    output: str,
    field: str = "body",
    options: TargetOptions | None = None,
    errors: str = "failfast",
    refused_path: str | None = None,
) -> int:
    """Copy the documents of the inputs to an NDJSON data set; give the number written.

    With ``errors="keep"`` refused documents go to ``refused_path``, where one is given.
    """
    if options is not None and options.given:
        raise OutputError("pipeline and template options need a search cluster as output")
    check_output(output, len(inputs))
    documents = read_documents(configure(spark), *inputs, field=field)
    seen, good = Observation("documents"), F.col("error").isNull()
    counted = documents.observe(seen, F.count_if(good).alias("n"), F.count_if(~good).alias("n_bad"))
    write_ndjson(counted, output, errors)
    # Read again only where something was refused; then each refusal gets its place.
    if refused_path is not None and seen.get["n_bad"]:
        error_places(documents).write.mode("overwrite").parquet(refused_path)
    return seen.get["n"]


def load_to_bulk(
    spark: SparkSession,
    inputs: list[str],
    target: BulkTarget,
    replies_path: str | None = None,
    field: str = "body",
    action: str = "create",
    max_requests: int | None = DEFAULT_MAX_REQUESTS,
    errors: str = "failfast",
    refused_path: str | None = None,
    options: TargetOptions | None = None,
    known_pipelines: DataFrame | None = None,
) -> DataFrame:
    """Send the documents of the inputs; give the one-row summary, with elapsed ``seconds``.

    ``n_read`` is the number of documents read and ``n_refused`` of those not sent. With
    ``errors="keep"`` what the readers refused goes to ``refused_path``, where one is given.
    ``options``, held against ``known_pipelines``, are checked before any input is read, and
    say which pipeline the requests name.
    """
    start = time.monotonic()
    if options is not None:
        if known_pipelines is None:
            known_pipelines = spark.createDataFrame([], "name string")
        for warning in check_target(spark, target.index, options, known_pipelines):
            warnings.warn(warning, stacklevel=2)
        target = replace(target, pipeline=options.request_pipeline)
    documents = read_documents(configure(spark), *inputs, field=field)
    seen = Observation("documents")
    counted = documents.observe(seen, F.count(F.lit(1)).alias("n"))
    replies = write_bulk(
        counted, target, replies_path or scratch_dir(spark, "replies"), action, max_requests, errors, refused_path=refused_path
    )
    n_read = F.lit(seen.get["n"]).cast("long")
    return run_summary(replies).select(
        n_read.alias("n_read"),
        (n_read - F.col("n_docs")).alias("n_refused"),
        "*",
        F.lit(round(time.monotonic() - start, 3)).alias("seconds"),
    )


def check_target(spark: SparkSession, index: str, options: TargetOptions, known_pipelines: DataFrame) -> list[str]:
    """Preflight of one target: raise on a broken rule, return warnings.

    A pattern list that does not match, or cannot be checked, is only a warning.
    """
    row = (
        index, options.template_name, options.template_body, options.pipeline_name, options.pipeline_body is not None,
    )
    target = spark.createDataFrame(
        [row], "index string, template_name string, template_body string, pipeline_name string, has_pipeline boolean"
    )
    found = (
        check_targets(target, known_pipelines)
        .withColumn("m", template_match(F.col("template_body"), F.col("index")))
        .first()
    )
    if found["status"] != "ok":
        raise ValueError(f"target {index}: {found['status']}")
    if options.template_body is None or found["m"]["matched"]:
        return []
    reason = found["m"]["error"] or "no pattern matches"
    return [f"template patterns and target '{index}': {reason}"]
