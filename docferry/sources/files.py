"""Whole files as documents, and the choice of a reader by suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.json_text import (
    add_file_metadata,
    check_content_field,
    compact,
    has_key,
    join_objects,
    root_shape,
    wrap_content,
    wrap_fields,
)
from docferry.functions.markup import split_frontmatter
from docferry.functions.paths import extension, has_glob, plain_path
from docferry.functions.yaml_udf import yaml_object
from docferry.sources.csv import read_csv_docs
from docferry.sources.envelope import COLUMNS, envelope
from docferry.sources.listing import InputError, check_inputs, local_form, scan
from docferry.sources.ndjson import line_documents, read_ndjson
from docferry.sources.toon import read_toon, toon_envelope

LINE_SUFFIXES = ["ndjson", "jsonl"]
MARKDOWN_SUFFIXES = ["md", "markdown"]
YAML_SUFFIXES = ["yml", "yaml"]
TOON_SUFFIXES = ["toon"]
WHOLE_SUFFIXES = ["json", *MARKDOWN_SUFFIXES, *YAML_SUFFIXES]


def _null() -> Column:
    return F.lit(None).cast("string")


def _suffix() -> Column:
    return extension(plain_path(F.col("_metadata.file_path")))


def _is(suffixes: list[str]) -> Column:
    return F.coalesce(_suffix().isin(suffixes), F.lit(False))


def _whole_files(spark: SparkSession, values: list[str]) -> DataFrame:
    """Text scan of whole files; a file is one row, so it must be below 2 GB."""
    return scan(spark, values, wholetext=True)


def _named(files: DataFrame) -> DataFrame:
    """``text``, ``path`` and ``suffix`` of whole files."""
    return files.select(
        F.col("value").alias("text"),
        plain_path(F.col("_metadata.file_path")).alias("path"),
        _suffix().alias("suffix"),
    )


def _result(doc: Column, error: Column) -> Column:
    """The one document of a whole file, or its error."""
    return F.struct(doc.cast("string").alias("doc"), error.cast("string").alias("error"))


def _json_file(text: Column) -> Column:
    shape = root_shape(text)
    error = F.when(shape == "array", "an array where one object should be").when(
        shape != "object", "not one JSON object"
    )
    return _result(F.when(error.isNull(), compact(text)), error)


def _text_file(text: Column, field: str) -> Column:
    return _result(wrap_content(text, field), _null())


def _markdown_file(text: Column, fields: Column, field: str) -> Column:
    parts = split_frontmatter(text)
    content = F.to_json(F.struct(parts["body"].alias(field)))
    error = (
        F.when(parts["front"].isNull(), None)
        .when(fields["error"].isNotNull(), F.concat(F.lit("bad frontmatter: "), fields["error"]))
        .when(has_key(fields["doc"], field), "frontmatter has the content field")
    )
    doc = F.when(parts["front"].isNull(), wrap_fields(content)).when(
        error.isNull(), wrap_fields(join_objects(fields["doc"], content))
    )
    return _result(doc, error)


def _yaml_file(fields: Column, field: str) -> Column:
    error = F.when(
        fields["error"].isNotNull(), F.concat(F.lit("bad YAML: "), fields["error"])
    ).when(has_key(fields["doc"], field), "YAML has the content field")
    return _result(F.when(error.isNull(), wrap_fields(fields["doc"])), error)


def _rows(files: DataFrame, result: Column) -> DataFrame:
    """Envelope rows from one result per file."""
    checked = F.when(F.is_valid_utf8(F.col("text")), result).otherwise(_result(_null(), F.lit("not UTF-8 text")))
    rows = files.select("path", checked.alias("_r"), F.lit(0).alias("block_start"), F.lit(0).alias("pos"))
    return envelope(rows, F.col("_r.doc"), F.col("_r.error"))


def _with_metadata(df: DataFrame, metadata: bool) -> DataFrame:
    if not metadata:
        return df
    doc = F.when(F.col("error").isNull(), add_file_metadata(F.col("doc"), F.col("path"), F.col("name")))
    return df.withColumn("doc", doc)


def read_json_files(spark: SparkSession, *values: str, metadata: bool = False) -> DataFrame:
    """Each file is one JSON object."""
    files = _named(_whole_files(spark, list(values)))
    return _with_metadata(_rows(files, _json_file(F.col("text"))), metadata)


def read_jsonl_files(spark: SparkSession, *values: str, metadata: bool = False) -> DataFrame:
    """One JSON object per line; blank lines are skipped. Large files are split."""
    lines = scan(spark, list(values), lineSep="\n")
    return _with_metadata(line_documents(lines, skip_blank=True), metadata)


def read_text_files(spark: SparkSession, *values: str, field: str = "body", metadata: bool = False) -> DataFrame:
    """Each file's text becomes ``content.<field>``."""
    files = _named(_whole_files(spark, list(values)))
    return _with_metadata(_rows(files, _text_file(F.col("text"), field)), metadata)


def read_markdown_files(spark: SparkSession, *values: str, field: str = "body", metadata: bool = False) -> DataFrame:
    """Frontmatter fields become ``content.*``, the rest ``content.<field>``."""
    check_content_field(field)
    files = _named(_whole_files(spark, list(values)))
    files = files.withColumn("fields", yaml_object(split_frontmatter(F.col("text"))["front"]))
    return _with_metadata(_rows(files, _markdown_file(F.col("text"), F.col("fields"), field)), metadata)


def read_yaml_files(spark: SparkSession, *values: str, field: str = "body", metadata: bool = False) -> DataFrame:
    """The one mapping of each file becomes ``content``."""
    check_content_field(field)
    files = _named(_whole_files(spark, list(values))).withColumn("fields", yaml_object(F.col("text")))
    return _with_metadata(_rows(files, _yaml_file(F.col("fields"), field)), metadata)


def read_toon_docs(spark: SparkSession, *values: str, metadata: bool = False) -> DataFrame:
    """TOON documents between ``---`` lines; a lone table gives one document per row."""
    return _with_metadata(read_toon(spark, list(values)), metadata)


def read_file_documents(
    spark: SparkSession, *values: str, field: str = "body", metadata: bool | None = None
) -> DataFrame:
    """Any mix of files, each read by its suffix; unknown suffixes, and CSV, are text.

    ``metadata`` defaults to whether more than one file is found. Four scans in all: lines,
    TOON, structured whole files and text files, each opening only its own files. Files are
    listed once to be checked, once by lines and once whole.
    """
    check_content_field(field)
    values = list(values)
    n_files = check_inputs(spark, values)
    metadata = n_files > 1 if metadata is None else metadata

    by_lines = scan(spark, values, lineSep="\n")
    lines = line_documents(by_lines.where(_is(LINE_SUFFIXES)), skip_blank=True)

    whole = _whole_files(spark, values)  # listed once, used for both groups of whole files
    structured = _named(whole.where(_is(WHOLE_SUFFIXES)))
    suffix, text = F.col("suffix"), F.col("text")
    is_markdown = suffix.isin(MARKDOWN_SUFFIXES)
    yaml_text = F.when(is_markdown, split_frontmatter(text)["front"]).when(suffix.isin(YAML_SUFFIXES), text)
    structured = structured.withColumn("fields", yaml_object(yaml_text))
    result = (
        F.when(suffix == "json", _json_file(text))
        .when(is_markdown, _markdown_file(text, F.col("fields"), field))
        .otherwise(_yaml_file(F.col("fields"), field))
    )
    others = _named(whole.where(~_is(LINE_SUFFIXES + TOON_SUFFIXES + WHOLE_SUFFIXES)))
    toon = toon_envelope(spark, by_lines.where(_is(TOON_SUFFIXES)))
    parts = [lines, toon, _rows(structured, result), _rows(others, _text_file(text, field))]
    return _with_metadata(concat_documents(*parts), metadata)


def concat_documents(*parts: DataFrame) -> DataFrame:
    """Several document tables as one; reading order is kept by the order columns."""
    result = parts[0].select(*COLUMNS)
    for part in parts[1:]:
        result = result.unionByName(part.select(*COLUMNS))
    return result


def read_documents(spark: SparkSession, *values: str, field: str = "body") -> DataFrame:
    """Documents of one or many inputs.

    Exactly one plain ``.csv``, ``.ndjson``, ``.json`` or ``.toon`` path is read record by
    record. A glob, several inputs, or another suffix is read as file documents.
    """
    check_content_field(field)
    if not values:
        raise InputError("no input is given")
    for value in values:
        scheme = value.split("://", 1)[0] if "://" in value else None
        if scheme in ("http", "https"):
            raise InputError(f"cannot read from {scheme} addresses")
    if len(values) == 1 and not has_glob(values[0]):
        value = local_form(values[0])
        kind = record_kind(value)
        if kind == "csv":
            return read_csv_docs(spark, value)
        if kind in ("ndjson", "json"):
            return read_ndjson(spark, value)
        if kind == "toon":
            return read_toon(spark, [value])
        if value.lower().endswith(".gz"):
            raise InputError(f"cannot read this compressed file: {value}")
    return read_file_documents(spark, *values, field=field)


def record_kind(path: str) -> str | None:
    """Kind of a single input read record by record, else null."""
    low = path.lower()
    for kind in ("csv", "ndjson"):
        if low.endswith((f".{kind}", f".{kind}.gz")):
            return kind
    for kind in ("json", "toon"):
        if low.endswith(f".{kind}"):
            return kind
    return None
