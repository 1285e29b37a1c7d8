"""One query per operator over the driver tables. SQL for each is in ``oracle.py``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions import json_text as J
from docferry.functions import markup as M
from docferry.functions import paths as P
from docferry.functions import patterns as R
from docferry.functions.yaml_udf import yaml_object
from docferry.operators import account, batch, shape, target, validate
from docferry.plans.load import load_to_bulk
from docferry.session import configure, scratch_dir, stage, stored_at
from docferry.sinks.bulk import COMMITS_DDL, BulkTarget, register, write_bulk
from docferry.sinks.ndjson import write_ndjson
from docferry.sinks.transport import DryRun
from docferry.sources.csv import read_csv_docs, row_to_json
from docferry.sources.files import (
    concat_documents,
    read_documents,
    read_json_files,
    read_jsonl_files,
    read_markdown_files,
    read_text_files,
    read_toon_docs,
    read_yaml_files,
)
from docferry.sources.listing import list_files
from docferry.sources.ndjson import read_ndjson
from docferry.sources.places import error_places as place_errors
from docferry.streaming.lines import stream_bulk, stream_ndjson, stream_to_ndjson

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(configure(spark), sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts) -> Column:
    """Concatenate columns and literals; numbers become text."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


c = F.col
N = "\n"


def by_rest(key: str, n: int, *choices: Column) -> Column:
    """One of several forms of a row, by the rest of its key. Every row takes part."""
    result = choices[-1]
    for i, choice in reversed(list(enumerate(choices[:-1]))):
        result = F.when(c(key) % n == i, choice).otherwise(result)
    return result


def damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = c("props")
    line = by_rest("event_id", 7, text(props, " x"), F.replace(props, F.lit("}")), text("[", props, "]"), text(" "), props)
    return table(spark, sf_dir, "events").select("event_id", line.alias("doc"))


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.to_json(F.struct("event_id", "event_type", "props")).alias("doc"))


# Validation ------------------------------------------------------------------------------


@query
def ndjson_valid(spark, sf_dir):
    return damaged_events(spark, sf_dir).select("event_id", J.is_json_object(c("doc")).alias("ok"))


@query
def objects_gate(spark, sf_dir):
    return validate.objects_gate(damaged_events(spark, sf_dir))


@query
def root_shapes(spark, sf_dir):
    shapes = damaged_events(spark, sf_dir).select(J.root_shape(c("doc")).alias("shape"))
    return shapes.groupBy("shape").agg(F.count(F.lit(1)).alias("n"))


@query
def line_errors(spark, sf_dir):
    checked = validate.check_documents(damaged_events(spark, sf_dir))
    return validate.rejected(checked).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query
def kept_documents(spark, sf_dir):
    return validate.enforce(validate.check_documents(damaged_events(spark, sf_dir)), "keep").select("event_id", "doc")


def update_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    text_id, number_id = text("o", c("o_orderkey")).alias("_id"), c("o_orderkey").alias("_id")
    rest = ["o_orderstatus", "o_custkey"]
    doc = by_rest(
        "o_orderkey", 4, F.to_json(F.struct(*rest)), F.to_json(F.struct(number_id, *rest)), F.to_json(F.struct(text_id, *rest))
    )
    return orders.select("o_orderkey", doc.alias("doc"))


@query
def update_ids(spark, sf_dir):
    return validate.with_update_id(update_docs(spark, sf_dir)).select("o_orderkey", "id", "doc", "error")


# Shaping ---------------------------------------------------------------------------------


@query
def csv_row_docs(spark, sf_dir):
    names = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    docs = table(spark, sf_dir, "customer").select(row_to_json({n: c(n).cast("string") for n in names}).alias("doc"))
    return docs.select(*[F.get_json_object("doc", f"$.{n}").alias(n) for n in names])


@query
def wrap_content(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", J.wrap_content(c("text"), "body").alias("doc"))
    body = F.get_json_object("doc", "$.content.body")
    return docs.select("doc_id", F.length(body).alias("n_chars"), F.md5(body).alias("body_md5"))


def _file_path() -> Column:
    return text("/data/", c("source"), "/", c("doc_id"), ".txt")


@query
def file_metadata(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        _file_path().alias("path"),
        by_rest(
            "doc_id", 3, F.lit("{}"), F.to_json(F.struct(c("source").alias("file"), "lang")), F.to_json(F.struct("lang"))
        ).alias("doc"),
    )
    doc = J.add_file_metadata(c("doc"), c("path"), P.file_name(c("path")))
    return docs.select("doc_id", doc.alias("doc")).select(
        "doc_id",
        F.get_json_object("doc", "$.file.path").alias("path"),
        F.get_json_object("doc", "$.file.name").alias("name"),
        F.get_json_object("doc", "$.lang").alias("lang"),
    )


@query
def distinct_paths(spark, sf_dir):
    path = text("/data/", c("source"), "/", c("lang"), ".txt")
    return table(spark, sf_dir, "documents").select(path.alias("path")).distinct().orderBy("path")


def marked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    front = text("source: ", c("source"), N, "n: ", c("n_chars"))
    whole = by_rest(
        "doc_id",
        4,
        text("---\n", front, "\n---\n", c("text")),
        text("---\r\n", front, "\n---\r\n", c("text")),
        text("---\n", front, "\n---"),
        c("text"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", whole.alias("text"))


@query
def frontmatter(spark, sf_dir):
    parts = M.split_frontmatter(c("text"))
    return marked_documents(spark, sf_dir).select("doc_id", parts["front"].alias("front"), F.md5(parts["body"]).alias("body_md5"))


@query
def frontmatter_fields(spark, sf_dir):
    fields = M.flat_yaml(M.split_frontmatter(c("text"))["front"])
    return marked_documents(spark, sf_dir).select("doc_id", fields.alias("f")).select(
        "doc_id",
        F.get_json_object("f", "$.source").alias("source"),
        F.get_json_object("f", "$.n").cast("bigint").alias("n"),
    )


@query
def yaml_fields(spark, sf_dir):
    yaml_text = text("source: '", c("source"), "'\ntags: [", c("lang"), ", ", c("n_chars"), "]\nin:\n  id: ", c("doc_id"), N)
    fields = table(spark, sf_dir, "documents").select("doc_id", yaml_object(yaml_text)["doc"].alias("f"))
    return fields.select(
        "doc_id",
        F.get_json_object("f", "$.source").alias("source"),
        F.get_json_object("f", "$.tags[0]").alias("tag"),
        F.get_json_object("f", "$.tags[1]").cast("bigint").alias("n"),
        F.get_json_object("f", "$.in.id").cast("bigint").alias("id"),
    )


@query
def content_conflict(spark, sf_dir):
    front = by_rest("doc_id", 3, text("body: ", c("source")), text("source: ", c("source")))
    fields = M.flat_yaml(front)
    return table(spark, sf_dir, "documents").select("doc_id", J.has_key(fields, "body").alias("conflict"))


@query
def split_documents(spark, sf_dir):
    whole = text("---\n", c("source"), "\n---\n", c("text"), "\n --- \n \n---\r\n", c("lang"))
    docs = table(spark, sf_dir, "documents").select("doc_id", whole.alias("text"))
    return shape.split_documents(docs).select("doc_id", "idx", F.md5("chunk").alias("chunk_md5"))


@query
def explode_rows(spark, sf_dir):
    items = F.array(
        F.struct(c("l_partkey").alias("key"), F.lit("part").alias("of")),
        F.struct(c("l_suppkey").alias("key"), F.lit("supplier").alias("of")),
    )
    doc = by_rest(
        "l_linenumber",
        3,
        F.to_json(F.struct(items.alias("items"))),
        F.to_json(F.struct(items.alias("items"), c("l_suppkey").alias("key"))),
        F.to_json(F.struct(c("l_suppkey").alias("key"))),
    )
    docs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", doc.alias("doc"))
    rows = shape.explode_rows(docs).withColumn("f", F.from_json("doc", "key bigint, of string"))
    return rows.select("l_orderkey", "l_linenumber", "row", "f.key", "f.of")


@query
def exploded_text(spark, sf_dir):
    """Elements with spellings that a parser would change."""
    element = text('{"price": ', c("l_extendedprice").cast("decimal(18,2)"), ', "key":', c("l_partkey"), '.0,"e":1e', c("l_linenumber"), "}")
    doc = text('{"rows": [', element, ", ", element, "]}")
    rows = shape.explode_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", doc.alias("doc")))
    return rows.select("l_orderkey", "l_linenumber", "row", "doc")


@query
def toon_rows(spark, sf_dir):
    whole = text(
        "parts[2]{id,name,size}:\n  ", c("p_partkey"), ',"', c("p_name"), '",', c("p_size"), "\n  -", c("p_size"), ",",
        c("p_type"), ",true\n---\nid: ", c("p_partkey"), "\nname: ", c("p_brand"), "\nsizes[2]: ", c("p_size"), ",x\n",
    )
    docs = table(spark, sf_dir, "part").select("p_partkey", whole.alias("text"))
    schema = "id bigint, name string, size string, sizes array<string>"
    rows = shape.toon_rows(docs).withColumn("f", F.from_json("doc", schema))
    first_size = F.get(c("f.sizes"), F.lit(0)).cast("bigint")
    return rows.select("p_partkey", "idx", "row", "f.id", "f.name", "f.size", first_size.alias("first_size"))


@query
def toon_errors(spark, sf_dir):
    key = c("p_partkey")
    whole = by_rest(
        "p_partkey",
        5,
        text("rows[2]{id,name}:\n  ", key, ",a"),
        text("rows[1]{id,name}:\n  ", key),
        text("[2]: ", key, ",", c("p_size")),
        text("rows[1]: ", key),
        text("id: ", key),
    )
    docs = table(spark, sf_dir, "part").select("p_partkey", whole.alias("text"))
    return shape.toon_rows(docs).select("p_partkey", "error")


# Batches and bodies ----------------------------------------------------------------------


@query
def row_index(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return batch.with_row_index(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_index")


@query
def assign_batches(spark, sf_dir):
    batches = batch.assign_batches(table(spark, sf_dir, "events").select("event_id"), 500, "event_id")
    return batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("min_id"), F.max("event_id").alias("max_id")
    )


def _bodies(docs: DataFrame, action: str, key: str) -> DataFrame:
    lines = batch.bulk_lines(batch.assign_batches(docs, 500, key), action)
    return batch.render_batches(lines).select(
        "batch_id", "n_docs", F.octet_length("body").alias("n_bytes"), F.md5("body").alias("body_md5")
    )


def _event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", c("props").alias("doc"))


@query
def bulk_create(spark, sf_dir):
    return _bodies(_event_props(spark, sf_dir), "create", "event_id")


@query
def bulk_index(spark, sf_dir):
    return _bodies(_event_props(spark, sf_dir), "index", "event_id")


@query
def bulk_update(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    doc = F.to_json(F.struct("o_orderstatus", text("o", c("o_orderkey")).alias("_id"), "o_custkey"))
    return _bodies(orders.select("o_orderkey", doc.alias("doc")), "update", "o_orderkey")


# Accounting ------------------------------------------------------------------------------


def bulk_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request of two operations per event; its status and reply follow from the event."""
    rest = c("event_id") % 10
    status = F.when(rest == 8, 400).when(rest == 9, 429).otherwise(200)
    failed = rest.isin(3, 4)
    cause = text('{"type":"', c("event_type"), '","reason":"user ', c("user_id"), '"}')
    error = F.when(failed, text(',"error":{"type":"outer","reason":"r","caused_by":', cause, "}")).otherwise(F.lit(""))

    def item(action: str, code: Column) -> Column:
        return text('{"', action, '":{"_index":"', c("event_type"), '","_id":"', c("event_id"), '","status":', code, error, "}}")

    create_code = F.when(failed, 409).when(rest == 5, 200).otherwise(201)
    index_code = F.when(failed, 400).when(rest == 6, 200).otherwise(201)
    settled = text(
        '{"errors":', F.when(rest == 3, "true").otherwise("false"), ',"items":[', item("create", create_code), ",",
        item("index", index_code), "]}",
    )
    refused = by_rest(
        "event_id",
        3,
        text('{"error":{"type":"', c("event_type"), '","reason":"x"},"status":400}'),
        text('{"error":"', c("event_type"), ' text"}'),
        F.lit("{}"),
    )
    return table(spark, sf_dir, "events").select(
        status.alias("status"), F.lit(2).alias("n_docs"), F.when(status == 200, settled).otherwise(refused).alias("reply")
    )


@query
def reply_success(spark, sf_dir):
    return account.success_counts(bulk_replies(spark, sf_dir))


@query
def reply_errors(spark, sf_dir):
    return account.error_counts(bulk_replies(spark, sf_dir))


@query
def request_errors(spark, sf_dir):
    return account.request_errors(bulk_replies(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return account.run_summary(bulk_replies(spark, sf_dir))


# Target configuration --------------------------------------------------------------------


@query
def pattern_match(spark, sf_dir):
    matched = R.match_patterns(c("p_name"), ["*widget*", "-small*,small_*", "-* bolt", "large*"])
    return table(spark, sf_dir, "part").select("p_partkey", matched.alias("matched"))


@query
def template_match(spark, sf_dir):
    body = text('{"index_patterns":["Brand#1*,-Brand#1', c("p_size") % 10, '","*#5"]}')
    return table(spark, sf_dir, "part").select("p_partkey", R.template_match(body, c("p_brand"))["matched"].alias("matched"))


def _settings(flat: Column | None, nested: Column | None) -> Column:
    parts = []
    if flat is not None:
        parts.append(text('"index.default_pipeline":"', flat, '"'))
    if nested is not None:
        parts.append(text('"index":{"default_pipeline":"', nested, '"}'))
    return text('{"index_patterns":"*","template":{"settings":{', F.concat_ws(",", *parts), "}}}")


@query
def template_defaults(spark, sf_dir):
    flat, nested = c("p_brand"), c("p_type")
    body = by_rest(
        "p_partkey", 4, _settings(flat, None), _settings(None, nested), _settings(flat, nested), F.lit('{"template":{}}')
    )
    return table(spark, sf_dir, "part").select("p_partkey", R.default_pipeline(body).alias("default_name"))


@query
def preflight_check(spark, sf_dir):
    named, none = text("Brand#", c("c_custkey") % 60), F.lit(None).cast("string")
    flat, nested = _settings(named, None), _settings(None, named)
    targets = table(spark, sf_dir, "customer").select(
        c("c_name").alias("index"),
        c("c_mktsegment").alias("template_name"),
        by_rest("c_custkey", 7, none, none, flat, nested, F.lit("{}"), none, flat).alias("template_body"),
        by_rest("c_custkey", 7, F.lit("_none"), named, named, none, named, named, F.lit("other")).alias("pipeline_name"),
        (c("c_custkey") % 7).isin(1, 2, 4, 6).alias("has_pipeline"),
    )
    known = table(spark, sf_dir, "part").select(c("p_brand").alias("name"))
    found = target.check_targets(targets, known)
    return found.select("index", "status", "template_pipeline", "request_pipeline", "patterns_match")


@query
def missing_defaults(spark, sf_dir):
    templates = table(spark, sf_dir, "customer").select(
        c("c_name").alias("name"), _settings(None, text("Brand#", c("c_custkey") % 60)).alias("body")
    )
    known = table(spark, sf_dir, "part").select(c("p_brand").alias("name"))
    return target.missing_pipelines(templates, known).select("name", "template_pipeline")


@query
def processors(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(c("toxic") == 1, "True").otherwise("False").alias("toxic"),
        text(c("quality"), ",", c("doc_id")).alias("tags"),
    )
    steps = [
        {"set": {"field": "origin", "value": "labels"}},
        {"split": {"field": "tags", "separator": ",", "ignore_missing": True}},
        {"split": {"field": "absent", "separator": ",", "ignore_missing": True}},
        {"convert": {"field": "toxic", "type": "boolean"}},
    ]
    done = target.apply_processors(labels, steps)
    return done.select("doc_id", "toxic", "origin", F.size("tags").alias("n_tags"), F.get("tags", F.lit(1)).alias("second_tag"))


@query
def typed_mapping(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        by_rest("l_orderkey", 5, F.lit("n/a"), c("l_partkey").cast("string")).alias("part"),
        c("l_quantity").cast("string").alias("quantity"),
        F.when(c("l_returnflag") == "R", "true").otherwise("False").alias("returned"),
        by_rest("l_orderkey", 6, F.lit("soon"), F.date_format("l_shipdate", "MMM d, yyyy")).alias("shipped"),
        c("l_linestatus").alias("state"),
    )
    mapping = {
        "part": {"type": "integer"},
        "quantity": {"type": "float"},
        "returned": {"type": "boolean"},
        "shipped": {"type": "date", "format": "MMM d, yyyy"},
        "state": {"type": "keyword"},
        "unknown": {"type": "text"},
    }
    return target.apply_mapping(raw, mapping).withColumn("quantity", c("quantity").cast("double"))


@query
def index_sort(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    ordered = target.sort_for_index(customers, ["c_mktsegment", "c_acctbal"], ["asc", "desc"], unique=["c_custkey"])
    return batch.number_sorted(ordered).select("c_custkey", "row_index")


@query
def url_format(spark, sf_dir):
    suffixes = ("", ".csv", ".NDJSON", ".json?x=a.csv", ".toon#f", ".md", ".csv.gz", ".bin")
    suffix = by_rest("page_id", 8, *[F.lit(s) for s in suffixes])
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.regexp_replace("url", r"[?#].*$", ""), suffix).alias("url"),
        by_rest(
            "page_id", 6, F.lit("text/CSV; charset=utf-8"), F.lit("application/x-ndjson"), F.lit("application/ld+json"),
            F.lit("text/toon"), F.lit("text/html"), F.lit(None).cast("string"),
        ).alias("content_type"),
    )
    found = P.classify_format(c("url"), c("content_type"))
    return pages.select("page_id", found["kind"].alias("kind"), found["error"].alias("error"))


@query
def suffix_rules(spark, sf_dir):
    suffixes = (".csv.gz", ".ndjson.GZ", ".json.gz", ".GZ", ".gz.txt", ".ndjson")
    path = by_rest("page_id", 6, *[text(c("url"), s) for s in suffixes])
    return table(spark, sf_dir, "pages").select(
        "page_id", P.input_gzip_refused(path).alias("input_refused"), P.output_gzip_refused(path).alias("output_refused"),
        P.kind_of_path(path).alias("kind"),
    )


# Files and streams -----------------------------------------------------------------------


def _fields(docs: DataFrame, *more: str) -> DataFrame:
    schema = ", ".join(["event_id bigint, event_type string, props string", *more])
    return docs.select(F.from_json("doc", schema).alias("f")).select("f.*")


@query
def ndjson_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "roundtrip")
    write_ndjson(event_docs(spark, sf_dir), path)
    return _fields(validate.enforce(read_ndjson(spark, path)))


@query
def ndjson_gz_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "roundtrip") + ".ndjson.gz"
    write_ndjson(event_docs(spark, sf_dir), path)
    return _fields(validate.enforce(read_ndjson(spark, path)))


@query
def csv_file_docs(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    turns = table(spark, sf_dir, "conversations").select([c(n).cast("string") for n in ("conv_id", "turn", "role", "text")])
    turns.write.csv(path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    docs = validate.enforce(read_csv_docs(spark, path))
    return docs.select(
        *[F.get_json_object("doc", f"$.{n}").alias(n) for n in ("conv_id", "turn", "role")],
        F.md5(F.get_json_object("doc", "$.text")).alias("text_md5"),
    )


@query
def jsonl_files(spark, sf_dir):
    path = scratch_dir(spark, "jsonl")
    # Every second line is blank.
    event_docs(spark, sf_dir).select(F.concat("doc", F.lit("\n  "))).write.text(path)
    docs = validate.enforce(read_jsonl_files(spark, f"{path}/*.txt", metadata=True))
    fields = _fields(docs, "file struct<path: string, name: string>")
    named = c("file.path") == text(f"{path}/", c("file.name"))
    return fields.select("event_id", "event_type", "props", named.alias("named"))


@query
def concat_inputs(spark, sf_dir):
    first, second = scratch_dir(spark, "events"), scratch_dir(spark, "orders")
    write_ndjson(event_docs(spark, sf_dir), first)
    orders = table(spark, sf_dir, "orders").select(F.to_json(F.struct("o_orderkey", "o_orderstatus")).alias("doc"))
    write_ndjson(orders, second)
    both = validate.enforce(concat_documents(read_ndjson(spark, first), read_ndjson(spark, second)))
    kind = F.coalesce(F.get_json_object("doc", "$.event_type"), F.get_json_object("doc", "$.o_orderstatus"))
    key = F.coalesce(F.get_json_object("doc", "$.event_id"), F.get_json_object("doc", "$.o_orderkey")).cast("bigint")
    return both.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("keys"))


def _lines_of(kind: str) -> list[Column]:
    """The lines of one supplier's file."""
    key, name, nation = c("s_suppkey"), c("s_name"), c("s_nationkey")
    fields = [text("name: ", name), text("nation: ", nation)]
    return {
        "txt": [name, text("from ", nation)],
        "md": [F.lit("---"), *fields, F.lit("---"), text("About ", name), text("from ", nation)],
        "yml": fields,
        "jsn": [text('{"name": "', name, '",'), text(' "nation": ', nation, "}")],
        "json": [F.to_json(F.struct(name.alias("name"), nation.alias("nation")))],
        "ton": [F.lit("rows[2]{name,nation}:"), text("  ", name, ",", nation), text("  #", key, ",-1")],
    }[kind]


#: Files that one task writes.
FILES_A_TASK = 1000


def _write_files(folder: str, suffix: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the lines of each supplier, which follow each other, as one file; give the number of files.

    A task that runs again writes the same files again. Hadoop's local file system starts two
    programs for every file it makes, so files by the ten thousand are not left to Spark's writer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = stored_at(folder)

        def write(key: int | None, lines: list[str | None]) -> None:
            own = f"{at}/s_suppkey={'__HIVE_DEFAULT_PARTITION__' if key is None else key}"
            files.create_dir(own)
            with files.open_output_stream(f"{own}/part-0.{suffix}") as out:
                out.write("".join(f"{line}\n" for line in lines if line is not None).encode())

        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        n = 0
        for key, group in groupby(rows, key=lambda row: row[0]):
            write(key, [line for _, line in group])
            n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return run


def _one_file_each(suppliers: DataFrame, kind: str, folder: str) -> None:
    """Write one file per supplier, with the kind as suffix."""
    lines = suppliers.select("s_suppkey", F.posexplode(F.array(*_lines_of(kind))).alias("pos", "line"))
    # Said in numbers, as small rows would all go to one task.
    n_tasks = max(suppliers.sparkSession.sparkContext.defaultParallelism, -(-suppliers.count() // FILES_A_TASK))
    lines = lines.repartition(n_tasks, "s_suppkey").sortWithinPartitions("s_suppkey", "pos")
    # As Spark's CSV writer has it: blanks at the end of a line are left out, an empty line is two quotes, a null is none.
    line = F.regexp_replace("line", r"[\x00-\x20]+\z", "")
    given = lines.select("s_suppkey", F.when(line == "", '""').otherwise(line).alias("line"))
    files, at = stored_at(f"{folder}/{kind}")
    files.create_dir(at)
    given.mapInArrow(_write_files(f"{folder}/{kind}", kind), "n long").agg(F.sum("n")).first()


def _supplier_fields(docs: DataFrame) -> DataFrame:
    def field(*paths: str) -> Column:
        return F.coalesce(*[F.get_json_object("doc", p) for p in paths])

    return validate.enforce(docs).select(
        F.regexp_extract(field("$.file.path"), "s_suppkey=([0-9]+)/", 1).cast("bigint").alias("s_suppkey"),
        field("$.content.name", "$.name").alias("name"),
        field("$.content.nation", "$.nation").cast("int").alias("nation"),
        field("$.content.body").alias("body"),
    )


#: Folders of files made from a table, by session, table folder and kind: made once, read by several queries.
_FOLDERS: dict[tuple[str, str, str], str] = {}


def file_folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """A folder with one file per supplier; ``mixed`` has files of four kinds."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _FOLDERS:
        folder = scratch_dir(spark, "files")
        suppliers = table(spark, sf_dir, "supplier")
        if kind == "mixed":
            for rest, one in enumerate(["txt", "md", "yml"]):
                _one_file_each(suppliers.where(c("s_suppkey") % 4 == rest), one, folder)
            _one_file_each(suppliers.where(c("s_suppkey") % 4 == 3), "json", folder)
        else:
            _one_file_each(suppliers, kind, folder)
        _FOLDERS[key] = folder
    return _FOLDERS[key]


FILE_KINDS = ["txt", "md", "yml", "jsn", "ton", "mixed"]


def _files_query(kind: str, read: Callable[..., DataFrame]) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _supplier_fields(read(spark, f"{file_folder(spark, sf_dir, kind)}/**/*.{kind}", metadata=True))

    return build


for _name, _kind, _read in [
    ("text_files", "txt", read_text_files),
    ("markdown_files", "md", read_markdown_files),
    ("yaml_files", "yml", read_yaml_files),
    ("json_files", "jsn", read_json_files),
    ("toon_files", "ton", read_toon_docs),
]:
    _build = _files_query(_kind, _read)
    _build.__name__ = _name
    query(_build)


def _in_small_splits(spark: SparkSession, read: Callable[[], DataFrame], size: str = "200k") -> DataFrame:
    """What ``read`` gives where files are cut into splits of this size, staged."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, size)
        return stage(read(), "small-splits")
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


@query
def csv_split(spark, sf_dir):
    """Quoted values with line breaks, in files that are cut anywhere."""
    path = scratch_dir(spark, "csv-split")
    docs = table(spark, sf_dir, "documents").select(c("doc_id").cast("string").alias("doc_id"), "lang", "text")
    docs.write.csv(path, header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = _in_small_splits(spark, lambda: validate.enforce(read_csv_docs(spark, path)))
    fields = rows.select(F.from_json("doc", "doc_id string, lang string, text string").alias("f"))
    return fields.select(c("f.doc_id").cast("bigint").alias("doc_id"), "f.lang", F.md5("f.text").alias("text_md5"))


@query
def csv_odd_rows(spark, sf_dir):
    """Short and long rows, open lines, doubled and plain quotes, in files that are cut anywhere."""
    key, kind = c("event_id"), c("event_type")
    lines = by_rest(
        "event_id",
        6,
        F.array(text(key, ',"', kind, ' ""q"""', ",x")),
        F.array(text(key, ",", kind)),
        F.array(text(key, ",", kind, ",x,y")),
        F.array(text(key, ',"first'), text("second,", kind, '",z')),
        F.array(text(key, ",plain", '"', kind, ",")),
        F.array(text(key, ",", kind, ",z")),
    )
    path = scratch_dir(spark, "csv-odd")
    given = table(spark, sf_dir, "events").select("event_id", F.posexplode(lines).alias("pos", "key,value,more"))
    given = given.repartition("event_id").sortWithinPartitions("event_id", "pos").select("`key,value,more`")
    # Separator and quote are characters no line holds.
    given.write.csv(path, header=True, sep="\x01", quote="\x02", ignoreLeadingWhiteSpace=False)
    rows = _in_small_splits(spark, lambda: read_csv_docs(spark, path), "20k")
    good = F.from_json(F.when(c("error").isNull(), c("doc")), "key string, value string, more string")
    number = F.coalesce(good["key"], F.substring_index("doc", ",", 1)).cast("bigint")
    return rows.select(number.alias("event_id"), good["value"].alias("value"), good["more"].alias("more"), "error")


@query
def csv_gz(spark, sf_dir):
    path = scratch_dir(spark, "csv-gz")
    customers = table(spark, sf_dir, "customer").select(c("c_custkey").cast("string").alias("c_custkey"), "c_name")
    customers.write.csv(path, header=True, compression="gzip")
    docs = validate.enforce(read_csv_docs(spark, path))
    return docs.select(F.get_json_object("doc", "$.c_custkey").cast("bigint").alias("c_custkey"), F.get_json_object("doc", "$.c_name").alias("c_name"))


@query
def error_places(spark, sf_dir):
    """The line of every damaged event, counted from the start of its file."""
    folder = scratch_dir(spark, "places")
    given = damaged_events(spark, sf_dir).select((c("event_id") % 16).alias("part"), "event_id", c("doc").alias("line"))
    given = given.repartition("part").sortWithinPartitions("part", "event_id").drop("event_id")
    given.write.partitionBy("part").csv(folder, sep="\x01", quote="\x02", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    found = _in_small_splits(spark, lambda: place_errors(read_ndjson(spark, folder), kind="lines"), "10k")
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint")
    return found.select(part.alias("part"), "line", "error")


@query
def toon_long(spark, sf_dir):
    """One table per file, cut between its rows, next to files of several documents."""
    folder = scratch_dir(spark, "toon-long")
    orders = table(spark, sf_dir, "orders").select((c("o_custkey") % 4).alias("part"), "o_orderkey", c("o_orderstatus").alias("state"))
    counted = orders.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    row = orders.select("part", F.lit(1).alias("at"), "o_orderkey", text("  ", c("o_orderkey"), ",", c("state")).alias("line"))
    # Declared numbers are one too high in one part, and another holds two documents.
    declared = text("rows[", c("n") + F.when(c("part") == 2, 1).otherwise(0), "]{key,state}:")
    head = counted.select("part", F.lit(0).alias("at"), F.lit(None).cast("bigint").alias("o_orderkey"), declared.alias("line"))
    second = counted.where("part = 3").select(
        "part", F.lit(2).alias("at"), F.lit(None).cast("bigint").alias("o_orderkey"), F.explode(F.array(F.lit("---"), F.lit("key: -1"))).alias("line")
    )
    lines = head.unionByName(row).unionByName(second).repartition("part").sortWithinPartitions("part", "at", "o_orderkey", F.desc(c("line") == "---"))
    plain = {"sep": "\x01", "quote": "\x02", "ignoreLeadingWhiteSpace": "false", "extension": "ton"}
    lines.select("part", "line").write.partitionBy("part").options(**plain).csv(folder)
    docs = _in_small_splits(spark, lambda: read_toon_docs(spark, f"{folder}/*/*.ton"), "10k")
    fields = F.from_json("doc", "key bigint, state string")
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint")
    return docs.select(part.alias("part"), fields["key"].alias("key"), fields["state"].alias("state"), "error")


@query
def pretty_json(spark, sf_dir):
    """A folder of line files and of files with one document over several lines."""
    folder = scratch_dir(spark, "pretty")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    name = text(' "name": "', c("n_name"), '",')
    pretty = nations.select("n_nationkey", F.posexplode(F.array(F.lit("{"), name, text(' "key": ', c("n_nationkey")), F.lit("}"))).alias("pos", "line"))
    pretty = pretty.repartition("n_nationkey").sortWithinPartitions("n_nationkey", "pos").select(c("n_nationkey").alias("part"), "line")
    plain = {"sep": "\x01", "quote": "\x02", "ignoreLeadingWhiteSpace": "false", "extension": "json"}
    pretty.write.partitionBy("part").options(**plain).csv(folder)
    orders = table(spark, sf_dir, "orders").select(F.lit(-1).alias("part"), F.to_json(F.struct(c("o_orderstatus").alias("name"), c("o_orderkey").alias("key"))).alias("line"))
    orders.write.mode("append").partitionBy("part").options(**plain).csv(folder)
    docs = validate.enforce(read_ndjson(spark, folder))
    fields = F.from_json("doc", "name string, key bigint")
    return docs.select(fields["name"].alias("name"), fields["key"].alias("key"))


@query
def send_ledger(spark, sf_dir):
    """A load that stops after one round and is taken up: each document is in one committed reply."""
    replies, ledger = scratch_dir(spark, "replies"), scratch_dir(spark, "ledger")
    target = BulkTarget("events", DryRun(), 200)
    docs = event_docs(spark, sf_dir)
    write_bulk(docs, target, replies, max_requests=2, ledger=ledger, parcel_docs=500, rounds=1)
    sent = write_bulk(docs.limit(0), target, replies, max_requests=2, ledger=ledger)
    parcels = sent.groupBy("parcel").agg(F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("n_requests"), F.max("seq").alias("last"))
    return parcels.agg(
        F.sum("n").alias("n_docs"),
        F.count_if(c("n") > 500).alias("too_large"),
        F.count_if(c("n_requests") != c("last") + 1).alias("sent_twice"),
    )


@query
def load_summary(spark, sf_dir):
    """What a load reads, refuses and sends."""
    path = scratch_dir(spark, "load") + ".ndjson"
    damaged_events(spark, sf_dir).select("doc").write.text(path)
    target = BulkTarget("events", DryRun(), 500)
    refused = scratch_dir(spark, "refused")
    row = load_to_bulk(spark, [path], target, errors="keep", refused_path=refused)
    kept = spark.read.parquet(refused).agg(F.count(F.lit(1)).alias("n_kept"))
    return row.select("n_read", "n_refused", "n_docs", "n_accepted").crossJoin(kept)


@query
def bulk_source(spark, sf_dir):
    """Updates through the data source: what its table of commits says was sent and refused."""
    register(spark)
    commits = scratch_dir(spark, "commits")
    lines = batch.checked_lines(update_docs(spark, sf_dir), "update").select("line")
    options = {"index": "orders", "transport": "dry-run", "batchSize": "200", "commits": commits}
    lines.write.format("docferry_bulk").mode("append").options(**options).save()
    done = spark.read.schema(COMMITS_DDL).parquet(commits)
    return done.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_refused").alias("n_refused"), F.min("outcome").alias("outcome"), F.count_if(F.map_contains_key("statuses", F.lit(200)) != (c("n_docs") > 0)).alias("odd"))


@query
def utf8_lines(spark, sf_dir):
    """Lines with a byte that is no UTF-8 text."""
    wrong = F.concat(F.encode("props", "UTF-8"), F.lit(b"\xff")).cast("string")
    docs = table(spark, sf_dir, "events").select("event_id", by_rest("event_id", 9, wrong, c("props")).alias("doc"))
    return validate.check_documents(docs).select("event_id", "error")


@query
def content_fields(spark, sf_dir):
    field = by_rest("doc_id", 4, F.lit(""), text(c("source"), ".", c("lang")), F.lit(None).cast("string"), c("source"))
    return table(spark, sf_dir, "documents").select("doc_id", J.content_field_error(field).alias("error"))


@query
def output_rules(spark, sf_dir):
    path = by_rest("page_id", 5, *[text(c("url"), s) for s in (".ndjson", ".NDJSON.gz", ".json.gz", ".json", ".gz")])
    return table(spark, sf_dir, "pages").select("page_id", P.output_error(path, c("page_id") % 3).alias("error"))


@query
def shard_sort(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return target.sort_for_shards(customers, "c_custkey", 5, ["c_mktsegment", "c_acctbal"], ["asc", "desc"]).select("c_custkey", "shard", "place")


@query
def batches_as_read(spark, sf_dir):
    path = scratch_dir(spark, "as-read")
    write_ndjson(event_docs(spark, sf_dir), path)
    docs = validate.enforce(read_ndjson(spark, path), "keep")
    batches = batch.assign_batches(docs, 700, as_read=True)
    return batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), (F.max("batch_pos") - F.min("batch_pos") + 1).alias("n_places")
    )


@query
def mixed_files(spark, sf_dir):
    folder = file_folder(spark, sf_dir, "mixed")
    # Overlapping inputs: every file counts once.
    return _supplier_fields(read_documents(spark, f"{folder}/**/*", f"{folder}/md/**/*.md"))


@query
def listed_files(spark, sf_dir):
    folder = file_folder(spark, sf_dir, "txt")
    found = list_files(spark, [f"{folder}/txt/*/*.txt", f"{folder}/**/*"])
    return found.select(F.regexp_extract("path", "s_suppkey=([0-9]+)/", 1).cast("bigint").alias("s_suppkey"), "suffix")


@query
def bulk_dry_run(spark, sf_dir):
    replies = write_bulk(event_docs(spark, sf_dir), BulkTarget("events", DryRun(), 500), scratch_dir(spark, "replies"))
    return account.run_summary(replies).select("n_docs", "n_accepted", "summary")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "stream-in")
    write_ndjson(event_docs(spark, sf_dir).repartition(4), folder)
    return stream_ndjson(spark, folder, max_files=2)


@query
def stream_copy(spark, sf_dir):
    out = scratch_dir(spark, "stream-out")
    writer = stream_to_ndjson(_event_stream(spark, sf_dir), out, scratch_dir(spark, "stream-state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return _fields(read_ndjson(spark, out))


@query
def stream_bulk_dry_run(spark, sf_dir):
    replies = scratch_dir(spark, "replies")
    writer = stream_bulk(
        _event_stream(spark, sf_dir), BulkTarget("events", DryRun(), 500), replies, scratch_dir(spark, "stream-state")
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    return account.run_summary(spark.read.parquet(replies)).select("n_docs", "n_accepted")


def first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read, validate, batch, render and account for the events table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = event_docs(configure(spark), sf_dir)
    good = validate.enforce(validate.check_documents(docs), "keep")
    lines = batch.bulk_lines(batch.assign_batches(good, batch.DEFAULT_BATCH_SIZE, "event_id"))
    return batch.render_batches(lines).select(
        "batch_id", "n_docs", F.octet_length("body").alias("n_bytes"), F.md5("body").alias("body_md5")
    )


QUERIES["first_load"] = first_load
