"""Which files an input names: globs, plain paths, checks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.paths import extension, file_name, glob_regex, has_glob, is_gzip, local_path, plain_path
from docferry.session import listing_by_few_tasks

FILE_PATH = "_metadata.file_path"
#: Globs that one regular expression takes in.
PATTERNS_AT_ONCE = 200


class InputError(ValueError):
    """An input names no readable file."""


def local_form(value: str) -> str:
    """A path as the listing reports it; a ``file:`` scheme and doubled slashes are dropped."""
    value = re.sub(r"^file:(//)?(?=/)", "", value)
    return re.sub(r"(?<!:)/{2,}", "/", value)


def _escape(text: str) -> str:
    # Braces and backslashes mean something to the file system's own globs only.
    return re.sub(r"([\\{}])", r"\\\1", text)


def literal_path(path: str) -> str:
    """A path whose signs mean nothing to the file system's globs."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def scan_root(value: str) -> str:
    """Where to list for one input: the path itself, the glob as the file system takes it,
    or for ``**`` the folder above it."""
    value = local_form(value)
    if not has_glob(value):
        return _escape(value)
    if "**" in value:
        parts = value.split("/")
        first = next(i for i, part in enumerate(parts) if has_glob(part))
        return _escape("/".join(parts[:first])) or ("/" if value.startswith("/") else ".")
    return _escape(value).replace("[!", "[^")


def scan_roots(values: list[str]) -> list[str]:
    """Where to list for the inputs; a ``**`` input's folder takes in the folders of others below it,
    so each folder is listed once."""
    wide = sorted({scan_root(v) for v in values if "**" in v})
    wide = [w for w in wide if w not in ("/", ".")]
    roots = list(dict.fromkeys(scan_root(v) for v in values))
    # A root that is a glob itself keeps its own listing.
    return [r for r in roots if has_glob(r) or not any(r != w and r.startswith(f"{w}/") for w in wide)]


def _has_scheme(value: str) -> bool:
    return "://" in value


def _without_scheme(path: Column) -> Column:
    # The listing reports the default file system's scheme and host; an input may have neither.
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def _is_relative(value: str) -> bool:
    return not (value.startswith("/") or _has_scheme(value))


def _pattern(value: str) -> str:
    """Regular expression that finds the paths of a glob."""
    pattern = glob_regex(value)
    return "/" + pattern[1:] if _is_relative(value) else pattern


def named_by(path: Column, values: list[str]) -> Column:
    """Is ``path`` one of the files the inputs name?

    All plain paths are one set and all globs a few expressions, so thousands of inputs are
    planned as quickly as one.
    """
    found = []
    for schemed in (True, False):
        own = [v for v in map(local_form, values) if _has_scheme(v) == schemed]
        at = path if schemed else _without_scheme(path)
        plain = sorted({v for v in own if not has_glob(v) and not _is_relative(v)})
        if plain:
            found.append(at.isin(plain))
        patterns = sorted({_pattern(v) for v in own if has_glob(v)} | {"/" + re.escape(v) + "$" for v in own if not has_glob(v) and _is_relative(v)})
        for i in range(0, len(patterns), PATTERNS_AT_ONCE):
            found.append(at.rlike("|".join(f"(?:{p})" for p in patterns[i : i + PATTERNS_AT_ONCE])))
    return reduce(lambda a, b: a | b, found)


def scan(spark: SparkSession, values: list[str], **text_options) -> DataFrame:
    """Text scan over exactly the files the inputs name.

    This condition, and any further one on ``_metadata``, uses file metadata only, so Spark
    applies it to the file listing and never opens the other files. Recursive lookup makes
    overlapping inputs count once.
    """
    with listing_by_few_tasks(spark):
        text = spark.read.text(scan_roots(values), recursiveFileLookup=True, **text_options)
    return text.where(named_by(plain_path(F.col(FILE_PATH)), values))


def list_files(spark: SparkSession, values: list[str]) -> DataFrame:
    """Distinct ``path``, ``name`` and ``suffix`` of the files the inputs name.

    Reads no content. The result stays a DataFrame; sort it by ``path`` for reading order.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        with listing_by_few_tasks(spark):
            files = reader.load([scan_root(v) for v in values])
    except AnalysisException as err:
        raise InputError(f"input does not exist or matches no file: {', '.join(values)}") from err
    return (
        files.select(local_path(F.col("path")).alias("path"))
        .where(named_by(F.col("path"), values))
        .distinct()
        .select("path", file_name(F.col("path")).alias("name"), extension(F.col("path")).alias("suffix"))
    )


def _fixed_folder(value: str) -> str:
    """The folder above the first glob sign of a path."""
    parts = value.split("/")
    return "/".join(parts[: next(i for i, part in enumerate(parts) if has_glob(part))])


def input_matches(spark: SparkSession, files: DataFrame, values: list[str]) -> DataFrame:
    """``input`` (place in ``values``) and ``path`` of every file that an input names.

    Inputs are a table. They meet files by equal keys: the path, the folder above the first
    glob sign (of which a file has as many as it lies deep), or the last parts of a relative
    path; then each file is held against the patterns that are left.
    """
    rows, lengths = [], set()
    for i, value in enumerate(map(local_form, values)):
        kind, depth = "path", value.count("/") + 1
        if has_glob(value):
            kind, key = ("any", "") if _is_relative(value) else ("folder", _fixed_folder(value))
        elif _is_relative(value):
            kind, key = f"last {depth}", value
            lengths.add(depth)
        else:
            key = value
        rows.append((i, kind, key, _has_scheme(value), _pattern(value) if has_glob(value) else None))
    inputs = spark.createDataFrame(rows, "input int, kind string, key string, schemed boolean, pattern string")

    def key(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("key"))

    path = F.col("at")
    parts = F.split(path, "/")
    folders = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: key("folder", F.array_join(F.slice(parts, 1, n), "/")))
    lasts = [key(f"last {n}", F.substring_index(path, "/", -n)) for n in sorted(lengths)]
    keys = F.concat(F.array(key("path", path), key("any", F.lit("")), *lasts), folders)
    forms = F.array(F.struct(F.lit(True).alias("schemed"), F.col("path").alias("at")), F.struct(F.lit(False).alias("schemed"), _without_scheme(F.col("path")).alias("at")))
    asked = files.select("path", F.explode(forms).alias("f")).select("path", "f.schemed", "f.at")
    asked = asked.select("path", "schemed", "at", F.explode(keys).alias("k")).select("path", "schemed", "at", "k.kind", "k.key")
    met = asked.join(inputs, ["schemed", "kind", "key"])
    return met.where(F.col("pattern").isNull() | F.rlike("at", F.col("pattern"))).select("input", "path")


def check_inputs(spark: SparkSession, values: list[str]) -> int:
    """Refuse inputs that name no regular file and compressed files; give the number of files.

    One row of counts comes back, and at most one of the inputs without a file.
    """
    if not values:
        raise InputError("no input is given")
    files = list_files(spark, values)
    path = F.col("path")
    found = files.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(is_gzip(path), path)).alias("gzip")).first()
    named = input_matches(spark, files, values).select("input").distinct()
    every = spark.range(len(values)).select(F.col("id").cast("int").alias("input"))
    missing = every.join(named, "input", "left_anti").agg(F.min("input")).first()[0]
    if missing is not None:
        value = values[missing]
        raise InputError(f"no file matches: {value}" if has_glob(value) else f"no such file: {value}")
    if found["gzip"]:
        raise InputError(f"cannot read this compressed file: {found['gzip']}")
    return found["n"]
