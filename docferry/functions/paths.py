"""Column expressions over paths, URLs and media types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffix -> input kind.
SUFFIX_KINDS = {
    "csv": "csv",
    "ndjson": "ndjson",
    "json": "json",
    "toon": "toon",
    "md": "file",
    "markdown": "file",
    "txt": "file",
    "text": "file",
    "log": "file",
    "yml": "file",
    "yaml": "file",
    "jsonl": "file",
}

# Parts of a media type -> input kind, in order of preference.
MEDIA_KINDS = [
    ("csv", ["text/csv", "application/csv"]),
    ("ndjson", ["application/x-ndjson", "application/ndjson"]),
    ("json", ["application/json"]),
    ("toon", ["application/toon", "application/x-toon", "text/toon"]),
]

GLOB_CHARS = "*?["


def has_glob(value: str) -> bool:
    return any(c in GLOB_CHARS for c in value)


def local_path(uri: Column) -> Column:
    """A URI without its ``file:`` scheme; other schemes stay."""
    return (
        F.when(F.startswith(uri, F.lit("file:///")), F.substr(uri, F.lit(8)))
        .when(F.startswith(uri, F.lit("file:/")), F.substr(uri, F.lit(6)))
        .otherwise(uri)
    )


def plain_path(file_path: Column) -> Column:
    """``_metadata.file_path`` as a user would type it: decoded, local scheme removed."""
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return local_path(F.when(F.contains(file_path, F.lit("%")), decoded).otherwise(file_path))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case text after the last dot of the file name; null when there is none."""
    found = F.regexp_extract(file_name(path), r"^.+\.([^.]*)$", 1)
    return F.when(found != "", F.lower(found))


def kind_of_path(path: Column) -> Column:
    """Input kind by suffix, null when the suffix is not known."""
    lowered = F.lower(path)
    known = F.create_map(*[F.lit(x) for pair in SUFFIX_KINDS.items() for x in pair])
    return (
        F.when(F.endswith(lowered, F.lit(".csv.gz")), "csv")
        .when(F.endswith(lowered, F.lit(".ndjson.gz")), "ndjson")
        .otherwise(F.try_element_at(known, extension(path)))
    )


def is_gzip(path: Column) -> Column:
    return F.endswith(F.lower(path), F.lit(".gz"))


def input_gzip_refused(path: Column) -> Column:
    """Only ``.csv.gz`` and ``.ndjson.gz`` may be read compressed."""
    return is_gzip(path) & ~F.lower(path).rlike(r"\.(csv|ndjson)\.gz$")


def output_gzip_refused(path: Column) -> Column:
    """Only ``.ndjson.gz`` may be written compressed."""
    return is_gzip(path) & ~F.endswith(F.lower(path), F.lit(".ndjson.gz"))


def output_error(path: Column, n_inputs: Column) -> Column:
    """Why documents of so many inputs cannot be written to a path; null when they can."""
    several = (n_inputs > 1) & ~F.lower(path).rlike(r"\.ndjson(\.gz)?$")
    return F.when(output_gzip_refused(path), "compressed").when(several, "several inputs")


def url_path(url: Column) -> Column:
    """Path part of a URL; works on malformed URLs too."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def classify_format(url: Column, content_type: Column) -> Column:
    """``struct(kind, error)`` of a remote source: by URL suffix, else by media type."""
    path = url_path(url)
    by_path = kind_of_path(path)
    media = F.lower(content_type)
    by_media = F.lit(None).cast("string")
    for kind, parts in reversed(MEDIA_KINDS):
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.contains(media, F.lit(part))
        if kind == "json":
            hit = hit | F.endswith(media, F.lit("+json"))
        by_media = F.when(hit, kind).otherwise(by_media)
    kind = F.when(is_gzip(path), None).otherwise(F.coalesce(by_path, by_media))
    # Whole-file kinds exist only for local files.
    kind = F.when(kind != "file", kind)
    error = F.when(is_gzip(path), "gzip").when(kind.isNull(), "unsupported")
    return F.struct(kind.alias("kind"), error.alias("error"))


def glob_regex(pattern: str) -> str:
    """Regular expression for a glob: ``*`` and ``?`` stay inside one path segment,
    ``**`` spans any number of them, ``[a-z]`` and ``[!a-z]`` are classes."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if pattern.startswith("**/", i):
            out.append("(?:[^/]+/)*")
            i += 3
        elif pattern.startswith("**", i):
            out.append(".*")
            i += 2
        elif c == "*":
            out.append("[^/]*")
            i += 1
        elif c == "?":
            out.append("[^/]")
            i += 1
        elif c == "[" and (end := pattern.find("]", i + 2)) > 0:
            body = pattern[i + 1 : end]
            negate = body.startswith("!")
            body = re.sub(r"([\\\[\]^&])", r"\\\1", body[1:] if negate else body)
            out.append(f"(?!/)[{'^' if negate else ''}{body}]")
            i = end + 1
        else:
            out.append(re.escape(c))
            i += 1
    return "^" + "".join(out) + "$"
