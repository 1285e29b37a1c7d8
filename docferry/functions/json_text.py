"""Column expressions over JSON text. All run on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_SPACE = " \t\r\n"

# Strict JSON, and no limit on the length of a string or number.
STRICT = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxStringLen": "2147483647",
    "maxNumLen": "2147483647",
}


def trim_json(text: Column) -> Column:
    """Cut JSON white space at both ends, and nothing else."""
    return F.btrim(text, F.lit(JSON_SPACE))


def is_json(text: Column) -> Column:
    """True when the text is exactly one strict JSON value.

    Spark's parsers stop after the first value and ignore what follows it. Here the
    text is followed by its own hash inside one array: the hash comes back as second
    element only if the text in front of it was one whole value.
    """
    mark = F.xxhash64(text).cast("string")
    wrapped = F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]"))
    values = F.from_json(wrapped, "array<string>", STRICT)
    return F.coalesce(F.try_element_at(values, F.lit(2)) == mark, F.lit(False))


def is_json_object(text: Column) -> Column:
    """True when the text is one strict JSON object.

    Same idea as ``is_json``, with a schema that names no field of the document: the
    parser checks all of it but copies nothing.
    """
    mark = F.xxhash64(text).cast("string")
    wrapped = F.concat(F.lit("["), text, F.lit(',{"_docferry_mark":"'), mark, F.lit('"}]'))
    values = F.from_json(wrapped, "array<struct<_docferry_mark: string>>", STRICT)
    second = F.try_element_at(values, F.lit(2))
    opens = F.startswith(F.ltrim(text, F.lit(JSON_SPACE)), F.lit("{"))
    return F.coalesce(opens & (second["_docferry_mark"] == mark), F.lit(False))


def root_shape(text: Column) -> Column:
    """``object``, ``array`` or ``other`` for JSON text, ``invalid`` for anything else."""
    head = F.substring(F.ltrim(text, F.lit(JSON_SPACE)), 1, 1)
    return (
        F.when(~is_json(text), "invalid")
        .when(head == "{", "object")
        .when(head == "[", "array")
        .otherwise("other")
    )


def json_string(text: Column) -> Column:
    """The text as a quoted JSON string."""
    # to_json has no form for a bare string: render an object and cut '{"x":' and '}' off.
    rendered = F.to_json(F.struct(text.alias("x")), {"ignoreNullFields": "false"})
    return F.substr(rendered, F.lit(6), F.length(rendered) - 6)


def compact(doc: Column) -> Column:
    """One-line form of a valid document that spans several lines."""
    return F.get(F.from_json(F.concat(F.lit("["), doc, F.lit("]")), "array<string>", STRICT), F.lit(0))


def json_map(doc: Column) -> Column:
    """Top-level fields as ``map<string,variant>``; of repeated keys the last is kept."""
    return F.map_from_entries(F.map_entries(F.from_json(doc, "map<string,variant>", STRICT)))


def _is_empty_object(doc: Column) -> Column:
    return doc.rlike(r"\A\{\s*\}\z")


def join_objects(left: Column, right: Column) -> Column:
    """Put the fields of two JSON objects, which share no key, into one object.

    Works on the text, so numbers keep their spelling.
    """
    return (
        F.when(_is_empty_object(left), right)
        .when(_is_empty_object(right), left)
        .otherwise(F.concat(F.substr(left, F.lit(1), F.length(left) - 1), F.lit(","), F.substr(right, F.lit(2))))
    )


def has_key(doc: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(doc), key), F.lit(False))


def drop_key(doc: Column, key: str) -> Column:
    """The document without one top-level key; text unchanged when it is absent."""
    kept = F.map_filter(json_map(doc), lambda k, _: k != F.lit(key))
    return F.when(has_key(doc, key), F.to_json(kept)).otherwise(doc)


def wrap_content(text: Column, field: str) -> Column:
    """``{"content":{field: text}}``"""
    check_content_field(field)
    return F.to_json(F.struct(F.struct(text.alias(field)).alias("content")), {"ignoreNullFields": "false"})


def wrap_fields(fields: Column) -> Column:
    """``{"content": fields}`` for fields that are already a JSON object."""
    return F.concat(F.lit('{"content":'), fields, F.lit("}"))


def add_file_metadata(doc: Column, path: Column, name: Column) -> Column:
    """Add ``file.path`` and ``file.name``, in place of any ``file`` key already there."""
    meta = F.to_json(F.struct(F.struct(path.alias("path"), name.alias("name")).alias("file")))
    return join_objects(trim_json(drop_key(doc, "file")), meta)


def check_content_field(field: str) -> str:
    """The content field is a single, plain key."""
    if not field:
        raise ValueError("the content field needs a name")
    if "." in field:
        raise ValueError("the content field is one key, without dots")
    return field


def content_field_error(field: Column) -> Column:
    """Why a text cannot be the content field; null when it can."""
    return F.when(F.coalesce(field, F.lit("")) == "", "no name").when(F.contains(field, F.lit(".")), "has dots")


def bulk_line(action: str, doc: Column, id: Column | None = None) -> Column:
    """Action line and document line of one bulk operation, each with its newline."""
    if action in ("create", "index"):
        return F.concat(F.lit(f'{{"{action}":{{}}}}\n'), doc, F.lit("\n"))
    if action == "update":
        if id is None:
            raise ValueError("an update needs the id column")
        return F.concat(
            F.lit('{"update":{"_id":'), json_string(id), F.lit('}}\n{"doc":'), doc, F.lit("}\n")
        )
    raise ValueError(f"unknown bulk action: {action}")
