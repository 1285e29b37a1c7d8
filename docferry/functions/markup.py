"""Column expressions over document text: frontmatter, chunks, flat YAML, tabular TOON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docferry.functions.json_text import json_string



def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


# Number spelling in JSON.
JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def split_frontmatter(text: Column) -> Column:
    """``struct(front, body)``; ``front`` is null when the text has no frontmatter.

    The block opens with ``---`` on the first line and closes with ``---`` on a line of
    its own or at the end of the text. A closing line ended by CRLF is looked for first.
    """
    rest = F.when(F.startswith(text, F.lit("---\r\n")), F.substr(text, F.lit(6))).when(
        F.startswith(text, F.lit("---\n")), F.substr(text, F.lit(5))
    )
    crlf = F.instr(rest, "\n---\r\n")
    lf = F.instr(rest, "\n---\n")
    at_end = F.endswith(rest, F.lit("\n---"))
    front = (
        F.when(crlf > 0, F.left(rest, crlf - 1))
        .when(lf > 0, F.left(rest, lf - 1))
        .when(at_end, F.left(rest, F.length(rest) - 4))
    )
    body = (
        F.when(crlf > 0, F.substr(rest, crlf + 6))
        .when(lf > 0, F.substr(rest, lf + 5))
        .when(at_end, F.lit(""))
        .otherwise(text)
    )
    return F.struct(front.alias("front"), body.alias("body"))


def split_chunks(text: Column) -> Column:
    """Non-blank chunks between lines that hold only ``---``."""
    chunks = F.split(text, r"(?md)^[ \t]*---[ \t\r]*$\n?")
    return F.filter(chunks, lambda c: ~c.rlike(r"\A\s*\z"))


def flat_yaml(text: Column) -> Column:
    """JSON object for YAML made of plain ``key: value`` lines, null for any other YAML.

    Only spellings whose YAML meaning is beyond doubt are taken here; the rest is left
    to the YAML library (see ``docferry.functions.yaml_udf``).
    """
    lines = F.filter(F.split(text, r"\r?\n"), lambda line: ~line.rlike(r"^\s*$"))
    return let(lines, _flat_yaml_lines)


def _flat_yaml_lines(lines: Column) -> Column:
    # Starts with a letter or digit and holds no YAML punctuation.
    plain = r"^[A-Za-z_][A-Za-z0-9_-]*:[ ]+[A-Za-z0-9]([A-Za-z0-9 _./()-]*[A-Za-z0-9_./()-])?[ ]*$"
    # Spellings another rule of YAML could claim: exponents, leading zeros, other bases, special words.
    unsure = r"(?i)^([0-9].*[eE_].*|0[0-9xob].*|null|true|false|[0-9]+\.?[0-9]*)$"

    def value(raw: Column) -> Column:
        return (
            F.when(raw.rlike(r"^(true|True|TRUE)$"), F.lit("true"))
            .when(raw.rlike(r"^(false|False|FALSE)$"), F.lit("false"))
            .when(raw.rlike(r"^(null|Null|NULL)$"), F.lit("null"))
            .when(raw.rlike(r"^(0|[1-9][0-9]{0,17})(\.[0-9]+)?$"), raw)
            .when(raw.rlike(unsure), F.lit(None).cast("string"))
            .otherwise(json_string(raw))
        )

    def key(line: Column) -> Column:
        return F.substring_index(line, ":", 1)

    def field(line: Column) -> Column:
        raw = F.trim(F.substr(line, F.length(key(line)) + 2))
        return F.concat(json_string(key(line)), F.lit(":"), let(raw, value))

    simple = (
        (F.size(lines) > 0)
        & F.forall(lines, lambda line: line.rlike(plain))
        & F.forall(lines, lambda line: ~key(line).rlike(r"(?i)^(null|true|false)$"))
        # A repeated key is an error in YAML; the library reports it.
        & (F.size(F.array_distinct(F.transform(lines, key))) == F.size(lines))
    )

    def joined(fields: Column) -> Column:
        sure = F.forall(fields, lambda f: f.isNotNull())
        return F.when(sure, F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}")))

    return F.when(simple, let(F.transform(lines, field), joined))


def _toon_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r'(?:^|,) *("(?:[^"\\]|\\.)*+"|[^,"]*?) *(?=,|$)'), F.lit(1))


def _toon_value(token: Column) -> Column:
    # A quoted token uses a subset of the JSON escapes, so it is a JSON string already.
    return (
        F.when(F.startswith(token, F.lit('"')), token)
        .when(token.isin("true", "false", "null"), token)
        .when(token.rlike(JSON_NUMBER), token)
        .otherwise(json_string(token))
    )


def _toon_key(raw: Column) -> Column:
    return F.when(F.startswith(raw, F.lit('"')), raw).otherwise(json_string(raw))


_KEY = r'("(?:[^"\\]|\\.)*+"|[^\s:"\[\]{}]+)'
_TABLE = rf"^{_KEY}\[([0-9]+)\]\{{(.+)\}}:[ ]*$"
_INLINE = rf"^{_KEY}\[([0-9]+)\]:(?: (.*))?$"
_SCALAR = rf"^{_KEY}: (.*)$"
# A value that opens a quote must be one whole quoted string.
_WHOLE_SCALAR = rf'^{_KEY}: (?!\s*").*$|^{_KEY}: "(?:[^"\\]|\\.)*+"\s*$'


def toon_documents(text: Column) -> Column:
    """``struct(docs array<string>, error)`` for one TOON document.

    Covers one top-level table, which gives one document per row, and flat blocks of
    ``key: value`` and ``key[n]: a,b`` lines, which give one document.
    """
    lines = F.filter(F.split(text, r"\r?\n"), lambda line: ~line.rlike(r"^\s*$"))
    return let(lines, _toon_lines)


def _toon_lines(lines: Column) -> Column:
    first = F.get(lines, F.lit(0))
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    is_table = first.rlike(_TABLE) & F.forall(rest, is_toon_row)
    is_flat = F.forall(lines, lambda line: line.rlike(_WHOLE_SCALAR) | line.rlike(_INLINE))
    other = F.when(first.rlike(r"^\[[0-9]+\]"), "not an object").otherwise("unsupported block")
    return (
        F.when(is_table, let(rest, lambda rows: _toon_table(first, rows)))
        .when(is_flat, _toon_flat(lines))
        .otherwise(_toon_result(None, other))
    )


def _toon_result(docs: Column | None, error: Column) -> Column:
    docs = F.array().cast("array<string>") if docs is None else docs
    return F.struct(docs.alias("docs"), error.cast("string").alias("error"))


def _declared(line: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(line, pattern, 2).try_cast("bigint"), F.lit(-1))


ROW_WIDTH = "row width differs from header"


def is_toon_header(line: Column) -> Column:
    return line.rlike(_TABLE)


def is_toon_row(line: Column) -> Column:
    return line.rlike(r"^ {2}\S")


def toon_header(line: Column) -> Column:
    """Field names of a table header, as JSON strings."""
    return F.transform(_toon_tokens(F.regexp_extract(line, _TABLE, 3)), _toon_key)


def toon_width(line: Column) -> Column:
    """Number of values in a table row."""
    return F.size(_toon_tokens(F.trim(line)))


def toon_length(line: Column) -> Column:
    """Number of rows a table header declares."""
    return _declared(line, _TABLE)


def toon_row(fields: Column, line: Column) -> Column:
    """JSON object of one table row, null when it has not one value per field."""

    def joined(tokens: Column) -> Column:
        pairs = F.zip_with(fields, tokens, lambda k, v: F.concat(k, F.lit(":"), _toon_value(v)))
        return F.when(
            F.size(tokens) == F.size(fields), F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
        )

    return let(_toon_tokens(F.trim(line)), joined)


def _toon_table(first: Column, lines: Column) -> Column:
    """Documents of a table; the lines are those below its header."""

    def rows_of(fields: Column) -> Column:
        return F.transform(lines, lambda line: toon_row(fields, line))

    def result(rows: Column) -> Column:
        error = (
            F.when(F.size(rows) == 0, "no rows")
            .when(F.size(rows) != _declared(first, _TABLE), "declared length differs")
            .when(F.exists(rows, lambda r: r.isNull()), ROW_WIDTH)
        )
        return F.when(error.isNull(), _toon_result(rows, error)).otherwise(_toon_result(None, error))

    return let(let(toon_header(first), rows_of), result)


def _toon_flat(lines: Column) -> Column:
    """The one document of a flat block."""

    def listed(line: Column, tokens: Column) -> Column:
        values = F.concat(F.lit("["), F.array_join(F.transform(tokens, _toon_value), ","), F.lit("]"))
        return F.when(F.size(tokens) == _declared(line, _INLINE), values)

    def value(line: Column) -> Column:
        inline = F.regexp_extract(line, _INLINE, 3)
        tokens = F.when(inline == "", F.array().cast("array<string>")).otherwise(_toon_tokens(inline))
        scalar = F.trim(F.regexp_extract(line, _SCALAR, 2))
        return F.when(line.rlike(_INLINE), let(tokens, lambda t: listed(line, t))).otherwise(let(scalar, _toon_value))

    def item(line: Column) -> Column:
        return F.concat(_toon_key(F.regexp_extract(line, r"^" + _KEY, 1)), F.lit(":"), value(line))

    def result(items: Column) -> Column:
        first = F.get(lines, F.lit(0))
        lone = (F.size(lines) == 1) & first.rlike(_INLINE)
        error = (
            F.when(F.exists(items, lambda i: i.isNull()), "declared length differs")
            .when(lone & (_declared(first, _INLINE) == 0), "no rows")
            .when(lone, "row is not an object")
        )
        doc = F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}"))
        return F.when(error.isNull(), _toon_result(F.array(doc), error)).otherwise(_toon_result(None, error))

    return let(F.transform(lines, item), result)
