"""Column expressions that match target names against index patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(patterns: str | list[str]) -> list[str]:
    given = [patterns] if isinstance(patterns, str) else list(patterns)
    parts = [p.strip() for text in given for p in text.split(",")]
    parts = [p for p in parts if p]
    if "-" in parts:
        raise ValueError("a '-' needs a pattern after it")
    return parts


def _wildcard(name: Column, pattern: str) -> Column:
    # LIKE with a literal pattern: Catalyst turns it into startsWith, endsWith or contains.
    like = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")
    return name.like(like)


def match_patterns(name: Column, patterns: str | list[str]) -> Column:
    """Does ``name`` match a pattern list that is known when the plan is built?

    ``*`` stands for any run of characters, a leading ``-`` excludes, and the last
    part that matches decides.
    """
    parts = _parts(patterns)
    result = F.lit(False)
    for part in parts:  # a later part takes precedence over those before it
        exclude = part.startswith("-")
        result = F.when(_wildcard(name, part[1:] if exclude else part), F.lit(not exclude)).otherwise(result)
    return result


def template_match(body: Column, name: Column) -> Column:
    """``struct(matched, error)`` for a template body (JSON text) and a target name, per row."""
    variant = F.try_parse_json(body)
    raw = F.try_variant_get(variant, "$.index_patterns", "variant")
    shape = F.schema_of_variant(raw)
    elements = F.try_variant_get(raw, "$", "array<variant>")
    given = F.when(shape == "STRING", F.array(F.try_variant_get(raw, "$", "string"))).when(
        F.startswith(shape, F.lit("ARRAY")), elements.cast("array<string>")
    )
    only_text = F.forall(elements, lambda e: F.schema_of_variant(e) == "STRING")
    parts = F.filter(
        F.flatten(F.transform(given, lambda g: F.transform(F.split(g, ","), lambda p: F.btrim(p, F.lit(" \t\r\n"))))), lambda p: p != ""
    )

    def regex(part: Column) -> Column:
        bare = F.regexp_replace(part, "^-", "")
        # Quote everything, then open the quotes around each star.
        safe = F.replace(bare, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        return F.concat(F.lit("(?s)^\\Q"), F.replace(safe, F.lit("*"), F.lit("\\E.*\\Q")), F.lit("\\E$"))

    hits = F.filter(parts, lambda p: F.rlike(name, regex(p)))
    last = F.try_element_at(hits, F.lit(-1))
    matched = F.coalesce(~F.startswith(last, F.lit("-")), F.lit(False))
    error = (
        F.when(variant.isNull() | raw.isNull(), "no index_patterns")
        .when(given.isNull(), "index_patterns is neither text nor a list")
        .when(~only_text, "index_patterns lists something other than text")
        .when(F.array_contains(parts, "-"), "a '-' needs a pattern after it")
    )
    return F.struct(F.when(error.isNull(), matched).alias("matched"), error.alias("error"))


def default_pipeline(body: Column) -> Column:
    """Default ingest pipeline a template body names, flat key first, then nested."""
    variant = F.try_parse_json(body)

    def text_at(path: str) -> Column:
        found = F.try_variant_get(variant, path, "variant")
        return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))

    return F.coalesce(
        text_at("$.template.settings['index.default_pipeline']"),
        text_at("$.template.settings.index.default_pipeline"),
    )
