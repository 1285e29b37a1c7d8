"""Comparison with plain Python on generated input."""

import json
import re

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docferry.functions.json_text import is_json_object, json_string, root_shape
from docferry.functions.markup import flat_yaml, split_chunks, split_frontmatter
from docferry.functions.patterns import match_patterns, template_match
from docferry.sinks.bulk import cut_batches

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
many = settings(max_examples=200, deadline=None)


def apply(spark, texts, build):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[0] for r in df.select(build(F.col("x")).alias("v"), "i").orderBy("i").collect()]


def strict_object(text):
    def refuse(_):
        raise ValueError

    try:
        return isinstance(json.loads(text.strip(" \t\r\n"), parse_constant=refuse), dict)
    except (ValueError, RecursionError):
        return False


json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(st.characters(codec="utf-8"), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(st.characters(codec="utf-8"), max_size=5), inner, max_size=3),
    max_leaves=8,
)
documents = st.dictionaries(st.text(st.characters(codec="utf-8"), max_size=5), json_values, max_size=4).map(
    lambda d: json.dumps(d, ensure_ascii=False)
)


@st.composite
def damaged(draw):
    text = draw(documents)
    at = draw(st.integers(0, len(text)))
    return text[:at] + draw(st.sampled_from(["", "x", "{", "}", "]", '"', ",", " ", "\\", "'", "0", "\t"])) + text[at + draw(st.integers(0, 1)) :]


@few
@given(st.lists(documents | damaged(), min_size=40, max_size=60))
def test_json_objects(spark, texts):
    assert apply(spark, texts, is_json_object) == [strict_object(t) for t in texts]
    shapes = apply(spark, texts, root_shape)
    assert [s == "object" for s in shapes] == [strict_object(t) for t in texts]


@few
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\0")), min_size=30, max_size=40))
def test_json_strings(spark, texts):
    assert [json.loads(v) for v in apply(spark, texts, json_string)] == texts


pieces = st.lists(st.sampled_from(["---", "\n", "\r\n", "a: b", "é", " ", "x"]), max_size=12).map("".join)


def plain_frontmatter(text):
    opened = re.match(r"---\r?\n", text)
    if not opened:
        return None, text
    rest = text[opened.end() :]
    for mark in ("\n---\r\n", "\n---\n"):
        if mark in rest:
            return tuple(rest.split(mark, 1))
    return (rest[:-4], "") if rest.endswith("\n---") else (None, text)


@few
@given(st.lists(pieces, min_size=60, max_size=80))
def test_frontmatter(spark, texts):
    texts = texts + ["---\n" + t for t in texts]
    assert [tuple(v) for v in apply(spark, texts, split_frontmatter)] == [plain_frontmatter(t) for t in texts]


def plain_chunks(text):
    chunks, held = [], []
    for line in text.splitlines(keepends=True) + ["---"]:
        if line.strip() == "---":
            if "".join(held).strip():
                chunks.append("".join(held))
            held = []
        else:
            held.append(line)
    return chunks


@few
@given(st.lists(pieces, min_size=60, max_size=80))
def test_chunks(spark, texts):
    assert apply(spark, texts, split_chunks) == [plain_chunks(t) for t in texts]


parts = st.lists(st.sampled_from(["a", "b", "*", "-", "_", "%", ".", ",", "ab"]), min_size=1, max_size=8).map("".join)
names = st.text("ab_%.", min_size=1, max_size=5)


def plain_match(patterns, name):
    matched = False
    for part in filter(None, (p.strip() for p in patterns.split(","))):
        exclude, bare = part.startswith("-"), part.removeprefix("-")
        if re.fullmatch(".*".join(map(re.escape, bare.split("*"))), name, re.S):
            matched = not exclude
    return matched


@few
@given(st.lists(parts.filter(lambda p: "-" not in p.split(",")), min_size=20, max_size=30), names)
def test_patterns(spark, patterns, name):
    bodies = [json.dumps({"index_patterns": p}) for p in patterns]
    expected = [plain_match(p, name) for p in patterns]
    assert apply(spark, bodies, lambda x: template_match(x, F.lit(name))["matched"]) == expected
    one = spark.range(1).select(*[match_patterns(F.lit(name), p).alias(f"c{i}") for i, p in enumerate(patterns)]).first()
    assert list(one) == expected


@many
@given(st.lists(st.lists(st.text(st.characters(codec="utf-8"), max_size=4), max_size=9), max_size=5), st.integers(1, 7))
def test_cut_batches(groups, size):
    groups = [[line + "\n" for line in g] for g in groups]
    lines = [line for g in groups for line in g]
    batches = (pa.RecordBatch.from_arrays([pa.array(g, pa.string())], ["line"]) for g in groups)
    expected = [lines[i : i + size] for i in range(0, len(lines), size)]
    assert list(cut_batches(batches, size)) == [("".join(e).encode(), len(e)) for e in expected]


plain_yaml = st.lists(
    st.tuples(st.from_regex(r"[a-z_]{1,4}", fullmatch=True), st.from_regex(r"[A-Za-z0-9._/ -]{1,9}", fullmatch=True)), min_size=1, max_size=4
).map(lambda pairs: "\n".join(f"{k}: {v}" for k, v in pairs))


@few
@given(st.lists(plain_yaml, min_size=50, max_size=60))
def test_flat_yaml_agrees_with_the_library(spark, texts):
    from docferry.functions import yaml_udf

    if yaml_udf.yaml is None:
        return
    for text, got in zip(texts, apply(spark, texts, flat_yaml)):
        if got is not None:
            assert json.loads(got) == yaml_udf.yaml.load(text, Loader=yaml_udf._loader()), text
