"""YAML mapping to JSON text, for YAML the flat form cannot express.

An Arrow UDF around the YAML library. It follows the YAML 1.2 core rules: only
true/false are booleans, dates stay text, a repeated key is an error.
"""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.markup import flat_yaml

try:
    import yaml
except ImportError:  # plain key/value YAML still works without it
    yaml = None


def _loader():
    class Core(getattr(yaml, "CSafeLoader", yaml.SafeLoader)):
        yaml_implicit_resolvers = {}

    def mapping(loader, node):
        pairs = [
            (loader.construct_object(k, deep=True), loader.construct_object(v, deep=True)) for k, v in node.value
        ]
        keys = [_key(k) for k, _ in pairs]
        if len(set(keys)) != len(keys):
            raise yaml.YAMLError("repeated key")
        return dict(zip(keys, (v for _, v in pairs)))

    def integer(_, node):
        text = node.value.replace("+", "")
        base = {"0x": 16, "0o": 8, "0b": 2}.get(text.lstrip("-")[:2], 10)
        return int(text, base)

    def real(_, node):
        value = float(node.value.replace(".inf", "inf").replace(".Inf", "inf").replace(".INF", "inf"))
        return value if math.isfinite(value) else None

    # Scalar spellings of the YAML 1.2 core schema.
    rules = [
        ("null", r"^(?:~|null|Null|NULL|)$", lambda *_: None),
        ("bool", r"^(?:true|True|TRUE|false|False|FALSE)$", lambda _, n: n.value.lower() == "true"),
        ("int", r"^[-+]?(?:0|[1-9][0-9]*)$|^[-+]?0x[0-9a-fA-F]+$|^[-+]?0o[0-7]+$|^[-+]?0b[01]+$", integer),
        (
            "float",
            r"^[-+]?(?:[0-9]*\.[0-9]+|[0-9]+\.?)(?:[eE][-+]?[0-9]+)?$|^[-+]?\.(?:inf|Inf|INF)$",
            real,
        ),
        ("nan", r"^\.(?:nan|NaN|NAN)$", lambda *_: None),
    ]
    for name, pattern, build in rules:
        tag = f"tag:yaml.org,2002:{name}"
        # Digits with a leading zero are text.
        compiled = re.compile(pattern if name != "float" else r"(?![-+]?0[0-9])" + pattern)
        Core.add_implicit_resolver(tag, compiled, None)
        Core.add_constructor(tag, build)
    Core.add_constructor("tag:yaml.org,2002:map", mapping)
    return Core


def _key(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (str, int, float)):
        return str(value)
    raise yaml.YAMLError("key must be a string")


_RESULT = T.StructType([T.StructField("doc", T.StringType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_RESULT)
def _parse(texts: pd.Series) -> pd.DataFrame:
    loader = _loader() if yaml else None
    rows = []
    for text in texts:
        if text is None:
            rows.append((None, None))
        elif loader is None:
            rows.append((None, "no YAML library for this document"))
        else:
            try:
                value = yaml.load(text, Loader=loader)
                if isinstance(value, dict):
                    rows.append((json.dumps(value, ensure_ascii=False), None))
                else:
                    rows.append((None, "not a mapping"))
            except (yaml.YAMLError, ValueError) as err:
                rows.append((None, str(err).replace("\n", " ")))
    return pd.DataFrame(rows, columns=["doc", "error"])


def yaml_object(text: Column) -> Column:
    """``struct(doc, error)``: the YAML mapping as JSON object text.

    Plain key/value YAML is handled on the JVM; only other rows send text to Python.
    """
    flat = flat_yaml(text)
    parsed = _parse(F.when(flat.isNull(), text))
    return F.struct(
        F.coalesce(flat, parsed["doc"]).alias("doc"), F.when(flat.isNull(), parsed["error"]).alias("error")
    )
