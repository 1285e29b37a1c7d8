import json

import pytest
from pyspark.sql import functions as F

from docferry.functions import json_text as J
from docferry.functions import markup as M
from docferry.functions import paths as P
from docferry.functions import patterns as R
from docferry.functions.yaml_udf import yaml_object


def values(spark, rows, build, ddl="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], ddl)
    df = df.withColumn("_i", F.monotonically_increasing_id())
    return [r[0] for r in df.select(build(F.col("x")).alias("v"), "_i").orderBy("_i").collect()]


VALID = ['{"a":1}', '{"a":1,"a":2}', '  {"a": 1}\r', '{"a":1e999}', "{}", '{"a":"\\ud800"}', '{"a":' + "9" * 60 + "}"]
INVALID = [
    "", "{", '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}] x', '{"a":1}} x', "{'a':1}", '{"a":NaN}',
    '{"a":01}', '{"a":1,}', '{"a":"x\ty"}', '{"a":.5}', '{"a":/*c*/1}', '{a:1}', '{"a":True}', '{"a":"\\x"}',
    '\ufeff{"a":1}',
]
OTHER = ["[1]", "1", "null", '"{"', "true"]


def test_json_object_is_strict(spark):
    assert values(spark, VALID, J.is_json_object) == [True] * len(VALID)
    assert values(spark, INVALID + OTHER, J.is_json_object) == [False] * len(INVALID + OTHER)


def test_root_shape(spark):
    assert values(spark, ["{}", " [1]", "1", "{"], J.root_shape) == ["object", "array", "other", "invalid"]


def test_long_document_is_valid(spark):
    doc = F.concat(F.lit('{"a":"'), F.repeat(F.lit("x"), 20 << 20), F.lit('"}'))
    assert spark.range(1).select(J.is_json_object(doc)).first()[0]


def test_json_string_round_trips(spark):
    texts = ['a "q" \\ \n \t é 中 \x01', "", "}", "x"]
    assert [json.loads(v) for v in values(spark, texts, J.json_string)] == texts


def test_compact_keeps_numbers(spark):
    assert values(spark, ['{\n "a": 1.0,\n "b": "x y"\n}\n'], J.compact) == ['{"a":1.0,"b":"x y"}']


def test_content_and_metadata(spark):
    assert values(spark, ["l1\nl2"], lambda x: J.wrap_content(x, "body")) == ['{"content":{"body":"l1\\nl2"}}']
    docs = ["{}", "{ }", '{"a":1.0}', '{"file":"old","a":2}']
    got = values(spark, docs, lambda x: J.add_file_metadata(x, F.lit("/d/f.md"), F.lit("f.md")))
    meta = {"path": "/d/f.md", "name": "f.md"}
    assert [json.loads(g) for g in got] == [{"file": meta}, {"file": meta}, {"a": 1.0, "file": meta}, {"a": 2, "file": meta}]
    assert '"a":1.0' in got[2]


@pytest.mark.parametrize("bad", ["", "a.b"])
def test_content_field_rules(bad):
    with pytest.raises(ValueError):
        J.check_content_field(bad)


def test_bulk_lines(spark):
    assert values(spark, ['{"a":1}'], lambda x: J.bulk_line("create", x)) == ['{"create":{}}\n{"a":1}\n']
    assert values(spark, ['{"a":1}'], lambda x: J.bulk_line("index", x)) == ['{"index":{}}\n{"a":1}\n']
    assert values(spark, ['{"a":1}'], lambda x: J.bulk_line("update", x, F.lit('q"1'))) == [
        '{"update":{"_id":"q\\"1"}}\n{"doc":{"a":1}}\n'
    ]
    with pytest.raises(ValueError):
        J.bulk_line("delete", F.lit("{}"))


def test_frontmatter(spark):
    cases = {
        "---\ntitle: a\n---\nbody\n": ("title: a", "body\n"),
        "---\r\ntitle: a\r\n---\r\nbody": ("title: a\r", "body"),
        "---\ntitle: a\n---": ("title: a", ""),
        "---\n---\nx": (None, "---\n---\nx"),
        "no\n---\nx\n---\n": (None, "no\n---\nx\n---\n"),
        "----\nx\n---\n": (None, "----\nx\n---\n"),
        "---\nunclosed": (None, "---\nunclosed"),
        "---\na: 1\n---\nx\n---\r\ny": ("a: 1\n---\nx", "y"),  # the CRLF close is looked for first
        "---\na: é\n---\nb\n---\nc": ("a: é", "b\n---\nc"),
    }
    got = values(spark, list(cases), M.split_frontmatter)
    assert [tuple(g) for g in got] == list(cases.values())


def test_split_chunks(spark):
    got = values(spark, ["---\na\n---\n \n---\r\nb\nc\n --- \nd---\n---", "x"], M.split_chunks)
    assert [[c.strip() for c in g] for g in got] == [["a", "b\nc", "d---"], ["x"]]


def test_flat_yaml(spark):
    got = values(spark, ["title: A b\nn: 3\nf: 1.5\nok: true\nz: null\nd: 2024-01-02\n"], M.flat_yaml)
    assert json.loads(got[0]) == {"title": "A b", "n": 3, "f": 1.5, "ok": True, "z": None, "d": "2024-01-02"}
    beyond = ["a: [1]", "a:\n  b: 1", "a: 'q'", "a: x # c", "a: 1e5", "a: 007", "a: b: c", "- a", "", "a: 1\na: 2", "a: |\n  x", "a: *b"]
    assert values(spark, beyond, M.flat_yaml) == [None] * len(beyond)


def test_yaml_object(spark):
    pytest.importorskip("yaml")
    text = "a: [1, x]\nb:\n  c: yes\n  d: 2024-01-02\n  e: ~\nn: 1e3\nz: 007\nh: 0x1f\n5: k\nt: 12:30:00\n"
    got = values(spark, [text, "k: v", "- a\n- b", "a: 1\na: 2", "a: [", "just text"], yaml_object)
    assert json.loads(got[0]["doc"]) == {
        "a": [1, "x"], "b": {"c": "yes", "d": "2024-01-02", "e": None}, "n": 1000.0, "z": "007", "h": 31, "5": "k",
        "t": "12:30:00",
    }
    assert json.loads(got[1]["doc"]) == {"k": "v"} and got[1]["error"] is None
    assert got[2]["error"] == "not a mapping"
    assert "repeated key" in got[3]["error"]
    assert got[4]["error"] and got[5]["error"]


def test_toon(spark):
    table = 'rows[2]{id,@ts,name,"q k"}:\n  1,2026-01-01T00:00:00Z,"a,\\"b",true\n  -2.50,x y,,null\n'
    cases = [
        table, "id: 1\nname: Al Pha\nactive: true\ntags[2]: s,1\nnone[0]:\nt: 10:30\nq: \"a: b\"\nz: 007",
        "id: 1\nitems[2]: a", "[2]: a,b", "items[2]: a,b", "rows[0]{a}:", "rows[2]{a}:\n  1", "rows[1]{a,b}:\n  1",
        "a:\n  b: 1", "only: 1", 'a: "open', "items[0]:",
    ]
    got = values(spark, cases, M.toon_documents)
    rows = [json.loads(d) for d in got[0]["docs"]]
    assert rows == [
        {"id": 1, "@ts": "2026-01-01T00:00:00Z", "name": 'a,"b', "q k": True},
        {"id": -2.5, "@ts": "x y", "name": "", "q k": None},
    ]
    assert json.loads(got[1]["docs"][0]) == {
        "id": 1, "name": "Al Pha", "active": True, "tags": ["s", 1], "none": [], "t": "10:30", "q": "a: b", "z": "007",
    }
    assert [g["error"] for g in got[2:]] == [
        "declared length differs", "not an object", "row is not an object", "no rows",
        "declared length differs", "row width differs from header", "unsupported block", None, "unsupported block",
        "no rows",
    ]
    assert got[9]["docs"] == ['{"only":1}']


def test_kind_of_path(spark):
    cases = {
        "a.csv": "csv", "A.CSV.GZ": "csv", "x/y.ndjson.gz": "ndjson", "a.json": "json", "a.toon": "toon", "a.MD": "file",
        "a.jsonl": "file", "a.gz": None, "a": None, ".json": None, "d.json/a": None, "a.txt.gz": None,
    }
    assert values(spark, list(cases), P.kind_of_path) == list(cases.values())


def test_gzip_rules(spark):
    paths = ["a.csv.gz", "a.NDJSON.gz", "a.json.gz", "a.txt", ".gz"]
    assert values(spark, paths, P.input_gzip_refused) == [False, False, True, False, True]
    assert values(spark, paths, P.output_gzip_refused) == [True, False, True, False, True]


def test_classify_format(spark):
    cases = [
        ("https://h/a.csv?x=1.json", None, "csv", None), ("https://h/a.csv.gz", "text/csv", None, "gzip"),
        ("https://h/a", "application/NDJSON; charset=utf-8", "ndjson", None), ("https://h/a", "application/x+json", "json", None),
        ("https://h/a.md", "text/csv", None, "unsupported"), ("https://h/", None, None, "unsupported"),
        ("https://h/a", "text/toon", "toon", None), ("https://h/a", "text/html", None, "unsupported"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "u string, c string").coalesce(1)
    got = [tuple(r[0]) for r in df.select(P.classify_format(F.col("u"), F.col("c"))).collect()]
    assert got == [c[2:] for c in cases]


def test_glob_regex():
    import re

    def hit(pattern, path):
        return re.match(P.glob_regex(pattern), path) is not None

    assert hit("/d/*.md", "/d/a.md") and not hit("/d/*.md", "/d/s/a.md")
    assert hit("/d/**/*.md", "/d/a.md") and hit("/d/**/*.md", "/d/s/t/a.md")
    assert hit("/d/[ab]?.x", "/d/a1.x") and not hit("/d/[!ab]?.x", "/d/a1.x")
    assert hit("/d/{a}.x*", "/d/{a}.x")


PATTERNS = [
    ("test*", True), ("test*,-test3", False), ("test3*,-test3,test*", True), (["logs-*"], False), ("*", True),
    ("t_st3", False), ("te%", False), ("*st3", True), ("", False), (" test3 ,", True), ("t*s*3", True), ("TEST3", False),
]


def test_match_patterns(spark):
    for patterns, expected in PATTERNS:
        assert values(spark, ["test3"], lambda x: R.match_patterns(x, patterns)) == [expected], patterns
    with pytest.raises(ValueError):
        R.match_patterns(F.lit("a"), "a,-")


def test_template_match(spark):
    bodies = [json.dumps({"index_patterns": p}) for p, _ in PATTERNS]
    got = values(spark, bodies, lambda x: R.template_match(x, F.lit("test3")))
    assert [(g["matched"], g["error"]) for g in got] == [(e, None) for _, e in PATTERNS]
    bad = ["{}", '{"index_patterns":1}', '{"index_patterns":"-"}', '{"index_patterns":["a",2]}']
    got = values(spark, bad, lambda x: R.template_match(x, F.lit("a")))
    assert [g["matched"] for g in got] == [None] * 4 and all(g["error"] for g in got)
    order = '{"index_patterns":["a*","-ab","ab*,-abc"]}'
    got = values(spark, ["a", "ab", "abc", "abd"], lambda x: R.template_match(F.lit(order), x)["matched"])
    assert got == [True, True, False, True]


def test_default_pipeline(spark):
    bodies = [
        '{"template":{"settings":{"index.default_pipeline":"p1","index":{"default_pipeline":"p2"}}}}',
        '{"template":{"settings":{"index":{"default_pipeline":"p2"}}}}',
        '{"template":{"settings":{"index.default_pipeline":5,"index":{"default_pipeline":"p2"}}}}',
        '{"template":{}}',
    ]
    assert values(spark, bodies, R.default_pipeline) == ["p1", "p2", "p2", None]
