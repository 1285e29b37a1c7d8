import csv
import gzip
import io
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from docferry.operators.validate import DocumentError, check_documents, enforce, rejected, require_all_objects
from docferry.sources.csv import HeaderError, ends_quoted, read_csv_docs
from docferry.sources.files import (
    read_documents,
    read_file_documents,
    read_json_files,
    read_jsonl_files,
    read_markdown_files,
    read_text_files,
    read_toon_docs,
    read_yaml_files,
)
from docferry.sources.listing import InputError, check_inputs, input_matches, list_files, named_by
from docferry.sources.ndjson import read_ndjson


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def rows(df):
    return df.orderBy("path", "block_start", "pos").collect()


def docs(df):
    return [json.loads(r["doc"]) for r in rows(df)]


def test_ndjson_keeps_text(spark, tmp_path):
    lines = ['{"a": 1.0,  "b":"x"}', '{"b":2,"a":[1, 2]}']
    path = write(tmp_path / "d.ndjson", "  " + lines[0] + "\r\n" + lines[1])
    got = rows(read_ndjson(spark, path))
    assert [r["doc"] for r in got] == lines
    assert got[0]["path"] == path and got[0]["name"] == "d.ndjson" and got[0]["error"] is None


def test_ndjson_bare_cr_does_not_split(spark, tmp_path):
    path = write(tmp_path / "d.ndjson", '{"a":\r1}\n{"a":2}\n')
    assert docs(read_ndjson(spark, path)) == [{"a": 1}, {"a": 2}]


def test_ndjson_errors(spark, tmp_path):
    path = write(tmp_path / "d.ndjson", b'{"a":1}\n\n[1]\n{"a":\n{"a":"\xff"}\n')
    got = read_ndjson(spark, path)
    assert [r["error"] for r in rows(got)] == [None, "blank line", "not a JSON object", "invalid JSON", "invalid UTF-8"]
    with pytest.raises(Exception, match="blank line"):
        enforce(got).collect()
    with pytest.raises(DocumentError, match="blank line .4 in error"):
        enforce(got, "gate")
    with pytest.raises(DocumentError):
        require_all_objects(got)
    assert enforce(got, "keep").count() == 1 and rejected(got).count() == 4
    assert check_documents(got.select("doc")).where("error is null").count() == 1


def test_ndjson_order_over_splits(spark, tmp_path):
    path = write(tmp_path / "d.ndjson", "".join(f'{{"i":{i}}}\n' for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = read_ndjson(spark, path)
        assert df.select("block_start").distinct().count() > 3
        assert [d["i"] for d in docs(df)] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gzip_ndjson(spark, tmp_path):
    path = write(tmp_path / "d.NDJSON.GZ", gzip.compress(b'{"a":1}\n{"a":2}\n'))
    assert docs(read_documents(spark, path)) == [{"a": 1}, {"a": 2}]


def test_pretty_json(spark, tmp_path):
    path = write(tmp_path / "d.json", '{\n  "a": {\n    "b": 1.50\n  }\n}\n')
    got = rows(read_documents(spark, path))
    assert len(got) == 1 and "\n" not in got[0]["doc"] and json.loads(got[0]["doc"]) == {"a": {"b": 1.5}}
    bad = write(tmp_path / "two.json", '{\n"a":1}\n{"b":2}\n')
    assert [r["error"] for r in rows(read_documents(spark, bad))] == ["invalid JSON"]
    lines = write(tmp_path / "lines.json", '{"a":1}\n{"a":2}\n')
    assert docs(read_documents(spark, lines)) == [{"a": 1}, {"a": 2}]


CSV = 'name,count,note\nx,1,\n"a, ""b""",02,"two\nlines"\n\n y ,,z\n'
CSV_DOCS = [
    {"name": "x", "count": "1", "note": ""},
    {"name": 'a, "b"', "count": "02", "note": "two\nlines"},
    {"name": " y ", "count": "", "note": "z"},
]


@pytest.mark.parametrize("suffix", ["csv", "csv.gz", "CSV"])
def test_csv(spark, tmp_path, suffix):
    data = CSV.encode()
    path = write(tmp_path / f"d.{suffix}", gzip.compress(data) if suffix.endswith("gz") else data)
    got = read_documents(spark, path)
    assert docs(got) == CSV_DOCS and rejected(got).count() == 0


def test_csv_widths_and_names(spark, tmp_path):
    path = write(tmp_path / "d.csv", "a,b\n1,2\n1\n1,2,3\n")
    got = [r["error"] for r in rows(read_csv_docs(spark, path))]
    assert got == [None, "row length differs from header", "row length differs from header"]
    same = write(tmp_path / "e.csv", "a,b,a\n1,2,3\n")
    assert docs(read_csv_docs(spark, same)) == [{"a": "3", "b": "2"}]
    assert rows(read_csv_docs(spark, write(tmp_path / "f.csv", ""))) == []
    assert rows(read_csv_docs(spark, write(tmp_path / "g.csv", "a,b\n"))) == []


def test_csv_byte_order_mark_and_many_parts(spark, tmp_path):
    marked = write(tmp_path / "m.csv", b"\xef\xbb\xbfa,b\n1,2\n")
    assert docs(read_csv_docs(spark, marked)) == [{"a": "1", "b": "2"}]
    write(tmp_path / "parts" / "1.csv", "a,b\n1,2\n")
    write(tmp_path / "parts" / "2.csv", "a,b\n3,4\n")
    assert docs(read_csv_docs(spark, str(tmp_path / "parts"))) == [{"a": "1", "b": "2"}, {"a": "3", "b": "4"}]
    write(tmp_path / "parts" / "3.csv", "a,c\n5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_docs(spark, str(tmp_path / "parts")).collect()


@pytest.fixture
def split_at(spark):
    """Sets the size of input splits for the rest of a test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def put(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield put
    for name in names:
        spark.conf.unset(name)


def test_csv_does_not_depend_on_splits(spark, tmp_path, split_at):
    lines = "".join(f'{i},"q ""{i}"""\n{i},"a\nb"\n{i},li"t\r\n' for i in range(60))
    odd = write(tmp_path / "o.csv", "i,v\n" + lines + "  \n7,x\ry\n\n8,\"\n\n,\n\"\n" + lines)
    small = [(r["doc"], r["error"], r["pos"]) for r in rows(read_csv_docs(spark, odd))]
    assert sum(e is not None for _, e, _ in small) == 1 and len(small) == 363
    for size in (499,):
        split_at(size)
        split = read_csv_docs(spark, odd)
        assert [(r["doc"], r["error"], r["pos"]) for r in rows(split)] == small
        assert split.select("block_start").distinct().count() > 1


@pytest.mark.parametrize("size", [17, 10_000])
def test_csv_like_the_plain_reader(spark, tmp_path, split_at, size):
    """Random values, quoted as needed or always, as Python's reader gives them; records counted by line."""
    r = random.Random(size)
    parts = ["a", '"', '""', ",", "\n", "\r\n", " ", "é", "x,y", '"z', "", "\n\n"]
    given = [[str(i), *("".join(r.choices(parts, k=r.randint(0, 4))) for _ in range(2))] for i in range(15)]
    for quoting in (csv.QUOTE_MINIMAL, csv.QUOTE_ALL):
        out = io.StringIO(newline="")
        csv.writer(out, quoting=quoting, lineterminator=r.choice(["\n", "\r\n"])).writerows([["i", "v,\nw", "x"], *given])
        path = write(tmp_path / f"r{quoting}.csv", out.getvalue())
        split_at(size)
        got = rows(read_csv_docs(spark, path))
        assert [list(json.loads(x["doc"]).values()) for x in got] == given
        reader, starts = csv.reader(io.StringIO(out.getvalue(), newline="")), []
        while True:
            at = reader.line_num + 1
            if next(reader, None) is None:
                break
            starts.append(at)
        assert [x["pos"] for x in got] == starts[1:]


def test_csv_bad_bytes_and_open_quotes(spark, tmp_path, split_at):
    bad = write(tmp_path / "b.csv", b"i,v\n1,\xff\n2,x\n")
    left_open = write(tmp_path / "l.csv", 'i,v\n1,x\n2,"y\n' + "3,z\n" * 8)
    for size in (10_000, 6):
        split_at(size)
        assert [r["error"] for r in rows(read_csv_docs(spark, bad))] == ["invalid UTF-8", None]
        got = rows(read_csv_docs(spark, left_open))
        assert [(r["error"], r["pos"]) for r in got] == [(None, 2), ("quoted value is not closed", 3)]
    with pytest.raises(HeaderError):
        read_csv_docs(spark, write(tmp_path / "h.csv", 'i,"v\n1,x\n'))


@pytest.mark.parametrize("line, outside, inside", [
    (b"a,b", False, True), (b'a,"b', True, False), (b'"a","b"', False, False), (b'a"b,c', False, False), (b'"a""', True, False),
    (b'x",y', False, False), (b'x","y', True, True), (b"", False, True), (b'"', True, False), (b'""', False, True), (b'"a"b,"c', True, True),
])
def test_state_behind_a_line(line, outside, inside):
    assert (ends_quoted(line, False), ends_quoted(line, True)) == (outside, inside)


def test_csv_header_of_any_name(spark, tmp_path):
    named = write(tmp_path / "n.csv", "a`b,_docferry_corrupt\n1,2\n")
    assert docs(read_csv_docs(spark, named)) == [{"a`b": "1", "_docferry_corrupt": "2"}]


def test_long_quoted_toon_value(spark, tmp_path):
    text = "x\\n" * 50_000
    path = write(tmp_path / "long.toon", f'a: "{text}"\n')
    assert docs(read_toon_docs(spark, path)) == [{"a": "x\n" * 50_000}]


def corpus(root):
    write(root / "a.md", "---\ntitle: Alpha\norder: 1\n---\nBody A\n")
    write(root / "b.txt", "text b")
    write(root / "c.yml", "k: v\nlist: [1, 2]\n")
    write(root / "d.json", '{"x": 1.0, "file": "mine"}')
    write(root / "e.jsonl", '{"e":1}\n\n  \n{"e":2}\n')
    write(root / "f.csv", "h\n1\n")
    write(root / "g.toon", "rows[2]{id}:\n  1\n  2\n---\nid: 9\n")
    write(root / "README", "no suffix")
    write(root / "sub" / "h.ndjson", '{"h":1}\n')
    write(root / "sub" / "i+ %.md", "plain")


def test_mixed_files(spark, tmp_path):
    pytest.importorskip("yaml")
    root = tmp_path / "c"
    corpus(root)
    got = read_documents(spark, f"{root}/**/*")
    assert rejected(got).count() == 0

    def meta(name):
        return {"path": f"{root}/{name}", "name": name.split("/")[-1]}

    expected = {
        "README": [{"content": {"body": "no suffix"}}],
        "a.md": [{"content": {"title": "Alpha", "order": 1, "body": "Body A\n"}}],
        "b.txt": [{"content": {"body": "text b"}}],
        "c.yml": [{"content": {"k": "v", "list": [1, 2]}}],
        "d.json": [{"x": 1.0}],
        "e.jsonl": [{"e": 1}, {"e": 2}],
        "f.csv": [{"content": {"body": "h\n1\n"}}],
        "g.toon": [{"id": 1}, {"id": 2}, {"id": 9}],
        "sub/h.ndjson": [{"h": 1}],
        "sub/i+ %.md": [{"content": {"body": "plain"}}],
    }
    assert docs(got) == [{**d, "file": meta(n)} for n, ds in expected.items() for d in ds]


def test_globs(spark, tmp_path):
    root = tmp_path / "c"
    corpus(root)

    def names(*values):
        return [r["name"] for r in list_files(spark, list(values)).orderBy("path").collect()]

    assert names(f"{root}/*.md") == ["a.md"]
    assert names(f"{root}/**/*.md") == ["a.md", "i+ %.md"]
    assert names(f"{root}/[a-c].*") == ["a.md", "b.txt", "c.yml"]
    assert names(f"{root}/[!a-g]*") == ["README"]
    assert names(f"{root}/a.md", f"{root}/*.md", f"{root}/**/a.md", f"file://{root}/b.txt") == ["a.md", "b.txt"]
    assert check_inputs(spark, [f"{root}/*.md", f"{root}/a.md"]) == 1
    # Overlapping inputs give each document once; one file means no metadata.
    once = read_file_documents(spark, f"{root}/*.md", f"{root}/a.md")
    assert docs(once) == [{"content": {"title": "Alpha", "order": 1, "body": "Body A\n"}}]


def test_input_refusals(spark, tmp_path):
    root = tmp_path / "c"
    corpus(root)
    with pytest.raises(InputError, match="no file matches"):
        check_inputs(spark, [f"{root}/*.md", f"{root}/s*"])
    with pytest.raises(InputError, match="no such file"):
        check_inputs(spark, [f"{root}/a.md", f"{root}/sub"])
    with pytest.raises(InputError):
        read_documents(spark, f"{root}/none.md")
    with pytest.raises(InputError):
        read_documents(spark, f"{root}/*.none")
    write(root / "z.ndjson.gz", gzip.compress(b"{}\n"))
    with pytest.raises(InputError, match="compressed file"):
        read_documents(spark, f"{root}/*.gz")
    with pytest.raises(InputError, match="compressed file"):
        read_documents(spark, write(root / "z.json.gz", gzip.compress(b"{}")))
    for bad in ([], ["https://h/a.csv", f"{root}/a.md"], ["http://h/a.csv"]):
        with pytest.raises(InputError):
            read_documents(spark, *bad)
    with pytest.raises(ValueError):
        read_documents(spark, f"{root}/a.md", field="a.b")


def test_other_files_are_never_opened(spark, tmp_path):
    write(tmp_path / "ok.md", "x")
    write(tmp_path / "broken.txt.gz", "this is no gzip data")
    assert docs(read_markdown_files(spark, f"{tmp_path}/*.md")) == [{"content": {"body": "x"}}]


def test_single_file_kinds(spark, tmp_path):
    md = write(tmp_path / "a.md", "---\ntitle: T\n---\nB")
    assert docs(read_documents(spark, md, field="text")) == [{"content": {"title": "T", "text": "B"}}]
    assert docs(read_text_files(spark, md, field="t")) == [{"content": {"t": "---\ntitle: T\n---\nB"}}]
    clash = write(tmp_path / "b.md", "---\nbody: T\n---\nB")
    assert rows(read_markdown_files(spark, clash))[0]["error"] == "frontmatter has the content field"
    yml = write(tmp_path / "c.yaml", "body: x\n")
    assert rows(read_yaml_files(spark, yml))[0]["error"] == "YAML has the content field"
    assert docs(read_yaml_files(spark, yml, field="other")) == [{"content": {"body": "x"}}]
    bad = write(tmp_path / "d.txt", b"\xff\xfe")
    assert rows(read_documents(spark, bad))[0]["error"] == "not UTF-8 text"
    for text, error in [("[1]", "an array where"), ("1", "not one JSON object"), ("{", "not one JSON object")]:
        path = write(tmp_path / "e.json", text)
        assert error in rows(read_json_files(spark, path))[0]["error"]
    lines = write(tmp_path / "f.jsonl", '{"a":1}\n[1]\n{\n')
    assert [r["error"] for r in rows(read_jsonl_files(spark, lines))] == [None, "not a JSON object", "invalid JSON"]
    toon = write(tmp_path / "g.toon", "id: 1\n---\nitems[2]: a\n")
    got = rows(read_toon_docs(spark, toon))
    assert got[0]["doc"] == '{"id":1}' and got[1]["error"] == "declared length differs"


def test_toon_record_mode(spark, tmp_path):
    path = write(tmp_path / "m.toon", "---\nid: 1\n---\nrows[2]{id}:\n  2\n  3\n --- \nid: 4\r\n---\r\nid: 5\n---\n\n---\nid: 6")
    assert [d["id"] for d in docs(read_documents(spark, path))] == [1, 2, 3, 4, 5, 6]
    bad = rows(read_documents(spark, write(tmp_path / "b.toon", b"id: \xff\n---\n[1]: a")))
    assert [r["error"] for r in bad] == ["not UTF-8 text", "not an object"]


def test_large_toon_is_split(spark, tmp_path):
    many = write(tmp_path / "many.toon", "\n---\n".join(f"id: {i}\nname: n{i}" for i in range(1500)))
    body = "".join(f'  {i},"a,{i}"\r\n' for i in range(1500))
    table = write(tmp_path / "table.toon", "rows[1500]{id,name}:\r\n" + body)
    short = write(tmp_path / "short.toon", "rows[1501]{id,name}:\n" + body)
    wide = write(tmp_path / "wide.toon", "rows[1500]{id,name}:\n" + body.replace("  7,", "  7,7,"))
    two = write(tmp_path / "two.toon", "rows[1500]{id,name}:\n" + body + "---\nid: x\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_documents(spark, many)
        assert got.select("block_start").distinct().count() > 2
        assert docs(got) == [{"id": i, "name": f"n{i}"} for i in range(1500)]
        got = read_documents(spark, table)
        assert got.select("block_start").distinct().count() > 2
        assert docs(got) == [{"id": i, "name": f"a,{i}"} for i in range(1500)]
        assert [r["error"] for r in rows(read_documents(spark, short))] == ["declared length differs"]
        wrong = rows(rejected(read_documents(spark, wide)))
        assert [r["error"] for r in wrong] == ["row width differs from header"]
        assert docs(read_documents(spark, two))[-1] == {"id": "x"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_damaged_toon_table_of_any_size(spark, tmp_path):
    """A table with one wrong row or byte is refused whole, read in one piece or in many."""
    body = "".join(f"  {i},n{i}\n" for i in range(1500)).encode()
    for name, damaged, error in (
        ("width", body.replace(b"  7,", b"  7,7,"), "row width differs from header"),
        ("byte", body.replace(b"n9\n", b"n\xff\n"), "not UTF-8 text"),
        ("both", body.replace(b"  7,", b"  7,7,").replace(b"n9\n", b"n\xff\n"), "not UTF-8 text"),
    ):
        path = write(tmp_path / f"{name}.toon", b"rows[1500]{id,name}:\n" + damaged)
        small = [r.asDict() for r in read_documents(spark, path).collect()]
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        try:
            large = [r.asDict() for r in read_documents(spark, path).collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r["error"] for r in small] == [error] and large == small


def test_read_configs(spark, tmp_path):
    from docferry.sources.configs import read_configs

    write(tmp_path / "geo.v1.json", '{\n"a": 1.0}')
    write(tmp_path / "plain.txt", '{"b":2}')
    write(tmp_path / "bad.JSON", "{")
    write(tmp_path / "notes.json5", "{}")
    pytest.importorskip("yaml")
    write(tmp_path / "logs.YML", "index_patterns:\n  - logs-*\n")
    got = {r["name"]: r for r in read_configs(spark, f"{tmp_path}/*").collect()}
    assert got["geo.v1"]["body"] == '{"a":1.0}' and got["plain"]["body"] == '{"b":2}'
    assert json.loads(got["logs"]["body"]) == {"index_patterns": ["logs-*"]}
    assert got["bad"]["error"] == "template is not valid JSON" and got["bad"]["body"] is None
    assert "unsupported" in got["notes"]["error"]
    pipelines = {r["name"]: r["error"] for r in read_configs(spark, f"{tmp_path}/*", kind="pipeline").collect()}
    assert pipelines["geo.v1"] is None and pipelines["logs"] is None and "unsupported" in pipelines["plain"]


def test_pretty_files_are_chosen_one_by_one(spark, tmp_path):
    """A folder of both kinds is read right, whichever file is larger or comes first."""
    folder = tmp_path / "both"
    write(folder / "a.json", '{\n "a": 1.0,\n "b": [1,\n 2]\n}\n')
    write(folder / "b.json", '{"a":2}\n' * 50)
    write(folder / "c [x].json", "\r\n".join(["{", '"a":3', "}"]))
    write(folder / "d.json", "{\n")
    write(folder / "e.json", "")
    got = rows(read_ndjson(spark, str(folder)))
    assert [r["doc"] for r in got if r["name"] in ("a.json", "c [x].json")] == ['{"a":1.0,"b":[1,2]}', '{"a":3}']
    assert sum(r["doc"] == '{"a":2}' for r in got) == 50
    assert [(r["name"], r["error"]) for r in got if r["error"]] == [("d.json", "invalid JSON")]


def test_thousands_of_inputs(spark, tmp_path):
    """Plain paths and globs by the thousand are planned as a set and a few patterns."""
    for i in range(40):
        write(tmp_path / "d" / f"{i % 4}" / f"{i}.txt", str(i))
    plain = [f"{tmp_path}/d/{i % 4}/{i}.txt" for i in range(40)] * 50
    globs = [f"{tmp_path}/d/{i % 4}/{i}.t?t" for i in range(40)] + [f"{tmp_path}/d/[!1-3]/*.txt", f"{tmp_path}/**/3{'?'}.txt"] * 20
    values = plain + globs
    start = time.monotonic()
    assert check_inputs(spark, values) == 40
    condition = named_by(F.col("path"), values)._jc.toString()
    assert condition.count("RLIKE") <= 1 and time.monotonic() - start < 60
    got = input_matches(spark, list_files(spark, values), values)
    per = {r.input: r.n for r in got.groupBy("input").agg(F.countDistinct("path").alias("n")).collect()}
    assert all(per[i] == 1 for i in range(len(plain) + 40)) and per[len(plain) + 40] == 10 and per[len(plain) + 41] == 10
    with pytest.raises(InputError, match="no file.*/d/0/99.txt|no such file: .*/d/0/99.txt"):
        check_inputs(spark, [*plain[:3], f"{tmp_path}/d/0/99.txt"])
    with pytest.raises(InputError, match="matches no file|no file matches"):
        check_inputs(spark, [*plain[:3], f"{tmp_path}/d/*/*.md", *globs])
