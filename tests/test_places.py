"""Line and document numbers of refused documents, at any size of input splits."""

import gzip

import pytest
from test_sources import split_at, write  # noqa: F401

from docferry.sources import places
from docferry.sources.files import read_documents, read_jsonl_files, read_toon_docs


def found(df):
    return sorted((r.path.rsplit("/", 1)[-1], r.line, r.document, r.error) for r in places.error_places(df).collect())


@pytest.mark.parametrize("size", [13, 1_000_000])
def test_lines(spark, tmp_path, split_at, size):  # noqa: F811
    split_at(size)
    data = '{"a":1}\n[1]\n\n{"a":2}\n{"a":\n' + '{"b":1}\n' * 20 + "x\n"
    path = write(tmp_path / "d.ndjson", data)
    want = [("d.ndjson", n, None, e) for n, e in ((2, "not a JSON object"), (3, "blank line"), (5, "invalid JSON"), (26, "invalid JSON"))]
    assert found(read_documents(spark, path)) == want
    packed = write(tmp_path / "d.ndjson.gz", gzip.compress(data.encode()))
    assert [x[1] for x in found(read_documents(spark, packed))] == [2, 3, 5, 26]
    write(tmp_path / "l" / "a.jsonl", data)
    write(tmp_path / "l" / "b[1].jsonl", "\n\n\n3\n")
    write(tmp_path / "l" / "good.jsonl", '{"a":1}\n')
    got = found(read_jsonl_files(spark, f"{tmp_path}/l/*"))
    assert [(name, line) for name, line, _, _ in got] == [("a.jsonl", 2), ("a.jsonl", 5), ("a.jsonl", 26), ("b[1].jsonl", 4)]


@pytest.mark.parametrize("size", [13, 1_000_000])
def test_csv(spark, tmp_path, split_at, size):  # noqa: F811
    split_at(size)
    path = write(tmp_path / "d.csv", 'a,b\n1,"x\ny"\n1\n\n2,"\n\n"\n1,2,3\n4,"open\n5,6\n')
    assert [(line, e) for _, line, _, e in found(read_documents(spark, path))] == [
        (4, "row length differs from header"), (9, "row length differs from header"), (10, "quoted value is not closed"),
    ]


@pytest.mark.parametrize("size", [13, 1_000_000])
def test_toon_documents(spark, tmp_path, split_at, size):  # noqa: F811
    split_at(size)
    path = write(tmp_path / "m.toon", "id: 1\n---\n[1]: 2\n---\nrows[2]{id}:\n  1\n  2\n --- \nrows[3]{id}:\n  1\n---\r\nid: 5\n---\n---\n[1]: a")
    table = write(tmp_path / "t.toon", "rows[3]{id}:\n  1\n  2\n")
    assert [x[1:] for x in found(read_toon_docs(spark, path))] == [(None, 2, "not an object"), (None, 4, "declared length differs"), (None, 6, "not an object")]
    assert [x[1:] for x in found(read_toon_docs(spark, table))] == [(None, 1, "declared length differs")]


def test_mixed_files_and_clean_ones(spark, tmp_path, monkeypatch):
    for name, data in {
        "a.json": "[1]", "b.jsonl": '{"x":1}\n2\n', "c.toon": "[1]: 1\n", "d.yml": "- 1\n", "e.txt": "text", "f.json": '{"a":1}',
    }.items():
        write(tmp_path / "m" / name, data)
    got = found(read_documents(spark, f"{tmp_path}/m/*"))
    assert [(n, line, doc) for n, line, doc, _ in got] == [("a.json", None, None), ("b.jsonl", 2, None), ("c.toon", None, 1), ("d.yml", None, None)]

    def never(*args, **more):
        raise AssertionError("a clean file is read again")

    monkeypatch.setattr(places, "_scan", never)
    write(tmp_path / "clean.ndjson", '{"a":1}\n' * 3)
    assert found(read_documents(spark, str(tmp_path / "clean.ndjson"))) == []
