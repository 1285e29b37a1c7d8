import gzip
import json
import urllib.error
import urllib.request
from io import BytesIO

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from recorder import Recorder

from docferry import load_to_bulk, load_to_ndjson
from docferry.operators.account import run_summary
from docferry.operators.batch import bulk_lines, checked_lines
from docferry.operators.target import TargetOptions
from docferry.operators.validate import DocumentError, enforce
from docferry.sinks.bulk import COMMITS_DDL, BulkTarget, cut_batches, register, write_bulk
from docferry.sinks.ndjson import OutputError, check_output, write_ndjson
from docferry.sinks.transport import BulkRequest, DryRun, HttpTransport
from docferry.sources.ndjson import read_ndjson
from docferry.streaming.lines import stream_bulk, stream_ndjson, stream_to_ndjson


def docs_of(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.to_json(F.struct("id", F.lit("é").alias("s"))).alias("doc"))


def requests_in(folder):
    pairs = [p.read_bytes().split(b"\n", 1) for p in folder.iterdir()]
    return [(target.decode(), body) for target, body in pairs]


def ids(body):
    return [json.loads(line)["id"] for line in body.decode().splitlines()[1::2]]


def test_cut_batches():
    table = pa.RecordBatch.from_pydict({"line": ["a\n", "bé\n", "c\n", "d\n", "e\n"]})
    got = list(cut_batches(iter([table, table.slice(0, 0), table.slice(2, 3)]), 3))
    assert got == [("a\nbé\nc\n".encode(), 3), (b"d\ne\nc\n", 3), (b"d\ne\n", 2)]
    assert list(cut_batches(iter([]), 3)) == []
    assert list(cut_batches(iter([table]), 5)) == [("a\nbé\nc\nd\ne\n".encode(), 5)]


def test_write_bulk(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    target = BulkTarget("idx", Recorder(seen), 100, pipeline="p q")
    replies = write_bulk(docs_of(spark, 1050), target, str(tmp_path / "replies"), max_requests=2)
    requests = requests_in(seen)
    assert {t for t, _ in requests} == {"/idx/_bulk?pipeline=p+q"}
    assert sorted(i for _, b in requests for i in ids(b)) == list(range(1050))
    sizes = [len(ids(b)) for _, b in requests]
    assert max(sizes) == 100 and sum(s < 100 for s in sizes) <= 3  # a short batch per parcel at most
    assert all(b.startswith(b'{"create":{}}\n{"id":') and b.endswith(b"}\n") for _, b in requests)
    assert replies.select("task").distinct().count() <= 2
    summary = run_summary(replies).first()
    assert (summary["n_docs"], summary["n_accepted"]) == (1050, 1050)


def test_retry_and_refusal():
    waits, answers = [], [(429, "{}")] * 7 + [(200, "ok")]
    target = BulkTarget("i", lambda request: answers.pop(0), sleep=waits.append)
    assert target.send(b"", 0) == (8, 200, "ok")
    assert waits == [1, 2, 4, 8, 16, 30, 30]
    assert BulkTarget("i", lambda r: (400, "bad")).send(b"", 0) == (1, 400, "bad")
    capped = BulkTarget("i", lambda r: (429, "busy"), max_attempts=3, sleep=waits.append)
    assert capped.send(b"", 0) == (3, 429, "busy")
    assert BulkTarget("i", lambda r: (503, "down")).send(b"", 0) == (1, 503, "down")
    with pytest.raises(RuntimeError):
        BulkTarget("i", lambda r: (503, "down"), fail_on_server_error=True).send(b"", 0)


@pytest.mark.parametrize("max_requests", [2, None])
def test_a_bad_document_repeats_no_other(spark, tmp_path, max_requests):
    (tmp_path / "a.ndjson").write_text("".join(f'{{"id":{i}}}\n' if i != 700 else "{\n" for i in range(1000)))
    seen = tmp_path / "seen"
    seen.mkdir()
    target, replies = BulkTarget("i", Recorder(seen), 50), str(tmp_path / "replies")
    docs = read_ndjson(spark, str(tmp_path / "a.ndjson"))
    with pytest.raises(DocumentError, match=r"a\.ndjson: invalid JSON \(1 in error"):
        write_bulk(docs, target, replies, max_requests=max_requests)
    good = [i for i in range(1000) if i != 700]
    assert sorted(i for _, b in requests_in(seen) for i in ids(b)) == good
    assert run_summary(spark.read.parquet(replies)).first()["n_docs"] == 999
    with pytest.raises(DocumentError, match="invalid JSON"):
        write_bulk(docs, target, replies, max_requests=max_requests, errors="gate")
    assert sum(len(ids(b)) for _, b in requests_in(seen)) == 999  # the gate sends nothing


def test_null_and_nameless_documents_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([(None,), ('{"_id":"a","v":1}',), ('{"v":2}',)], "doc string")
    for action, sent in (("create", 2), ("update", 1)):
        seen = tmp_path / action
        seen.mkdir()
        replies = write_bulk(docs, BulkTarget("i", Recorder(seen)), str(tmp_path / f"r-{action}"), action, errors="keep")
        assert run_summary(replies).first()["n_docs"] == sent
        with pytest.raises(DocumentError, match="no document|_id is missing"):
            write_bulk(docs, BulkTarget("i", Recorder(seen)), str(tmp_path / f"r-{action}"), action)
        assert sum(b.count(b"\n") for _, b in requests_in(seen)) == 2 * 2 * sent


def test_bad_line_stops_a_stream_before_sending(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.ndjson").write_text('{"id":1}\n[]\n')
    seen = tmp_path / "seen"
    seen.mkdir()
    for _ in range(2):  # also after a restart
        stream = stream_ndjson(spark, str(tmp_path / "in"))
        writer = stream_bulk(stream, BulkTarget("i", Recorder(seen)), str(tmp_path / "replies"), str(tmp_path / "ck"))
        with pytest.raises(Exception, match="not a JSON object"):
            writer.trigger(availableNow=True).start().awaitTermination()
    assert not requests_in(seen)


def test_load_counts_what_was_read_and_refused(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"a":1}\n{\n{"a":2}\n')
    inputs, refused = [f"{tmp_path}/a.ndjson"], str(tmp_path / "refused")
    row = load_to_bulk(spark, inputs, BulkTarget("i", DryRun()), errors="keep", refused_path=refused).first()
    assert (row["n_read"], row["n_refused"], row["n_docs"], row["n_accepted"]) == (3, 1, 2, 2)
    assert [r["error"] for r in spark.read.parquet(refused).collect()] == ["invalid JSON"]
    assert load_to_ndjson(spark, inputs, str(tmp_path / "out.ndjson"), errors="keep", refused_path=refused) == 2


def test_load_checks_its_target_first(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"id":1}\n')
    seen = tmp_path / "seen"
    seen.mkdir()
    inputs, target = [f"{tmp_path}/a.ndjson"], BulkTarget("logs", Recorder(seen))
    template = '{"index_patterns":["logs*"],"template":{"settings":{"index.default_pipeline":"geo"}}}'
    options = TargetOptions(template_name="t", template_body=template)
    with pytest.raises(ValueError, match="template pipeline is missing"):
        load_to_bulk(spark, [f"{tmp_path}/none.ndjson"], target, options=options)
    load_to_bulk(spark, inputs, target, options=TargetOptions("own", "{}"))
    load_to_bulk(spark, inputs, target, options=options, known_pipelines=spark.createDataFrame([("geo",)], "name string"))
    assert sorted(t for t, _ in requests_in(seen)) == ["/logs/_bulk", "/logs/_bulk?pipeline=own"]


def test_bulk_refuses_bad_settings(spark, tmp_path):
    with pytest.raises(ValueError):
        BulkTarget("", DryRun())
    with pytest.raises(ValueError):
        BulkTarget("i", DryRun(), batch_size=0)
    with pytest.raises(ValueError):
        write_bulk(docs_of(spark, 1), BulkTarget("i", DryRun()), str(tmp_path / "r"), max_requests=0)


def test_counts_of_refused_requests(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    target = BulkTarget("i", Recorder(seen, [(400, '{"error":{"type":"t"}}')]), 10)
    replies = write_bulk(docs_of(spark, 30, 1), target, str(tmp_path / "r"))
    assert [r["status"] for r in replies.orderBy("task", "seq").collect()] == [400, 200, 200]
    assert run_summary(replies).first()["n_accepted"] == 20


def test_data_source(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    register(spark)
    writer = bulk_lines(docs_of(spark, 25), "index").select("line").write.format("docferry_bulk").mode("append")
    writer.options(index="i", batchSize=10, folder=str(seen), transport="recorder:recorder_from_options").save()
    assert sorted(i for _, b in requests_in(seen) for i in ids(b)) == list(range(25))


def test_data_source_tells_what_it_did(spark, tmp_path):
    """Commits are rows; documents without a line are counted, before or after others, and fail nothing that sends."""
    seen = tmp_path / "seen"
    seen.mkdir()
    register(spark)
    docs = spark.range(0, 40, 1, 4).select(F.when(F.col("id") % 4 == 0, "{}").otherwise(F.format_string('{"_id":"k%d","id":%d}', "id", "id")).alias("doc"))
    writer = checked_lines(docs, "update").select("line").write.format("docferry_bulk").mode("append")
    writer = writer.options(index="i", batchSize=4, folder=str(seen), transport="recorder:recorder_from_options", commits=str(tmp_path / "c"))
    writer.save()
    rows = spark.read.schema(COMMITS_DDL).parquet(str(tmp_path / "c")).orderBy("task").collect()
    assert [(r.outcome, r.batch, r.task, r.n_docs) for r in rows] == [("sent", None, t, n) for t, n in enumerate((7, 8, 7, 8))]
    assert sum(r.n_refused for r in rows) == 10 and sum(r.n_requests for r in rows) == len(requests_in(seen)) == 8
    assert all(r.statuses == {200: r.n_requests} for r in rows)
    with pytest.raises(Exception, match="10 documents had no line"):
        writer.options(errors="failfast").save()
    assert sum(len(b.splitlines()) // 2 for _, b in requests_in(seen)) == 60  # all others were sent


def test_stream_data_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.ndjson").write_text("".join(f'{{"id":{i}}}\n' for i in range(12)))
    seen = tmp_path / "seen"
    seen.mkdir()
    register(spark)
    lines = bulk_lines(enforce(stream_ndjson(spark, str(tmp_path / "in")))).select("line")
    writer = lines.writeStream.format("docferry_bulk").option("checkpointLocation", str(tmp_path / "ck"))
    writer = writer.options(index="i", batchSize=5, folder=str(seen), transport="recorder:recorder_from_options")
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(i for _, b in requests_in(seen) for i in ids(b)) == list(range(12))
    assert {t for t, _ in requests_in(seen)} == {"/i/_bulk"}


class Reply(BytesIO):
    status = 200


def test_http_transport(monkeypatch):
    calls = []

    def urlopen(call, timeout, context):
        calls.append(call)
        if len(calls) > 3:
            raise urllib.error.HTTPError(call.full_url, 429, "busy", {}, BytesIO(b'{"error":"busy"}'))
        return Reply(b'{"errors":false}')

    monkeypatch.setattr(urllib.request, "urlopen", urlopen)
    request = BulkRequest("/i/_bulk", {"pipeline": "p"}, b"body\n", 1)
    assert HttpTransport("http://h:9/", api_key="k")(request) == (200, '{"errors":false}')
    assert calls[0].full_url == "http://h:9/i/_bulk?pipeline=p" and gzip.decompress(calls[0].data) == b"body\n"
    assert calls[0].get_header("Authorization") == "ApiKey k" and calls[0].get_header("Content-encoding") == "gzip"
    HttpTransport("http://h", username="u", password="p", compress=False)(request)
    assert calls[1].data == b"body\n" and calls[1].get_header("Authorization") == "Basic dTpw"
    assert calls[1].get_header("Content-type") == "application/x-ndjson"
    HttpTransport("https://h", insecure=True)(request)
    assert HttpTransport("http://h")(request) == (429, '{"error":"busy"}')
    for bad in ({"api_key": "k", "username": "u", "password": "p"}, {"username": "u"}, {"password": "p"}):
        with pytest.raises(ValueError):
            HttpTransport("http://h", **bad)


@pytest.mark.parametrize("suffix", [".ndjson", ".NDJSON.gz"])
def test_ndjson_round_trip(spark, tmp_path, suffix):
    path = str(tmp_path / f"out{suffix}")
    write_ndjson(docs_of(spark, 10), path)
    write_ndjson(docs_of(spark, 5), path)  # replaces
    back = read_ndjson(spark, path)
    assert sorted(r["doc"] for r in back.collect()) == sorted(r["doc"] for r in docs_of(spark, 5).collect())
    assert any(p.name.endswith(".gz") for p in (tmp_path / f"out{suffix}").iterdir()) == suffix.endswith("gz")


def test_output_rules():
    check_output("a.ndjson.gz", 3)
    check_output("a.txt", 1)
    for bad in (("a.json.gz", 1), ("a.gz", 1), ("a.json", 2)):
        with pytest.raises(OutputError):
            check_output(*bad)


def test_load_to_ndjson(spark, tmp_path):
    (tmp_path / "a.md").write_text("A")
    (tmp_path / "b.jsonl").write_text('{"b":1}\n{"b":2}\n')
    out = str(tmp_path / "out.ndjson")
    assert load_to_ndjson(spark, [f"{tmp_path}/*.md", f"{tmp_path}/b.jsonl"], out) == 3
    assert read_ndjson(spark, out).count() == 3
    with pytest.raises(OutputError):
        load_to_ndjson(spark, [f"{tmp_path}/a.md"], out, options=TargetOptions(pipeline_name="_none"))
    with pytest.raises(OutputError):
        load_to_ndjson(spark, [f"{tmp_path}/a.md", f"{tmp_path}/b.jsonl"], str(tmp_path / "x.txt"))
    # A bad document leaves the earlier output as it was.
    (tmp_path / "bad.ndjson").write_text('{"a":1}\n{\n')
    with pytest.raises(Exception, match="invalid JSON"):
        load_to_ndjson(spark, [f"{tmp_path}/bad.ndjson"], str(tmp_path / "new.ndjson"))
    assert not list((tmp_path / "new.ndjson").glob("part-*"))


def test_load_to_bulk(spark, tmp_path):
    (tmp_path / "u.csv").write_text("_id,v\na,1\nb,2\n")
    seen = tmp_path / "seen"
    seen.mkdir()
    summary = load_to_bulk(spark, [f"{tmp_path}/u.csv"], BulkTarget("i", Recorder(seen)), action="update").first()
    assert summary["summary"] == "2 of 2 docs accepted"
    assert [b for _, b in requests_in(seen)] == [
        b'{"update":{"_id":"a"}}\n{"doc":{"v":"1"}}\n{"update":{"_id":"b"}}\n{"doc":{"v":"2"}}\n'
    ]


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.ndjson").write_text("".join(f'{{"id":{i * 10 + j}}}\n' for j in range(10)))
    seen = tmp_path / "seen"
    seen.mkdir()

    def run():
        stream = stream_ndjson(spark, str(folder), max_files=1)
        writer = stream_bulk(stream, BulkTarget("i", Recorder(seen), 4), str(tmp_path / "replies"), str(tmp_path / "ck"))
        writer.trigger(availableNow=True).start().awaitTermination()

    run()
    assert sorted(i for _, b in requests_in(seen) for i in ids(b)) == list(range(30))
    replies = spark.read.parquet(str(tmp_path / "replies"))
    assert replies.select("batch").distinct().count() == 3
    assert run_summary(replies).first()["n_accepted"] == 30
    (folder / "3.ndjson").write_text('{"id":30}\n')
    run()  # goes on where it stopped
    assert sorted(i for _, b in requests_in(seen) for i in ids(b)) == list(range(31))

    out = str(tmp_path / "copy.ndjson.gz")
    copy = stream_to_ndjson(stream_ndjson(spark, str(folder)), out, str(tmp_path / "ck2"))
    copy.trigger(availableNow=True).start().awaitTermination()
    assert read_ndjson(spark, out).count() == 31
