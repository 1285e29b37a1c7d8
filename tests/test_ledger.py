"""Sending that is taken up where it stopped."""

import os

import pytest
from pyspark.sql import functions as F
from recorder import Breaking, Recorder
from test_sinks import docs_of, ids, requests_in

from docferry.operators.account import run_summary
from docferry.operators.validate import DocumentError
from docferry.sinks.bulk import BulkTarget, write_bulk
from docferry.streaming.lines import stream_bulk, stream_ndjson


@pytest.fixture
def seen(tmp_path):
    (tmp_path / "seen").mkdir()
    return tmp_path / "seen"


def sent(folder):
    return [i for _, body in requests_in(folder) for i in ids(body)]


def test_rounds_and_taking_up(spark, tmp_path, seen):
    """Rounds leave the rest to later calls, which need no documents; a finished load sends nothing more."""
    target, places = BulkTarget("i", Recorder(seen), 40), {"replies_path": str(tmp_path / "r"), "ledger": str(tmp_path / "l")}
    docs = docs_of(spark, 1000, 2)
    write_bulk(docs, target, **places, max_requests=3, parcel_docs=100, rounds=1)
    assert len(sent(seen)) == 300
    write_bulk(docs.limit(0), target, **places, max_requests=3, rounds=2)
    assert len(sent(seen)) == 900
    for _ in range(2):
        replies = write_bulk(docs, target, **places, max_requests=3)
        assert sorted(sent(seen)) == list(range(1000))
    per = replies.groupBy("parcel").agg(F.sum("n_docs").alias("n")).collect()
    assert len(per) == 10 and {r.n for r in per} == {100}
    assert not os.path.exists(tmp_path / "l" / "lines")


def test_a_lost_task_sends_its_parcel_again(spark, tmp_path, seen):
    """A task that breaks off leaves the replies of finished parcels in place; only parcels under way go out again."""
    places = {"replies_path": str(tmp_path / "r"), "ledger": str(tmp_path / "l")}
    target = BulkTarget("i", Breaking(seen, '"id":777,', tmp_path / "broken"), 10)
    docs = docs_of(spark, 2000, 4)
    with pytest.raises(Exception, match="connection lost"):
        write_bulk(docs, target, **places, max_requests=4, parcel_docs=50)
    kept = {r.parcel for r in spark.read.parquet(places["replies_path"]).select("parcel").distinct().collect()}
    assert kept  # finished before, and kept although the job failed
    replies = write_bulk(docs.limit(0), target, **places, max_requests=4)
    everything = sent(seen)
    assert set(everything) == set(range(2000))
    assert len(everything) - 2000 <= 4 * 50  # four parcels were under way at most
    assert run_summary(replies).first()["n_docs"] == 2000
    assert replies.groupBy("parcel", "seq").count().where("count > 1").isEmpty()


def test_gate_holds_when_taken_up(spark, tmp_path, seen):
    """Parcels that were staged before the gate was asked are asked again."""
    from docferry.operators.batch import checked_lines
    from docferry.sinks.ledger import Ledger

    docs = docs_of(spark, 10).withColumn("path", F.lit("f")).withColumn("error", F.when(F.col("doc").contains("7"), "bad"))
    staged = checked_lines(docs).select(F.when(F.col("error").isNull(), F.col("line")).alias("line"), "error", "path", "doc")
    Ledger(str(tmp_path / "l"), str(tmp_path / "r")).prepare(staged)
    with pytest.raises(DocumentError, match="f: bad \\(1 in error\\)"):
        write_bulk(docs, BulkTarget("i", Recorder(seen)), str(tmp_path / "r"), errors="gate", ledger=str(tmp_path / "l"))
    assert not sent(seen)


def test_refused_documents_are_kept(spark, tmp_path, seen):
    docs = docs_of(spark, 10).withColumn("path", F.lit("f")).withColumn("error", F.when(F.col("doc").contains("7"), "bad"))
    for limit in (2, None):
        refused = str(tmp_path / f"x{limit}")
        write_bulk(docs, BulkTarget("i", Recorder(seen)), str(tmp_path / "r"), errors="keep", max_requests=limit, refused_path=refused)
        assert [(r.path, r.error, "7" in r.doc) for r in spark.read.parquet(refused).collect()] == [("f", "bad", True)]
    assert sorted(sent(seen)) == sorted([i for i in range(10) if i != 7] * 2)


def test_ledger_needs_a_limit(spark, tmp_path, seen):
    with pytest.raises(ValueError):
        write_bulk(docs_of(spark, 1), BulkTarget("i", Recorder(seen)), str(tmp_path / "r"), max_requests=None, ledger=str(tmp_path / "l"))


def test_stream_takes_a_micro_batch_up(spark, tmp_path, seen):
    """A stream that breaks off within a micro-batch and starts again sends only what has no reply."""
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.ndjson").write_text("".join(f'{{"id":{i},"s":0}}\n' for i in range(k * 500, k * 500 + 500)))
    target = BulkTarget("i", Breaking(seen, '"id":620,', tmp_path / "broken"), 10)

    def run():
        stream = stream_ndjson(spark, str(tmp_path / "in"), max_files=2)
        writer = stream_bulk(stream, target, str(tmp_path / "r"), str(tmp_path / "ck"), max_requests=2, parcel_docs=50)
        writer.trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="connection lost"):
        run()
    run()
    everything = sent(seen)
    assert set(everything) == set(range(1000)) and len(everything) - 1000 <= 2 * 50
    assert spark.read.parquet(str(tmp_path / "r")).agg(F.sum("n_docs")).first()[0] == 1000
