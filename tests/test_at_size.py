"""What must not grow with the number of files, splits or parcels, on small rows."""

import json
import os
from contextlib import contextmanager

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from recorder import Recorder
from test_sinks import docs_of

from docferry.plans import catalog
from docferry.sinks.bulk import BulkTarget, write_bulk
from docferry.sources.csv import read_csv_docs
from docferry.sources.files import read_documents, read_toon_docs
from docferry.sources.listing import list_files


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k.replace("__", ".")) for k in values}
    for k, v in values.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k.replace("__", "."), v)


@contextmanager
def small_splits(spark, size):
    with settings(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=size):
        yield


@contextmanager
def tasks_of(spark, group):
    """Numbers of tasks of the stages run meanwhile, one list for each job."""
    jobs = []
    spark.sparkContext.setJobGroup(group, group)
    try:
        yield jobs
    finally:
        spark.sparkContext.setJobGroup("", "")
        tracker = spark.sparkContext.statusTracker()
        for job in tracker.getJobIdsForGroup(group):
            stages = [tracker.getStageInfo(s) for s in tracker.getJobInfo(job).stageIds]
            jobs.append([s.numTasks for s in stages if s is not None])


def folders(root, n):
    for i in range(n):
        (root / f"k={i}").mkdir(parents=True)
        (root / f"k={i}" / "a.txt").write_text(f"text {i}")


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    folders(tmp_path / "in", 90)
    with tasks_of(spark, "listing") as jobs:
        assert list_files(spark, [f"{tmp_path}/in/**/*.txt"]).count() == 90
        rows = read_documents(spark, f"{tmp_path}/in/**/*", f"{tmp_path}/in/k=7/**/*.txt").collect()
    assert len(rows) == 90 and {r.error for r in rows} == {None}
    assert max(max(j) for j in jobs if j) <= 30  # 90 folders would be 90 tasks


def test_overlapping_inputs_name_one_folder():
    from docferry.sources.listing import scan_roots

    assert scan_roots(["/a/**/*", "/a/md/**/*.md", "/ab/x.md", "/a/b/x.txt", "/c/*.md"]) == ["/a", "/ab/x.md", "/c/*.md"]
    assert scan_roots(["/a/b.txt", "/a/b.txt/c", "/**/*.md", "**/*.md"]) == ["/a/b.txt", "/a/b.txt/c", "/", "."]


@pytest.mark.parametrize("kind", ["txt", "json"])
def test_small_files_are_written_by_all_tasks(spark, tmp_path, kind):
    rows = [(i, f"n{i} ", i % 5) for i in range(200)] + [(200, "", 1), (201, None, 2), (202, "a", 3), (202, "b", 4)]
    suppliers = spark.createDataFrame(rows, "s_suppkey bigint, s_name string, s_nationkey int")
    with tasks_of(spark, f"files-{kind}") as jobs:
        catalog._one_file_each(suppliers, kind, str(tmp_path))
    assert any(n == 4 for j in jobs for n in j[1:])  # not one task behind the shuffle

    def text(key):
        (name,) = [f for f in os.listdir(tmp_path / kind / f"s_suppkey={key}") if f.endswith(f".{kind}")]
        return (tmp_path / kind / f"s_suppkey={key}" / name).read_text()

    if kind == "txt":
        assert (text(3), text(200), text(201)) == ("n3\nfrom 3\n", '""\nfrom 1\n', "from 2\n")
        assert text(202) in ("a\nb\nfrom 3\nfrom 4\n", "b\na\nfrom 4\nfrom 3\n", "a\nb\nfrom 4\nfrom 3\n", "b\na\nfrom 3\nfrom 4\n")
    else:
        assert [json.loads(text(k)) for k in (3, 201)] == [{"name": "n3 ", "nation": 3}, {"nation": 2}]


def test_parcels_need_no_job_each(spark, tmp_path):
    (tmp_path / "seen").mkdir()
    target = BulkTarget("i", Recorder(tmp_path / "seen"), 5)
    with tasks_of(spark, "parcels") as jobs:
        replies = write_bulk(docs_of(spark, 600, 2), target, str(tmp_path / "r"), max_requests=2, parcel_docs=10)
    assert replies.agg(F.sum("n_docs")).first()[0] == 600 and replies.select("parcel").distinct().count() == 60
    assert replies.groupBy("parcel").agg(F.count("*").alias("n"), F.max("seq").alias("last")).where("n <> last + 1").isEmpty()
    assert replies.select("task").distinct().count() == 2
    assert len(jobs) < 20  # 30 rounds of two parcels
    assert SparkSession.getActiveSession()._jsparkSession.equals(spark._jsparkSession)


def test_a_task_that_runs_again_sends_open_parcels_only(tmp_path):
    from docferry.sinks.ledger import _send_parcels

    calls = []

    def sender(batches):
        names = [p for b in batches for p in b.column("parcel").to_pylist()]
        calls.append(names)
        if len(calls) == 3:
            raise OSError("connection lost")
        yield pa.RecordBatch.from_pydict({"parcel": names[:1]})

    def rows():
        yield pa.RecordBatch.from_pydict({"line": list("abc"), "parcel": ["x", "x", "y"]})
        yield pa.RecordBatch.from_pydict({"line": list("de"), "parcel": ["y", "z"]})

    with pytest.raises(OSError):
        list(_send_parcels(sender, str(tmp_path))(rows()))
    assert [b.to_pydict() for b in _send_parcels(sender, str(tmp_path))(rows())] == [{"n": [1]}]
    assert calls == [["x", "x"], ["y", "y"], ["z"], ["z"]]
    assert sorted(f for f in os.listdir(tmp_path) if not f.startswith(".")) == ["replies-x", "replies-y", "replies-z"]


def test_open_values_at_the_end_of_an_arrow_batch(spark, tmp_path):
    """A value open where a batch of lines ends is closed later in the same block; one that nothing closes is refused."""
    text = "k,v\n" + "".join(f'{i},"one\n\ntwo ""{i}"""\n' for i in range(50))
    (tmp_path / "a.csv").write_text(text)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="7"):
        rows = sorted((r.pos, r.error, json.loads(r.doc)) for r in read_csv_docs(spark, str(tmp_path / "a.csv")).collect())
        assert rows == [(2 + 3 * i, None, {"k": str(i), "v": f'one\n\ntwo "{i}"'}) for i in range(50)]
        (tmp_path / "b.csv").write_text(text + 'x,"open\n' + "line\n" * 30)
        rows = read_csv_docs(spark, str(tmp_path / "b.csv")).orderBy("pos").collect()
    assert [r.error for r in rows] == [None] * 50 + ["quoted value is not closed"]


def test_documents_of_more_than_1023_splits(spark, tmp_path):
    n = 1500
    (tmp_path / "a.toon").write_text("---\n".join(f"id: {i}\nname: n{i}\n" for i in range(n)))
    with small_splits(spark, "16"):
        rows = read_toon_docs(spark, str(tmp_path / "a.toon")).orderBy("block_start", "pos").collect()
    assert [(json.loads(r.doc)["id"], r.error) for r in rows] == [(i, None) for i in range(n)]


def test_small_splits_are_read_by_few_tasks(spark, tmp_path):
    lines = [f'{i},"a\nb{i}"' for i in range(2000)]
    (tmp_path / "a.csv").write_text("k,v\n" + "\n".join(lines) + "\n")
    with small_splits(spark, "200"), tasks_of(spark, "splits") as jobs:
        rows = read_csv_docs(spark, str(tmp_path / "a.csv")).collect()
    assert sorted(int(json.loads(r.doc)["k"]) for r in rows) == list(range(2000))
    assert len({r.block_start for r in rows}) > 100
    counts = [n for j in jobs for n in j]
    assert sum(counts) < 200  # each of three passes would be 139 tasks


def test_packing_takes_few_texts_at_a_time(spark, monkeypatch):
    from docferry.llm import packing

    def counted(vocabulary, end_id):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                yield pa.RecordBatch.from_pydict(
                    {"id": batch.column(0), "part": pa.array([0] * n, pa.int32()), "place": list(range(n)), "n": [n] * n, "ids": [b"1234"] * n}
                )

        return run

    monkeypatch.setattr(packing, "_tokenise", counted)
    docs = spark.range(3000).coalesce(1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    staged, stage = [], packing.stage
    monkeypatch.setattr(packing, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    packing.pack(docs, "none")
    assert staged[0].count() == 3000 and staged[0].agg(F.max("n")).first()[0] <= 500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
