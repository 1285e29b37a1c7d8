import json

import pytest
from pyspark.sql import functions as F

from docferry.operators import account, batch, shape, target, validate
from docferry.operators.target import TargetOptions
from docferry.plans.load import check_target
from docferry.session import scratch_dir
from docferry.sources.files import concat_documents
from docferry.sources.ndjson import read_ndjson


def numbered(spark, n, parts=7):
    return spark.range(0, n, 1, parts).withColumn("key", F.xxhash64("id") % 1000)


def test_row_index_is_consecutive(spark):
    got = batch.with_row_index(numbered(spark, 10_000), ["key", "id"]).collect()
    ordered = sorted(got, key=lambda r: (r["key"], r["id"]))
    assert [r["row_index"] for r in ordered] == list(range(10_000))


def test_row_index_cuts_a_hot_source_into_several_tasks(spark):
    # A third of all rows come from one source.
    df = numbered(spark, 30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("key"))).alias("path"),
        F.lit(0).alias("block_start"),
        F.col("id").alias("pos"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ordered = df.orderBy("path", "block_start", "pos")
        sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 12_000
        assert ordered.where("path = 'hot'").select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    index = batch.with_row_index(df)
    wrong = index.groupBy("path").agg((F.max("row_index") - F.min("row_index") + 1 - F.count(F.lit(1))).alias("gap"))
    assert wrong.where("gap <> 0").isEmpty()


@pytest.mark.parametrize("n,size", [(0, 10), (1, 10), (10, 10), (11, 10), (95, 10), (5, 1)])
def test_batches(spark, n, size):
    got = batch.assign_batches(numbered(spark, n, 3), size, "id").collect()
    assert sorted((r["batch_id"], r["batch_pos"]) for r in got) == [(i // size, i % size) for i in range(n)]
    assert all(r["id"] == r["batch_id"] * size + r["batch_pos"] for r in got)


def test_numbering_as_read(spark, tmp_path):
    for i, n in enumerate([700, 0, 3, 1200, 41]):
        (tmp_path / f"{4 - i}.ndjson").write_text("".join(f'{{"f":{4 - i},"i":{j}}}\n' for j in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        docs = read_ndjson(spark, str(tmp_path))
        assert docs.select("block_start").distinct().count() > 3
        kept = docs.where("pos % 3 <> 1")
        for df in (docs, kept, concat_documents(kept.where("name < '3'"), kept.where("name >= '3'")).coalesce(2)):
            got = {r["doc"]: r["row_index"] for r in batch.number_as_read(df).collect()}
            assert got == {r["doc"]: r["row_index"] for r in batch.with_row_index(df).collect()}
            assert sorted(got.values()) == list(range(len(got)))
        plan = batch.number_as_read(docs)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(path" not in plan
        sizes = batch.assign_batches(docs, 100, as_read=True).groupBy("batch_id").count().orderBy("batch_id").collect()
        assert [r["count"] for r in sizes] == [100] * 19 + [44]
        with pytest.raises(ValueError, match="not as they were read"):
            batch.number_as_read(docs.repartition(5))
        with pytest.raises(ValueError, match="not as they were read"):
            batch.number_as_read(docs.union(docs))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        batch.assign_batches(spark.range(1), 0, "id")


def test_render_batches(spark):
    docs = spark.range(25).select("id", F.concat(F.lit('{"i":'), F.col("id"), F.lit("}")).alias("doc"))
    lines = batch.bulk_lines(batch.assign_batches(docs, 10, "id"), "index")
    got = {r["batch_id"]: r for r in batch.render_batches(lines).collect()}
    assert [got[i]["n_docs"] for i in range(3)] == [10, 10, 5]
    assert got[2]["body"] == "".join(f'{{"index":{{}}}}\n{{"i":{i}}}\n' for i in range(20, 25))


def test_update_lines(spark):
    docs = spark.createDataFrame([('{"_id":"a","x":{"y":[1,"2"]},"z":1.5}',)], "doc string")
    assert batch.bulk_lines(docs, "update").first()["line"] == (
        '{"update":{"_id":"a"}}\n{"doc":{"x":{"y":[1,"2"]},"z":1.5}}\n'
    )
    for bad in ('{"x":1}', '{"_id":1}', '{"_id":null}', "[1]", "1"):
        with pytest.raises(Exception, match="update action"):
            batch.bulk_lines(spark.createDataFrame([(bad,)], "doc string"), "update").collect()


def test_update_id_of_repeated_keys(spark):
    docs = spark.createDataFrame([('{"_id":"a","x":1,"_id":"b","x":2}',)], "doc string")
    got = validate.with_update_id(docs).first()
    assert got["id"] == "b" and json.loads(got["doc"]) == {"x": 2} and got["doc"].count("x") == 1


def test_explode_rows(spark):
    cases = {
        '{"rows":[{"a":1},{"a":2}]}': [('{"a":1}', None), ('{"a":2}', None)],
        '{"rows":[]}': [('{"rows":[]}', "no rows")],
        '{"rows":[{"a":1},2]}': [('{"a":1}', None), ("2", "row is not an object")],
        '{"rows":[1],"b":2}': [('{"rows":[1],"b":2}', None)],
        '{"rows":{"a":1}}': [('{"rows":{"a":1}}', None)],
        "{}": [("{}", None)],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "k int, doc string")
    got = shape.explode_rows(df).orderBy("k", "row").collect()
    assert [(r["k"], r["doc"], r["error"]) for r in got] == [(k, *v) for k, vs in enumerate(cases.values()) for v in vs]


def test_exploded_elements_keep_their_text(spark):
    """Numbers, order of keys, escapes and blanks of an element stay as they are spelt."""
    elements = [r'{"b": 1.0, "a":1e5,"z":"\u00e9 ]},{"}', '{"n":100000000000000000000.10,"m":-0,"deep":[[{"x":[1,2]}]]}', '"{}"', "null", "-1.50E+2"]
    doc = ' { "ro\\"ws" : [ ' + " , ".join(elements) + " ] } "
    got = shape.explode_rows(spark.createDataFrame([(doc,), ('{"a":[ ]}',), ('{"a":[{}],"b":[{}]}',), (None,)], "doc string")).collect()
    assert [(r["doc"], r["error"]) for r in got[:5]] == [(e, None if e.startswith("{") else "row is not an object") for e in elements]
    assert [(r["doc"], r["error"]) for r in got[5:]] == [('{"a":[ ]}', "no rows"), ('{"a":[{}],"b":[{}]}', None), (None, None)]


def reply(items, errors=False):
    return json.dumps({"errors": errors, "items": items})


def test_accounting(spark):
    def item(action, status, error=None):
        body = {"_index": "i", "_id": "1", "status": status}
        return {action: {**body, "error": error} if error else body}

    caused = {"type": "t0", "reason": "r0", "caused_by": {"type": "t", "reason": "r"}}
    plain = {"type": "t0", "reason": "r0"}
    rows = [
        (200, 5, reply([item("create", 201), item("create", 200), item("index", 200), item("index", 201), item("update", 200)])),
        (200, 3, reply([item("create", 409, caused), item("create", 409, caused), item("index", 400, plain)], True)),
        (200, 1, reply([item("create", 409, caused)], False)),
        (400, 2, '{"error":{"type":"bad","reason":"x"},"status":400}'),
        (429, 2, '{"error":"busy"}'),
        (429, 2, "{}"),
        (500, 2, '{"error":5}'),
    ]
    replies = spark.createDataFrame(rows, "status int, n_docs int, reply string")
    success = {r["action"]: (r["n_items"], r["n_accepted"]) for r in account.success_counts(replies).collect()}
    assert success == {"create": (5, 1), "index": (3, 2), "update": (1, 1)}
    errors = {(r["index"], r["type"], r["reason"]): r["n"] for r in account.error_counts(replies).collect()}
    assert errors == {("i", "t", "r"): 2, ("i", "t0", "r0"): 1}
    assert {r[0] for r in account.error_messages(replies).collect()} == {"(2) <i> t - r", "(1) <i> t0 - r0"}
    refused = {(r["status"], r["cause"]): r["n"] for r in account.request_errors(replies).collect()}
    assert refused == {(400, "bad"): 1, (429, "busy"): 1, (429, "unknown"): 1}
    summary = account.run_summary(replies).first()
    assert (summary["n_requests"], summary["n_docs"], summary["n_accepted"]) == (7, 17, 4)
    many = account.run_summary(spark.createDataFrame([(200, 1234567, "{}")], replies.schema)).first()
    assert many["summary"] == "0 of 1,234,567 docs accepted"


TEMPLATE = '{"index_patterns":["logs-*"],"template":{"settings":{"index.default_pipeline":"geo"}}}'


def test_target_options():
    assert TargetOptions(pipeline_name="p", pipeline_body="{}").request_pipeline == "p"
    assert TargetOptions(pipeline_name="_none").request_pipeline == "_none"
    assert TargetOptions("geo", "{}", "t", TEMPLATE).request_pipeline is None
    assert not TargetOptions().given
    for bad in (
        {"pipeline_name": "p"},
        {"pipeline_name": "_none", "pipeline_body": "{}"},
        {"pipeline_body": "{}"},
        {"pipeline_name": "_none", "template_name": "t", "template_body": "{}"},
        {"template_name": "t"},
        {"template_overwrite": True},
        {"template_body": "{}"},
    ):
        with pytest.raises(ValueError):
            TargetOptions(**bad)


def test_check_target(spark):
    known = spark.createDataFrame([("geo",)], "name string")
    none = known.limit(0)
    with_template = TargetOptions(template_name="t", template_body=TEMPLATE)
    assert check_target(spark, "logs-a", with_template, known) == []
    assert "no pattern matches" in check_target(spark, "metrics", with_template, known)[0]
    with pytest.raises(ValueError, match="template pipeline is missing"):
        check_target(spark, "logs-a", with_template, none)
    assert check_target(spark, "logs-a", TargetOptions("geo", "{}", "t", TEMPLATE), none) == []
    with pytest.raises(ValueError, match="another pipeline"):
        check_target(spark, "logs-a", TargetOptions("other", "{}", "t", TEMPLATE), known)
    with pytest.raises(ValueError, match="names no pipeline"):
        check_target(spark, "logs-a", TargetOptions("geo", "{}", "t", "{}"), known)
    assert "no index_patterns" in check_target(spark, "a", TargetOptions(template_name="t", template_body="{}"), known)[0]
    assert check_target(spark, "a", TargetOptions(pipeline_name="_none"), none) == []


def test_processors_and_mapping(spark):
    df = spark.createDataFrame([("a,b", "True", "Jan 5, 2024", "7", "x"), (None, None, "?", "?", None)], "`Tags list` string, w string, d string, n string, k string")
    done = target.apply_processors(
        df,
        [{"split": {"field": "Tags list", "separator": ","}}, {"convert": {"field": "w", "type": "boolean"}}, {"set": {"field": "s", "value": 1}}],
    )
    mapped = target.apply_mapping(
        done, {"d": {"type": "date", "format": "MMM d, yyyy"}, "n": {"type": "integer"}, "k": {"type": "keyword"}}
    )
    rows = mapped.collect()
    assert rows[0]["Tags list"] == ["a", "b"] and rows[0]["w"] is True and rows[0]["s"] == 1
    assert str(rows[0]["d"]) == "2024-01-05" and rows[0]["n"] == 7 and rows[0]["k"] == "x"
    assert (rows[1]["Tags list"], rows[1]["w"], rows[1]["d"], rows[1]["n"]) == (None, None, None, None)
    with pytest.raises(ValueError, match="missing"):
        target.apply_processors(df, [{"split": {"field": "zz", "separator": ","}}])
    with pytest.raises(Exception, match="no boolean"):
        target.apply_processors(df, [{"convert": {"field": "k", "type": "boolean"}}]).collect()


@pytest.mark.parametrize("copies", [False, True])
def test_index_sort_spreads_one_value(spark, copies):
    df = spark.range(0, 6000, 1, 6).select(F.lit("same").alias("publisher"), (F.col("id") % 3).alias("day"), "id")
    if copies:  # every document is the same; only its place differs
        df = df.select("publisher", F.lit(1).alias("day"), F.lit("p").alias("path"), F.lit(0).alias("block_start"), F.col("id").alias("pos"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        done = target.sort_for_index(df, ["publisher", "day"], ["asc", "desc"])
        rows = done.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [sum(r["part"] == p for r in rows) for p in {r["part"] for r in rows}]
    assert len(sizes) >= 4 and max(sizes) < 3000 and sum(sizes) == 6000
    days = [r["day"] for r in sorted(rows, key=lambda r: r["at"])]
    assert days == sorted(days, reverse=True)


class _Conf:
    def __init__(self, value, master):
        self.value = value
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, key, default=None):
        return self.value or default


def test_scratch_follows_the_session():
    assert scratch_dir(_Conf("hdfs://n/ck/", "yarn"), "x").startswith("hdfs://n/ck/x-")
    with pytest.raises(ValueError):
        scratch_dir(_Conf(None, "yarn"), "x")
    assert scratch_dir(_Conf(None, "local[2]"), "x") != scratch_dir(_Conf(None, "local[2]"), "x")
