"""The registered queries over a whole small table, and the pipeline stage by stage."""

from __future__ import annotations

import pytest
from compare import connect, difference, type_difference

import corpus_pipeline
from docferry.llm.queries import QUERIES
from docferry.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_like_sql(spark, name):
    con, df = connect(SF), QUERIES[name](spark, SF)
    assert difference(df, con, ORACLE[name]) is None
    assert not type_difference(df, con, ORACLE[name])


def test_pipeline(spark, docs):
    given = docs.dropDuplicates(["doc_id"]).where("doc_id is not null")
    columns = given.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = given.count()
        given = step(spark, given, SF)
        assert given.columns == columns, name
        if name in ("toxicity", "exact_dedup", "minhash_dedup"):
            assert given.count() <= before
    assert corpus_pipeline.STAGES[-1][1](spark, given, SF).count() > 0
    nothing = given.limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, nothing, SF).count() == 0


def test_near_stage_with_null_and_repeated_ids(spark, docs):
    """One row of each group stays, whatever its rows are called."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(100))
    given = [
        (1, text("a")), (2, text("a") + " end"), (2, text("b")),  # a near copy does not take its namesake along
        (3, text("c")), (3, text("c") + " end"),  # near copies of one name
        (None, text("d")), (None, text("d") + " end"), (None, text("e")),  # near copies without a name
        (4, text("f")), (None, text("f") + " end"), (None, None), (None, ""),
    ]
    rows = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in given], docs.schema).repartition(3)
    left = corpus_pipeline.drop_near_copies(spark, rows, SF)
    assert left.columns == rows.columns
    got = sorted(((r.doc_id, (r.text or "-")[:1]) for r in left.collect()), key=repr)
    assert got == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (None, "e"), (4, "f"), (None, "-"), (None, "-")], key=repr)
    columns = docs.columns
    given = docs
    for name, step in corpus_pipeline.STAGES[1:3]:
        given = step(spark, given, SF)
        assert given.columns == columns, name
    assert given.where("doc_id is null").count() == 1 and given.where("doc_id = 8").count() == 1


def test_stages_with_clashing_names(spark, docs):
    """Columns called as anything the stages use inside come through all of them unchanged."""
    names = ("score", "near_row", "_near_row", "_mix_words", "_mix_id", "c0", "c1", "id", "row", "kept", "part", "_text", "place", "taken", "n")
    given = docs.withColumns({n: docs["lang"] for n in names})
    columns = given.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        given = step(spark, given, SF)
        assert given.columns == columns, name
        assert given.where(" or ".join(f"not ({n} <=> lang)" for n in names)).isEmpty(), name
    assert corpus_pipeline.STAGES[-1][1](spark, given, SF).count() > 0
    nothing = given.limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, nothing, SF).count() == 0, name
