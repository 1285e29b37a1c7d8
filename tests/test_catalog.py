import os
import re

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference, type_difference
from docferry.plans.catalog import QUERIES
from docferry.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df, sql = QUERIES[name](spark, SF_DIR), ORACLE[name]
    assert difference(df, con, sql) is None
    assert type_difference(df, con, sql) == {}


def test_entry(spark):
    assert entry_module.entry(spark).count() >= 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


PLAIN = ["ndjson_valid", "wrap_content", "file_metadata", "frontmatter", "split_documents", "pattern_match", "typed_mapping"]


@pytest.mark.parametrize("name", PLAIN)
def test_row_operators_do_not_shuffle(spark, name):
    plan = entry_module.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scans_read_needed_columns_only(spark):
    plan = entry_module.queries()["ndjson_valid"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<event_id:bigint,props:string>", plan)
