"""Every registered query against its SQL on DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, duck_rows, spark_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    columns, rows = spark_rows(entry.queries()[name](spark, SF))
    assert rows
    if name in ORACLE:
        want_columns, want = duck_rows(con, ORACLE[name])
        assert columns == want_columns
        assert rows == want


def test_entry(spark):
    assert entry.entry(spark).columns == ["url", "segment_no", "text", "language"]


def test_no_python_worker_in_native_queries(spark):
    with_blocks = {"html_blocks", "page_segments", "robots_meta_gate"}
    lazy = ("clean_lines", "page_links", "robots_decide", "url_policy", "lid_train", "polite_batches")
    for name in lazy:
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name
    for name in with_blocks:
        assert "ArrowEvalPython" in entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
