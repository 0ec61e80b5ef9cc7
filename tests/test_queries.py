"""Every registered query against its SQL, and the plans of the costly ones."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) == len(set(df.columns)) and df.count() > 0
    else:
        assert compare(con, df, sql) is None


def test_names_and_entry(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0


def plan(spark, name):
    return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_join(spark, name):
    if name in ("classify_documents",):
        pytest.skip("trains a model first")
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_what_they_need(spark):
    assert "struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan(spark, "rollup_daily")
    assert "struct<doc_id:bigint,text:string>" in plan(spark, "targeted_documents")


def test_rollups_shuffle_once(spark):
    """One exchange for the sums and one for the order they are written in."""
    text = plan(spark, "rollup_weekly")
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Exchange rangepartitioning") == 1
    assert plan(spark, "rollup_both").count("FileScan") == 1
