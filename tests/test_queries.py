"""Every registered query against its DuckDB twin on the smallest test tables, plus plan checks."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

from clusterlens.plans import QUERIES  # noqa: E402

# The queries of the library itself; the training-data operators have their own tests.
OWN = {k: v for k, v in E.queries().items() if k in QUERIES}
OWN_SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    q, o = OWN, OWN_SQL
    assert set(o) <= set(q)
    assert set(q) == set(o)


@pytest.mark.parametrize("key", sorted(OWN_SQL))
def test_query_matches_duckdb(spark, duck, key):
    df = OWN[key](spark, SF)
    res = duck.execute(OWN_SQL[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())


@pytest.mark.parametrize("key", sorted(OWN))
def test_plan_stays_in_the_jvm(spark, key):
    plan = OWN[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "pattern" in df.columns


def test_scan_pushdown_and_pruning(spark, tmp_path, monkeypatch):
    """Over a canonical queue table, as a cluster stores it, filters and columns reach the scan."""
    from clusterlens.sources import fixtures

    fixtures.TABLES["queue"](spark, SF).write.parquet(str(tmp_path / "queue"))
    monkeypatch.setitem(fixtures.TABLES, "queue", lambda spark, sf_dir: spark.read.parquet(str(tmp_path / "queue")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # show all pushed filters
    text = OWN["queue_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account,acct1)" in text and "EqualTo(state,RUNNING)" in text
    # pending_count needs two queue columns and the snapshot time: the scan reads only those
    text = OWN["pending_count"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<snapshot_ts:timestamp_ntz,partition:string,state:string>" in text


def test_per_group_top_n_is_a_group_limit(spark):
    """row_number() <= n per group is planned as WindowGroupLimit (partial limit before the shuffle)."""
    for key in ("tail_lines", "job_history", "dir_listing"):
        df = OWN[key](spark, SF)
        df.write.format("noop").mode("overwrite").save()
        assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString(), key


def test_diagnosis_has_one_row_per_request(spark):
    ids = OWN["job_diagnosis"](spark, SF).select("job_id")
    assert ids.count() == ids.distinct().count()


def test_no_cartesian_products(spark):
    for key in sorted(OWN):
        plan = OWN[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key
