"""What a task holds: plans without the joins that put many rows, or many sorted inputs, into one task."""

import datetime as dt
import re

import pytest
from test_operators import JOBS, _job

from clusterlens.operators import docs as D
from clusterlens.operators import logs as L
from clusterlens.operators import queue as Qo
from clusterlens.operators import reports as Rp

AS_OF = "2024-01-11 00:00:00"
QUEUE = ("job_id string, user_name string, account string, partition string, state string, reason string, priority bigint, n_nodes int, "
         "n_cpus int, tres string, submit_ts timestamp_ntz")
NODES = "node string, partition string, state string, reason string, cpus string, mem_mb bigint, gres string"


@pytest.fixture
def large(spark):
    """Every table counts as too large to broadcast, unless the code says it is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sort_merge_joins(df, key, kind=""):
    return len(re.findall(rf"SortMergeJoin \[{key}#\d+\], \[{key}#\d+\], {kind}", plan_of(df)))


@pytest.fixture
def queue(spark):
    return spark.createDataFrame([("1", "u1", "a", "p", "PENDING", "Priority", 5, 1, 1, "cpu=1,mem=64G", None),
                                  ("1", "u2", "a", None, "RUNNING", "", 5, 1, 1, "cpu=1,mem=64G", None), ("2", "u1", "a", "q", "RUNNING", "", 5, 1, 1, "cpu=1,mem=64G", None)], QUEUE)


@pytest.fixture
def nodes(spark):
    return spark.createDataFrame([("n1", "p", "idle", None, "8", 8192, "(null)"), ("n2", "r", "idle", None, "8", 8192, "(null)")], NODES)


def test_rows_are_not_dealt_by_partition(spark, large, queue, nodes):
    ids = spark.createDataFrame([("1",), ("1",), ("2",), ("3",), ("x!",), (None,)], "job_id string")
    df = Qo.pending_context(ids, queue, nodes)
    assert sort_merge_joins(df, "partition", "LeftOuter") == 0 and "LeftAnti" not in plan_of(df)
    got = sorted(((r["job_id"], r["partition"], r["pending_in_partition"], r["idle"], r["status"]) for r in df.collect()), key=str)
    assert got == sorted([("1", "p", 1, 1, "ok"), ("1", None, 0, None, "ok"), ("2", "q", 0, None, "ok"), ("3", None, None, None, "not_in_queue"),
                          ("x!", None, None, None, "invalid_key"), (None, None, None, None, "invalid_key")], key=str)
    assert not re.search(r"SortMergeJoin \[partition#[^\]]*\], \[partition#[^\]]*\], LeftOuter.*\n.*Project \[partition#\d+, user_name", plan_of(Qo.memory_overreservation(queue, nodes)))


def test_guards_of_log_tails_need_no_anti_join(spark, large):
    jobs = [_job(1, stdout="/l/1", stderr=""), _job(2, stdout="/dev/null", stderr=""), _job(3, stdout="", stderr=None), _job(4, stdout="", stderr=""), _job(4, stdout="/l/4", stderr="")]
    jobs = spark.createDataFrame(jobs, JOBS)
    lines = spark.createDataFrame([("/l/1", k, f"line {k}") for k in (1, 2, 3)], "path string, lineno bigint, line string")
    ids = spark.createDataFrame([(j,) for j in ("1", "1", "2", "3", "4", "9", "9", "x!", None)], "job_id string")
    df = L.job_log_tail(jobs, lines, 2, ids=ids)
    assert "LeftAnti" not in plan_of(df)
    got = sorted(((r["job_id"], r["path"], r["lineno"], r["status"]) for r in df.collect()), key=str)
    assert got == sorted([("1", "/l/1", 2, "ok"), ("1", "/l/1", 3, "ok"), ("2", None, None, "no_usable_file"), ("3", None, None, "no_paths"),
                          ("4", "/l/4", None, "file_not_found"), ("9", None, None, "unknown_key"), ("x!", None, None, "invalid_key"), (None, None, None, "invalid_key")], key=str)


def test_parts_of_an_overview_are_not_joined_one_by_one(spark, large, queue):
    end = dt.datetime(2024, 1, 10)
    jobs = spark.createDataFrame([_job(k, start_ts=end, end_ts=end) for k in range(1, 8)], JOBS)
    logins = spark.createDataFrame([("u1",), ("u1",), ("nobody",), ("x;",), (None,)], "user_name string")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_name string")
    shares = spark.createDataFrame([("a", "u1", 0.1, 0.2, None, 0.4)], "account string, user_name string, norm_shares double, norm_usage double, level_fs double, fair_share double")
    df = Rp.user_overview(logins, users, jobs, queue, shares, AS_OF)
    assert sort_merge_joins(df, "user_name", "LeftOuter") <= 10  # those of the parts alone: each asks anew which logins are known
    rows = {r["user_name"]: r for r in df.collect()}
    assert {u: r["status"] for u, r in rows.items()} == {"u1": "ok", "nobody": "unknown_key", "x;": "invalid_key", None: rows[None]["status"]}
    assert (rows["u1"]["queue_jobs"], rows["u1"]["n_jobs"], len(rows["u1"]["fairshare"])) == (2, 7, 1) and rows["nobody"]["states"] is None


@pytest.mark.parametrize("by", [(), ("idx",)])
def test_documents_are_walked_once(spark, by):
    """The number of fields and the fields shown come from one walk; deep and broken texts give what they gave."""
    deep = '{"a":' * 25 + "1" + "}" * 25
    docs = spark.createDataFrame([(1, "i", '{"a": 1, "b": [{"c": 2}, "x"]}'), (2, "i", '{"a": "t", "e": {}}'), (3, "i", "{broken"), (4, "i", deep), (5, "i", None)],
                                 "doc_id long, idx string, props string")
    df = D.field_catalog(docs, by=by)
    rows = {r["field"]: r for r in df.collect()}
    found = {f: (r["type"], r["n_docs"]) for f, r in rows.items()}
    assert found == {"doc_id": ("long", 5), "props.a": ("long|string", 2), "props.b": ("string", 1), "props.b.c": ("long", 1), "props.e": ("object", 1),
                     "props" + ".a" * 21: ("object", 1)}
    assert {(r["n_fields"], r["n_docs_total"], r["n_unreadable"]) for r in rows.values()} == {(6, 5, 1)}
    assert by or "ReusedExchange" in plan_of(df).split("== Initial Plan ==")[0]
