"""Reports on hand-made rows: what stands beside every shortened list is exact."""

import datetime as dt
import os
import random

import pytest
from test_operators import JOBS, STEPS, _job, _step

from clusterlens.operators import intervals as I
from clusterlens.operators import reports as Rp

END = dt.datetime(2024, 1, 10)
AS_OF = "2024-01-11 00:00:00"
QUEUE = ("job_id string, user_name string, account string, partition string, state string, reason string, priority bigint, n_nodes int, "
         "n_cpus int, submit_ts timestamp_ntz")


@pytest.fixture(scope="module")
def tables(spark):
    jobs = [_job(k, job_name="sim_1", state="FAILED", exit_code=f"{k % 5}:0", stdout=f"/work/logs/{k}.log", start_ts=END - dt.timedelta(hours=1), end_ts=END)
            for k in range(1, 8)]
    paths = " ".join(f"/work/u1/f{k}" for k in range(7))
    lines = [("/work/logs/7.log", k, f"line {k}") for k in range(1, 41)]
    at = [END - dt.timedelta(minutes=m) for m in (10, 20, 30)]
    samples = [("node_load5", {"instance": "n1:9100"}, t, v) for t, v in zip(at, (1.0, 2.0, 6.0), strict=True)]
    for t, free in zip(at, (50.0, 40.0, 10.0), strict=True):
        samples += [(f"node_memory_{m}_bytes", {"instance": "n1:9100"}, t, v) for m, v in (("MemTotal", 100.0), ("MemFree", free), ("Cached", 5.0), ("Buffers", 5.0))]
    samples.append(("node_memory_MemTotal_bytes", {"instance": "n1:9100"}, END - dt.timedelta(minutes=5), 100.0))  # the other three are missing
    return {
        "ids": spark.createDataFrame([("7",)], "job_id string"),
        "jobs": spark.createDataFrame(jobs, JOBS),
        "job_steps": spark.createDataFrame([_step(7)], STEPS),
        "queue": spark.createDataFrame([], QUEUE),
        "nodes": spark.createDataFrame([], "node string, partition string, state string, reason string"),
        "scripts": spark.createDataFrame([("7", f"#!/bin/bash\ncat {paths}\n")], "job_id string, script string"),
        "files": spark.createDataFrame([(f"/work/u1/f{k}", "f", 1) for k in (0, 1, 6)], "path string, kind string, size bigint"),
        "log_lines": spark.createDataFrame(lines, "path string, lineno bigint, line string"),
        "samples": spark.createDataFrame(samples, "metric string, labels map<string,string>, ts timestamp_ntz, value double"),
    }


def test_diagnosis_has_exact_totals_lines_and_statistics(tables):
    (r,) = Rp.job_diagnosis(**tables, as_of=AS_OF).collect()
    assert (r["log_lines"], r["log_lines_total"], r["log_files_missing"]) == (30, 40, 0)
    assert [(x["lineno"], x["line"]) for x in r["log_tail"]] == [(k, f"line {k}") for k in range(11, 41)]
    assert (r["files_ok"], r["files_absent"]) == (3, 4)
    assert (r["load5_min"], r["load5_max"], r["load5_avg"], r["load5_samples"]) == (1.0, 6.0, 3.0, 3)
    assert [round(r[f"mem_used_pct_{x}"], 6) for x in ("min", "max", "avg")] == [40.0, 80.0, 56.666667] and r["mem_used_pct_samples"] == 3


def test_overviews_have_exit_codes_and_cluster_logs(spark, tables):
    shares = spark.createDataFrame([("a1", "u1", 0.1, 0.1, 1.0, 0.5)], "account string, user_name string, norm_shares double, norm_usage double, level_fs double, fair_share double")
    keys = spark.createDataFrame([("a1", "u1")], "account string, user_name string")
    own = {k: tables[k] for k in ("jobs", "queue", "log_lines")}
    for (r,) in (Rp.user_overview(keys, keys, shares=shares, as_of=AS_OF, **own).collect(), Rp.account_overview(keys, keys, as_of=AS_OF, **own).collect()):
        (cluster,) = r["clusters"]
        assert [tuple(e) for e in cluster["exits"]] == [("1:0", 2), ("2:0", 2), ("0:0", 1)] and cluster["n_exits"] == 5
        assert [(x["job_id"], x["lineno"], x["n_lines"]) for x in r["cluster_logs"]] == [("7", k, 40) for k in range(29, 41)]


def test_jobs_that_share_files_share_the_texts(spark, tables):
    """Sixty jobs with one log of 120 KB: the texts are shuffled once, not for every job; a job without a file has no lines, one without a log none either."""
    rng = random.Random(1)
    text = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=4000)) for _ in range(30)]
    jobs = [_job(k, stdout="/work/logs/all.log", stderr="/work/logs/gone.log", end_ts=END) for k in range(100, 160)]
    jobs += [_job(160, stdout="/work/logs/gone.log", stderr="", end_ts=END), _job(161, stdout="/dev/null", stderr="", end_ts=END), _job(162, stdout="/work/logs/b.log", stderr="/work/logs/all.log", end_ts=END)]
    own = tables | {
        "ids": spark.createDataFrame([(str(k),) for k in range(100, 164)], "job_id string"),
        "jobs": spark.createDataFrame(jobs, JOBS).repartition(3),
        "log_lines": spark.createDataFrame([("/work/logs/all.log", k + 5, x) for k, x in enumerate(text)] + [("/work/logs/b.log", 1, "b")], "path string, lineno bigint, line string"),
    }
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {n for n in disk.getAllFiles().mkString("\n").split() if "/shuffle_" in n}
    before = files()
    rows = {r["job_id"]: r for r in Rp.job_diagnosis(**own, as_of=AS_OF).collect()}
    assert sum(os.path.getsize(f) for f in files() - before if os.path.exists(f)) < 2_000_000
    want = [("StdOut", k + 5, "/work/logs/all.log", x) for k, x in enumerate(text)]
    for k in range(100, 160):
        r = rows[str(k)]
        assert (r["log_lines"], r["log_lines_total"], r["log_files_missing"]) == (30, 34, 1) and [tuple(x) for x in r["log_tail"]] == want
    assert [(rows[k]["log_lines"], rows[k]["log_lines_total"], rows[k]["log_files_missing"], rows[k]["log_tail"]) for k in ("160", "161", "163")] == [(0, 0, 1, []), (0, 0, 0, []), (None,) * 4]
    assert [tuple(x) for x in rows["162"]["log_tail"]] == [("StdErr", *w[1:]) for w in want] + [("StdOut", 1, "/work/logs/b.log", "b")]
    assert Rp.job_diagnosis(**own, as_of=AS_OF, log_texts=False).where("log_lines = 30 and size(log_tail) = 0").count() == 60


def test_parts_of_the_nodes_make_the_whole(spark):
    """Samples of whole runs are met by parts of the nodes: each node in one part."""
    jobs = spark.createDataFrame([(str(k), f"n[{k}-{k + 3}]", END - dt.timedelta(hours=k), END) for k in range(1, 20)], "job_id string, node_list string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    rows = [("node_load5", {"instance": f"n{k}:9100"}, END - dt.timedelta(minutes=7 * m), float(k * m)) for k in range(1, 23) for m in range(40)]
    samples = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    for met in (lambda **kw: I.join_interval_metrics(jobs, samples, AS_OF, ["node_load5"], **kw), lambda **kw: I.run_grid_metrics(jobs, samples, AS_OF, lookback="1h", **kw)):
        whole = sorted(map(tuple, met().collect()))
        parts = [sorted(map(tuple, met(part=(k, 3)).collect())) for k in range(3)]
        assert whole == sorted(r for p in parts for r in p) and all(parts)
        assert sum(len({r[1] for r in p}) for p in parts) == len({r[1] for r in whole})
