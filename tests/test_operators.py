"""Operators on hand-made rows: threshold boundaries, guard statuses and quirks."""

import datetime as dt

from pyspark.sql import functions as F

from clusterlens.operators import docs as D
from clusterlens.operators import guards as G
from clusterlens.operators import jobs as J
from clusterlens.operators import logs as L
from clusterlens.operators import metrics as M
from clusterlens.operators import queue as Qo

STEPS = ("step_id string, user_name string, job_name string, state string, elapsed_s bigint, total_cpu string, alloc_cpus int, "
         "n_nodes int, req_mem string, max_rss string, timelimit_min string, node_list string, end_ts timestamp_ntz")
JOBS = ("job_id string, user_name string, account string, partition string, job_name string, state string, elapsed_s bigint, "
        "alloc_tres string, node_list string, start_ts timestamp_ntz, end_ts timestamp_ntz, exit_code string, work_dir string, "
        "batch_flag int, stdout string, stderr string")
T0 = dt.datetime(2024, 1, 10)


def _job(i, **kw):
    row = dict(job_id=str(i), user_name="u1", account="a1", partition="p", job_name="sim_1", state="COMPLETED", elapsed_s=100,
               alloc_tres="cpu=1,mem=1G", node_list="n1", start_ts=T0, end_ts=T0, exit_code="0:0", work_dir="/work/u1",
               batch_flag=1, stdout="", stderr="")
    row.update(kw)
    return tuple(row[k] for k in [c.split()[0] for c in JOBS.split(", ")])


def _step(i, **kw):
    row = dict(step_id=str(i), user_name="u", job_name="j", state="COMPLETED", elapsed_s=1000, total_cpu="00:00:00", alloc_cpus=1,
               n_nodes=1, req_mem="1G", max_rss="", timelimit_min="60", node_list="n", end_ts=None)
    row.update(kw)
    return tuple(row[k] for k in [c.split()[0] for c in STEPS.split(", ")])


def test_efficiency_boundaries(spark):
    g = 1024**3
    steps = spark.createDataFrame([
        _step(1, total_cpu="00:08:20", elapsed_s=1000),                       # cpu_eff 0.5 exactly → not under
        _step(2, total_cpu="00:08:19", elapsed_s=1000),                       # just under → cpu_under
        _step(3, elapsed_s=300, total_cpu="00:00:00"),                        # elapsed 300 → no cpu verdict
        _step(4, max_rss="4G", req_mem="10G", total_cpu="00:16:40"),  # mem_eff 0.4 exactly → not over
        _step(5, max_rss="1000M", req_mem="1G", total_cpu="00:16:40"),       # mem_eff > 0.9 → near limit
        _step(6, timelimit_min="1", elapsed_s=5000, state="TIMEOUT", total_cpu="01:23:20"),
        _step(7, timelimit_min="100", elapsed_s=1200, total_cpu="00:20:00"),  # time_eff 0.2 exactly → not over
        _step(8, timelimit_min="101", elapsed_s=1200, total_cpu="00:20:00"),  # < 0.2 → time_over
        _step(9, state="OUT_OF_MEMORY", total_cpu="00:16:40"),
        _step(10, total_cpu="00:16:40"), _step("10.0", max_rss="900M"), _step("10.1", max_rss="100M"),  # steps win
        _step(11, timelimit_min="0", elapsed_s=1000, total_cpu="00:16:40"),   # limit 0: no time ratio
    ], STEPS)
    jobs = spark.createDataFrame([_job(i) for i in range(1, 12)], JOBS)
    r = {x["job_id"]: x for x in J.job_efficiency(steps, jobs, ("visu",)).collect()}
    assert r["1"]["verdicts"] == [] and r["1"]["cpu_eff"] == 0.5
    assert r["2"]["verdicts"] == ["cpu_under"]
    assert r["3"]["verdicts"] == []
    assert r["4"]["verdicts"] == [] and abs(r["4"]["mem_eff"] - 0.4) < 1e-12
    assert r["5"]["verdicts"] == ["mem_near_limit"]
    assert "timeout" in r["6"]["verdicts"]
    assert r["7"]["verdicts"] == [] and r["8"]["verdicts"] == ["time_over"]
    assert r["9"]["verdicts"] == ["oom"]
    assert r["10"]["max_rss_bytes"] == 900 * 1024**2
    assert r["11"]["time_eff"] is None and r["11"]["ok"]
    assert r["1"]["req_bytes"] == g and r["4"]["req_bytes"] == 10 * g


def test_service_jobs_skip_under_use_verdicts(spark):
    steps = spark.createDataFrame([_step(1, total_cpu="00:00:01", max_rss="10M")], STEPS)
    jobs = spark.createDataFrame([_job(1, batch_flag=0)], JOBS)
    r = J.job_efficiency(steps, jobs).collect()[0]
    assert r["is_service"] and r["verdicts"] == [] and not r["ok"]


def test_short_job_upper_median_and_note(spark):
    rows = [_job(i, elapsed_s=e) for i, e in enumerate([10, 20, 30, 40, 400, 0])]
    jobs = spark.createDataFrame(rows, JOBS)
    s = J.short_job_stats(jobs, "2024-01-11 00:00:00", days=7).collect()[0]
    assert s["total_short"] == 4 and s["median_elapsed"] == 30  # upper median of an even count
    df = spark.createDataFrame([(100, False, 19), (100, False, 20), (100, True, 50), (300, False, 50), (5, False, None)],
                               "e int, svc boolean, n int")
    got = [r[0] for r in df.select(J.short_job_note(F.col("e"), F.col("svc"), F.col("n"))).collect()]
    assert got == ["moderate", "grouping_candidate", None, None, "isolated"]


def test_failure_cluster_size_threshold_and_sample(spark):
    rows = [_job(i, job_name=f"run_{i}", state="FAILED", end_ts=T0 + dt.timedelta(hours=i)) for i in range(5)]
    rows += [_job(10 + i, job_name=f"x{i}", state="TIMEOUT") for i in range(4)]
    rows += [_job(20, job_name="run_99", state="FAILED", end_ts=None)]
    c = J.failure_clusters(spark.createDataFrame(rows, JOBS)).collect()
    assert len(c) == 1
    assert c[0]["pattern"] == "run_#" and c[0]["n"] == 6 and c[0]["sample_job"] == "4"


def test_guard_keys_statuses(spark):
    req = G.keys_frame(spark, "user_name", ["u1", "u2", "zz", "bad;x"])
    known = spark.createDataFrame([("u1",), ("u2",)], "user_name string")
    result = spark.createDataFrame([("u1", 5)], "user_name string, n int")
    out = {r["user_name"]: r["status"] for r in G.guard_keys(req, "user_name", known, result, valid=lambda c: c.rlike("^[a-z0-9]+$")).collect()}
    assert out == {"u1": "ok", "u2": "empty", "zz": "unknown_key", "bad;x": "invalid_key"}


def test_memory_half_even_groups(spark):
    q = spark.createDataFrame([
        ("1", "u", "p", "RUNNING", "cpu=1,mem=2500M"),   # 2.44 GB/CPU → rounds 2
        ("2", "u", "p", "RUNNING", "cpu=2,mem=5G"),      # 2.5 → half-even 2
        ("3", "u", "p", "RUNNING", "cpu=2,mem=7G"),      # 3.5 → 4
        ("4", "u", "p", "RUNNING", "cpu=1,mem=1G"),      # at ratio: not flagged
        ("5", "v", "p", "PENDING", "cpu=1,mem=100G"),
    ], "job_id string, user_name string, partition string, state string, tres string")
    nodes = spark.createDataFrame([("n1", "p", "4+", 4096)], "node string, partition string, cpus string, mem_mb bigint")
    r = Qo.memory_overreservation(q, nodes, factor=2.0).collect()
    groups = {(x["user_name"], x["gb_per_cpu"]): x["jobs"] for x in r}
    assert groups == {("u", 2.0): 2, ("u", 4.0): 1}
    assert r[0]["n_analyzed"] == 4 and r[0]["n_flagged"] == 3 and r[0]["ratio"] == 1.0


def test_stuck_jobs_counts_array_tasks(spark):
    q = spark.createDataFrame([
        ("1_[1-10%2]", "u", "PENDING", "JobHeldUser", T0),
        ("2", "u", "PENDING", "ReqNodeNotAvail, UnavailableNodes:n1", T0),
        ("3", "v", "PENDING", "", T0),
        ("4", "v", "RUNNING", "None", T0),
    ], "job_id string, user_name string, state string, reason string, submit_ts timestamp_ntz")
    r = Qo.stuck_jobs(q, "2024-01-11 00:00:00").collect()
    tot = r[0]
    assert (tot["n_tasks"], tot["n_fatal"], tot["n_suspect"]) == (12, 10, 1)
    held = [x for x in r if x["reason"] == "JobHeldUser"][0]
    assert held["user_tasks"] == 10 and abs(held["oldest_h"] - 24.0) < 1e-9 and held["samples"] == ["1_[1-10%2]"]
    assert any(x["bucket"] == "NORMAL" and x["reason"] == "None" for x in r)


def test_grep_context_and_exact_count(spark):
    lines = spark.createDataFrame([("/f", i, t) for i, t in enumerate(["a", "err 1", "b", "c", "ERR 2", "d", "e"], 1)] + [("/g", 1, "ok")],
                                  "path string, lineno bigint, line string")
    r = L.grep_lines(lines, "err", context=1, max_matches=1).collect()
    f = sorted((x["lineno"], x["kind"]) for x in r if x["path"] == "/f")
    assert f == [(1, "context"), (2, "match"), (3, "context")]
    assert {x["n_matches"] for x in r if x["path"] == "/f"} == {2}
    assert [x["status"] for x in r if x["path"] == "/g"] == ["no_match"]


def test_fairshare_modes(spark):
    s = spark.createDataFrame([("a", "u1", 0.1, 0.2, None, 0.3), ("a", "u2", 0.1, 0.05, 2.0, 0.6), ("b", "u1", 0.1, 0.1, 1.0, 0.5)],
                              "account string, user_name string, norm_shares double, norm_usage double, level_fs double, fair_share double")
    assert Qo.fairshare_lookup(s, user="u1").count() == 2
    assert Qo.fairshare_lookup(s, account="a").count() == 2
    both = Qo.fairshare_lookup(s, user="u1", account="a").collect()
    assert len(both) == 1 and both[0]["level_fs"] == 0.3 and both[0]["below_share"]
    none = Qo.fairshare_lookup(s, user="u2", account="b").collect()
    assert [x["status"] for x in none] == ["no_association"]


def test_terms_agg_statuses(spark):
    d = spark.createDataFrame([(1, "h1", "E"), (2, "h1", "E"), (3, None, "E"), (4, "h2", "I")], "doc_id long, host string, level string")
    ok = D.terms_agg(d, "host", "level = 'E'", top=5).collect()
    assert [(x["value"], x["n"], x["other"], x["total"]) for x in ok] == [("h1", 2, 0, 3)]
    assert [x["status"] for x in D.terms_agg(d, "host", "level = 'X'").collect()] == ["no_match"]
    d2 = d.withColumn("host", F.lit(None).cast("string"))
    assert [x["status"] for x in D.terms_agg(d2, "host").collect()] == ["field_absent"]


def test_range_grid_and_counter(spark):
    rows = [("m", {"instance": "n1"}, T0 + dt.timedelta(minutes=m), float(v)) for m, v in [(0, 1), (10, 2), (20, 3), (29, 0), (40, 5)]]
    s = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    pts = M.range_points(s, "m", "2024-01-10 00:40:00", hours=40 / 60, step="10m", lookback="5m").orderBy("i").collect()
    assert [(p["i"], p["value"]) for p in pts] == [(0, 1.0), (1, 2.0), (2, 3.0), (3, 0.0), (4, 5.0)]
    inc = M.counter_increase(s, "m", "2024-01-10 00:40:00", window="1h", bucket="15m").collect()[0]
    assert inc["increase"] == 1 + 1 + 0 + 5  # 1→2→3, reset to 0, then 0→5
    rate = M.irate(s, "m", "2024-01-10 00:40:00", lookback="30m").collect()[0]
    assert abs(rate["rate"] - 5 / 660) < 1e-12


def test_interval_join_matches_brute_force(spark):
    import random
    from clusterlens.operators import intervals as I
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    jobs = [(str(i), f"n[{rnd.randint(1, 3)}-{rnd.randint(4, 5)}]", base + dt.timedelta(minutes=rnd.randint(0, 3000)), None) for i in range(60)]
    jobs = [(j, nl, st, st + dt.timedelta(minutes=rnd.randint(0, 900)) if int(j) % 7 else None) for j, nl, st, _ in jobs]
    samples = [("node_load1", {"instance": f"n{rnd.randint(1, 5)}:9100"}, base + dt.timedelta(seconds=rnd.randint(0, 200000)), float(rnd.randint(0, 50)))
               for _ in range(3000)]
    jdf = spark.createDataFrame(jobs, "job_id string, node_list string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    sdf = spark.createDataFrame(samples, "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    as_of = "2024-01-04 00:00:00"
    end_open = dt.datetime(2024, 1, 4)
    for max_nodes in (4, None):  # the first four hosts of a job, and all (the default)
        want = {}
        for j, nl, st, en in jobs:
            lo, hi = int(nl[2]), int(nl[4])
            for node in [f"n{k}" for k in range(lo, hi + 1)][:max_nodes]:
                vals = sorted((ts, v) for m, lab, ts, v in samples if lab["instance"] == f"{node}:9100" and st <= ts <= (en or end_open))
                if vals:
                    want[(j, node)] = (len(vals), min(v for _, v in vals), max(v for _, v in vals), vals[0][1], vals[-1][1])
        for bucket in (None, "10m", "1d"):
            own = {"max_nodes": max_nodes} if max_nodes else {}
            got = {(r["job_id"], r["node"]): (r["n"], r["min"], r["max"], r["first"], r["last"])
                   for r in I.join_interval_metrics(jdf, sdf, as_of, ["node_load1"], bucket=bucket, **own).collect()}
            assert got == want, (bucket, max_nodes)


def test_queue_filter_guards_unknown_user(spark):
    q = spark.createDataFrame([("1", "u1", "a", "PENDING", "p")], "job_id string, user_name string, account string, state string, partition string")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_name string")
    assert [r["status"] for r in Qo.queue_filter(q, user="u1", users=users).collect()] == ["ok"]
    assert [r["status"] for r in Qo.queue_filter(q, user="u2", users=users).collect()] == ["empty"]
    assert [r["status"] for r in Qo.queue_filter(q, user="zz", users=users).collect()] == ["unknown_key"]
    assert [r["status"] for r in Qo.queue_filter(q, user="a;b", users=users).collect()] == ["invalid_key"]
    assert Qo.queue_filter(q, state="PENDING").count() == 1


def test_snapshot_at_reads_latest_snapshot_not_after_as_of(spark):
    rows = [(dt.datetime(2024, 1, 1, h), str(i)) for h, n in ((1, 2), (2, 3), (5, 1)) for i in range(n)]
    q = spark.createDataFrame(rows, "snapshot_ts timestamp_ntz, job_id string")
    got = Qo.snapshot_at(q, "2024-01-01 03:00:00").collect()
    assert len(got) == 3 and {r["snapshot_ts"].hour for r in got} == {2}
    assert [r["snapshot_ts"].hour for r in Qo.snapshot_at(q, None).collect()] == [5]
    assert Qo.snapshot_at(q.drop("snapshot_ts")).count() == 6


def test_state_operators_read_one_snapshot(spark):
    early, late = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2)
    q = spark.createDataFrame([(early, "1", "u", "PENDING", "p", "Priority", early, 1), (late, "1", "u", "PENDING", "p", "Priority", early, 1),
                               (early, "2", "u", "PENDING", "p", "JobHeldUser", early, 1)],
                              "snapshot_ts timestamp_ntz, job_id string, user_name string, state string, partition string, reason string, submit_ts timestamp_ntz, priority bigint")
    assert [r["pending_in_partition"] for r in Qo.pending_count(q).collect()] == [1]
    assert [r["pending_in_partition"] for r in Qo.pending_count(q, as_of="2024-01-01 01:30:00").collect()] == [2]
    assert {r["n_tasks"] for r in Qo.stuck_jobs(q, "2024-01-01 03:00:00").collect()} == {1}
    assert sorted(r["n"] for r in Qo.running_counts(q, "partition").collect()) == [1, 1]
    nodes = spark.createDataFrame([(early, "n1", "p", "down", "broken", "4", 4096, None), (late, "n1", "p", "idle", None, "4", 4096, None)],
                                  "snapshot_ts timestamp_ntz, node string, partition string, state string, reason string, cpus string, mem_mb bigint, gres string")
    assert Qo.down_nodes(nodes).count() == 0 and Qo.down_nodes(nodes, as_of="2024-01-01 01:00:00").count() == 1
    r = Qo.partition_node_states(nodes).collect()[0]
    assert (r["idle"], r["other"], r["total"], r["available"]) == (1, 0, 1, "up")


def test_array_ids_resolve_by_job_and_by_task(spark):
    q = spark.createDataFrame([(i, "u", "PENDING", "p", "Priority", T0, 1, "") for i in ("5_1", "5_2", "5_[3-9:2%2]", "6", "7_[1,4]")],
                              "job_id string, user_name string, state string, partition string, reason string, submit_ts timestamp_ntz, priority bigint, node_list string")
    nodes = spark.createDataFrame([("n1", "p", "idle", None)], "node string, partition string, state string, gres string")
    ids = spark.createDataFrame([(i,) for i in ("5", "5_1", "5_4", "5_5", "6", "6_1", "7_4", "x", "b!d", None)], "job_id string")
    got = {}
    for r in Qo.pending_context(ids, q, nodes).collect():
        got.setdefault(r["job_id"], []).append(r["queue_job_id"] or r["status"])
    assert {k: sorted(v) for k, v in got.items()} == {
        "5": ["5_1", "5_2", "5_[3-9:2%2]"], "5_1": ["5_1"], "5_4": ["not_in_queue"], "5_5": ["5_[3-9:2%2]"], "6": ["6"],
        "6_1": ["not_in_queue"], "7_4": ["7_[1,4]"], "x": ["not_in_queue"], "b!d": ["invalid_key"], None: ["invalid_key"]}
    steps = spark.createDataFrame([_step(i) for i in ("5_1", "5_1.batch", "5_2", "8")], STEPS)
    rows = J.job_details(spark.createDataFrame([("5",), ("5_1",), ("6",), ("8",), ("9",)], "job_id string"), q, steps).collect()
    n = {}
    for r in rows:
        n[r["job_id"], r["status"], r["part"]] = n.get((r["job_id"], r["status"], r["part"]), 0) + 1
    assert n == {("5", "ok", "queue"): 3, ("5", "ok", "accounting"): 3, ("5_1", "ok", "queue"): 1, ("5_1", "ok", "accounting"): 2,
                 ("6", "no_accounting", "queue"): 1, ("8", "not_in_queue", "accounting"): 1, ("9", "unknown_key", None): 1}


def test_memory_statuses_keep_every_partition(spark):
    q = spark.createDataFrame([("1", "u", "p", "RUNNING", "cpu=1,mem=1G"), ("2", "u", "lost", "RUNNING", "cpu=1,mem=1G")],
                              "job_id string, user_name string, partition string, state string, tres string")
    nodes = spark.createDataFrame([("n1", "p", "4", 4096)], "node string, partition string, cpus string, mem_mb bigint")
    got = {r["partition"]: (r["status"], r["n_analyzed"], r["n_flagged"]) for r in Qo.memory_overreservation(q, nodes).collect()}
    assert got == {"p": ("empty", 1, 0), "lost": ("no_node_data", 1, 0)}


def test_efficiency_of_a_job_with_steps_only_uses_its_first_step(spark):
    steps = spark.createDataFrame([_step("1.0", total_cpu="00:01:40", elapsed_s=1000), _step("1.1", elapsed_s=5, max_rss="900M")], STEPS)
    r = J.job_efficiency(steps, spark.createDataFrame([_job(1)], JOBS)).collect()
    assert len(r) == 1 and r[0]["elapsed_s"] == 1000 and abs(r[0]["cpu_eff"] - 0.1) < 1e-12 and not r[0]["ok"]


def test_file_check_resolves_and_confines_paths(spark):
    from clusterlens.operators import files as Fi
    scripts = spark.createDataFrame([("1", "cat /work/../etc/passwd /work/a/../b.dat /work/c.dat\n")], "job_id string, script string")
    files = spark.createDataFrame([("/work/b.dat", "f", 5), ("/etc/passwd", "f", 1)], "path string, kind string, size bigint")
    got = {r["path"]: r["check"] for r in Fi.file_check(scripts, files).collect()}
    assert got == {"/work/b.dat": "OK", "/work/c.dat": "ABSENT"}


def test_limits_are_honoured_or_refused(spark):
    import pytest
    q = spark.createDataFrame([(str(i), f"u{i:03d}", "PENDING", "JobHeldUser", T0) for i in range(60)],
                              "job_id string, user_name string, state string, reason string, submit_ts timestamp_ntz")
    assert Qo.stuck_jobs(q, "2024-01-11 00:00:00", top_users=60).count() == 60
    with pytest.raises(ValueError):
        Qo.stuck_jobs(q, "2024-01-11 00:00:00", top_users=0)


def test_index_globs(spark):
    from clusterlens.functions import predicates as Qp
    names = ["logs-2024.01", "logs-x", "app", "apps", "a1", "ab"]
    df = spark.createDataFrame([(n,) for n in names], "x string")
    got = [r[0] for r in df.select(Qp.index_glob(F.col("x"), "logs-2024.*,app")).collect()]
    assert got == [True, False, True, False, False, False]
    got = [r[0] for r in df.select(Qp.index_glob(F.col("x"), "a[0-9]")).collect()]
    assert got == [False, False, False, False, True, False]
    got = [r[0] for r in df.select(Qp.index_glob(F.col("x"), "a?")).collect()]
    assert got == [False, False, False, False, True, True]


def test_empty_listings_say_why(spark):
    from clusterlens.operators import files as Fi
    d = spark.createDataFrame([("secret-1", 1, T0, "I", 5.0), ("secret-2", 2, T0, "E", 6.0)], "idx string, doc_id long, ts timestamp_ntz, level string, value double")
    assert [(r["status"], r["total"], r["doc_id"]) for r in D.doc_search(d, "level = 'X'").collect()] == [("no_match", 0, None)]
    assert [(r["status"], r["total"]) for r in D.doc_search(d, "level = 'E'").collect()] == [("ok", 1)]
    assert [(r["status"], r["total"]) for r in D.recent_docs(d, "2024-03-01 00:00:00").collect()] == [("no_match", 0)]
    assert [(r["status"], r["n_visible"], r["n_hidden"]) for r in D.index_catalog(d, "*", allowed=["logs-*"]).collect()] == [("all_hidden", 0, 2)]
    assert [(r["status"], r["n_hidden"]) for r in D.index_catalog(d, "none-*").collect()] == [("no_match", 0)]
    pr = spark.createDataFrame([("1", "p", 5)], "job_id string, partition string, priority bigint")
    assert [(r["status"], r["total"]) for r in Qo.pending_priority(pr, partition="q").collect()] == [("none_pending", 0)]
    files = spark.createDataFrame([("/a", "/", "a", "d", None, T0, "u"), ("/a/f", "/a", "f", "f", 3, T0, "u"), ("/e", "/", "e", "d", None, T0, "u")],
                                  "path string, parent string, name string, kind string, size bigint, mtime timestamp_ntz, owner string")
    dirs = spark.createDataFrame([("/a",), ("/e",), ("/a/f",), ("/x",)], "path string")
    assert {r["parent"]: (r["status"], r["n_entries"]) for r in Fi.dir_listing(files, dirs).collect()} == {
        "/a": ("ok", 1), "/e": ("empty", 0), "/a/f": ("not_a_directory", 0), "/x": ("unknown_key", 0)}


def test_counts_of_all_levels_share_one_pass(spark):
    """Queue counts by state and user come from grouping sets over one scan; totals and reasons of stuck jobs from one row a user."""
    q = spark.createDataFrame([("1", "u1", "a", "PENDING", "p", "Licenses", dt.datetime(2024, 1, 1)), ("2_[1-9]", "u2", "a", "PENDING", "p", "JobHeldUser", None),
                               ("3", None, None, "RUNNING", "p", None, None), ("4", "u1", "b", "PENDING", "p", "Priority", None)],
                              "job_id string, user_name string, account string, state string, partition string, reason string, submit_ts timestamp_ntz")
    counts = Qo.running_counts(q, "account", 1)
    got = {(r["account"], r["dim"], r["value"]): (r["n"], r["rank"]) for r in counts.collect()}
    assert got == {("a", "state", "PENDING"): (2, 1), ("a", "user", "u1"): (1, 1), (None, "state", "RUNNING"): (1, 1), (None, "user", None): (1, 1),
                   ("b", "state", "PENDING"): (1, 1), ("b", "user", "u1"): (1, 1)}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") >= 1
    stuck = Qo.stuck_jobs(q, "2024-01-02 00:00:00").collect()
    assert {(r["reason"], r["bucket"], r["user_name"], r["reason_tasks"], r["n_tasks"], r["n_fatal"], r["n_suspect"]) for r in stuck} >= {("Priority", "NORMAL", None, 1, 11, r0["n_fatal"], r0["n_suspect"]) for r0 in stuck[:1]}
    assert all(r["n_tasks"] == 11 and r["n_fatal"] + r["n_suspect"] <= 10 for r in stuck)
    by = Qo.stuck_jobs(q, "2024-01-02 00:00:00", by=["account"]).collect()
    assert {(r["account"], r["n_tasks"]) for r in by} == {("a", 10), ("b", 1)}


def test_retry_step_is_chosen_inside_the_plan(spark):
    base = dt.datetime(2024, 1, 2)
    rows = [("m", {"instance": "n1:9100"}, base - dt.timedelta(minutes=7 + 10 * k), float(k)) for k in range(30)]
    s = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    run = lambda **kw: [(r["n"], r["step"]) for r in M.range_summary(s, "m", "2024-01-02 00:00:00", hours=5, **kw).collect()]
    assert run(step="30m", lookback="2m", retry_step="1m") == [(60, "1m")]
    assert run(step="30m", lookback="8m", retry_step="1m") == [(10, "30m")] and run(step="30m", lookback="2m", retry_step=None) == []


def test_host_patterns_are_checked(spark):
    import pytest
    s = spark.createDataFrame([], "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    with pytest.raises(ValueError, match="host pattern"):
        M.topk_nodes(s, "2024-01-02 00:00:00", "node'; x")


def test_relative_logs_of_jobs_without_a_work_dir(spark):
    from clusterlens.functions import scripts as S
    rows = spark.createDataFrame([("x.log", None), ("x.log", ""), ("x.log", "/w//"), ("/a/x.log", "/w")], "p string, w string")
    assert [r[0] for r in rows.select(S.absolute_log_path(F.col("p"), F.col("w"))).collect()] == ["x.log", "x.log", "/w/x.log", "/a/x.log"]
