"""Composite reports: one row per requested user, account or job, joining the other operators.

Every input is first narrowed to the requested keys (left-semi joins), so
a report's work follows the size of the request; every list is bounded by
a per-group limit before it is collected, and every count beside a list is
exact. Requested keys always keep their row, with a ``status``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions import predicates as Q
from ..functions import scripts as S
from ..session import discard, run_folder, stored
from . import files as Fi
from . import intervals as I
from . import jobs as J
from . import logs as L
from . import queue as Qo
from .guards import top_per_group


def _ranked_list(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, fields: Sequence[str], name: str) -> DataFrame:
    """Per group, the first ``n`` rows by ``order`` as an ordered array of structs of ``fields``."""
    ranked = top_per_group(df, list(by), list(order), n, "_r")
    return ranked.groupBy(*by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_r", *fields))), lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias(name))


def _request(keys: DataFrame, key: str, known: DataFrame, valid) -> DataFrame:
    kn = known.select(key).distinct().withColumn("_known", F.lit(True))
    r = keys.select(key).distinct().withColumn("_valid", valid(F.col(key)))
    return r.join(kn, key, "left").withColumn(
        "status", F.when(~F.col("_valid"), "invalid_key").when(F.col("_known").isNull(), "unknown_key").otherwise("ok"))


def _beside(req: DataFrame, key: str, parts: Sequence[DataFrame]) -> DataFrame:
    """``req`` left-joined to ``parts`` by ``key``, of which each side has one row a key at most.

    One aggregate over all of them rather than a join for each: joins in a row
    share a stage, and its tasks would hold two sorted inputs for every part.
    """
    # dealt by another key than the parts: tasks take one part each then, not all parts of a key one after another
    rows = req.withColumn("_asked", F.lit(True)).repartition(F.xxhash64(key))
    for part in parts:
        rows = rows.unionByName(part, allowMissingColumns=True)
    columns = [c for c in rows.columns if c not in (key, "_asked")]
    both = rows.groupBy(key).agg(F.max("_asked").alias("_asked"), *[F.first(c, ignorenulls=True).alias(c) for c in columns])
    return both.where("_asked").drop("_asked")


def members(assoc: DataFrame, shown: int = 15) -> DataFrame:
    """Distinct non-blank members of each account: count and the first ``shown`` sorted."""
    m = assoc.where(F.trim("user_name") != "").select("account", "user_name").distinct()
    n = m.groupBy("account").agg(F.count(F.lit(1)).alias("n_members"))
    first = _ranked_list(m, ["account"], [F.asc("user_name")], shown, ["user_name"], "_m").select(
        "account", F.transform("_m", lambda e: e["user_name"]).alias("members"))
    return n.join(first, "account", "left")


def user_overview(logins: DataFrame, users: DataFrame, jobs: DataFrame, queue: DataFrame, shares: DataFrame,
                  as_of: str, days: float = 7, running_shown: int = 12, fair_rows: int = 8, log_lines: DataFrame | None = None) -> DataFrame:
    """State of each requested login: queue, window history, failure clusters with exit codes, fair share.

    With ``log_lines`` also ``cluster_logs``: the log tails of the representative jobs of the 2 largest clusters.
    """
    req = _request(logins, "user_name", users, Q.valid_name)
    ok = req.where(F.col("status") == "ok").select("user_name")
    q = Qo.current(queue, as_of).join(ok, "user_name", "left_semi")
    run_n = q.groupBy("user_name").agg(F.count(F.lit(1)).alias("queue_jobs"))
    run_ids = _ranked_list(q, ["user_name"], [F.asc("job_id")], running_shown, ["job_id", "state"], "queue_shown")
    jw = J.in_window(jobs.join(ok, "user_name", "left_semi"), as_of, days)
    hist = J.cpu_hours(jw, ["user_name"])
    states = _ranked_list(J.state_histogram(jw, ["user_name"]), ["user_name"], [F.desc("n"), F.asc("state")], 1 << 20, ["state", "n"], "states")
    parts = _ranked_list(J.partition_histogram(jw, ["user_name"], 6), ["user_name"], [F.asc("rank")], 6, ["partition", "n"], "partitions")
    cl = _ranked_list(J.failure_clusters(jw, by=["user_name"]), ["user_name"], [F.asc("rank")], 3,
                      ["pattern", "state", "n", "sample_job", "exits", "n_exits"], "clusters")
    fs = Qo.fairshare_lookup(Qo.current(shares, as_of).join(ok, "user_name", "left_semi"))
    fair = _ranked_list(fs, ["user_name"], [F.asc("account")], fair_rows, ["account", "level_fs"], "fairshare")
    out = req.drop("_valid", "_known")
    logs = [] if log_lines is None else [_log_list(jw, log_lines, "user_name")]
    return _beside(out, "user_name", [run_n, run_ids, hist, states, parts, cl, fair, *logs])


def account_overview(accounts: DataFrame, assoc: DataFrame, jobs: DataFrame, queue: DataFrame, as_of: str,
                     days: float = 7, top_users: int = 8, log_lines: DataFrame | None = None) -> DataFrame:
    """State of each requested account: members, queue by state and user, history, top members, clusters with users and exit codes.

    With ``log_lines`` also ``cluster_logs``: the log tails of the representative jobs of the 2 largest clusters.
    """
    req = _request(accounts, "account", assoc, Q.valid_name)
    ok = req.where(F.col("status") == "ok").select("account")
    mem = members(assoc.join(ok, "account", "left_semi"))
    q = Qo.current(queue, as_of).join(ok, "account", "left_semi")
    rc = Qo.running_counts(q, "account", top_users)
    q_n = q.groupBy("account").agg(F.count(F.lit(1)).alias("queue_jobs"))
    q_states = _ranked_list(rc.where(F.col("dim") == "state"), ["account"], [F.asc("rank")], 1 << 20,
                            ["value", "n"], "queue_states")
    q_users = _ranked_list(rc.where(F.col("dim") == "user"), ["account"], [F.asc("rank")], top_users, ["value", "n"], "queue_users")
    jw = J.in_window(jobs.join(ok, "account", "left_semi"), as_of, days)
    hist = jw.groupBy("account").agg(F.count(F.lit(1)).alias("n_jobs"))
    states = _ranked_list(J.state_histogram(jw, ["account"]), ["account"], [F.desc("n"), F.asc("state")], 1 << 20, ["state", "n"], "states")
    tm = _ranked_list(J.top_members(jw, ["account"], top_users), ["account"], [F.asc("rank")], top_users,
                      ["user_name", "n_jobs", "cpu_hours"], "top_members")
    cl = _ranked_list(J.failure_clusters(jw, by=["account"]), ["account"], [F.asc("rank")], 3,
                      ["pattern", "state", "n", "n_users", "users", "sample_job", "exits", "n_exits"], "clusters")
    out = req.drop("_valid", "_known")
    logs = [] if log_lines is None else [_log_list(jw, log_lines, "account")]
    return _beside(out, "account", [mem, q_n, q_states, q_users, hist, states, tm, cl, *logs])


def cluster_logs(jobs: DataFrame, log_lines: DataFrame, by: Sequence[str] = ("account",), clusters: int = 2, lines: int = 12) -> DataFrame:
    """The last ``lines`` log lines of the representative job of the ``clusters`` largest failure clusters per group."""
    top = J.failure_clusters(jobs, by=list(by), top=clusters).select(*by, "pattern", "state", "n", F.col("sample_job").alias("job_id"), "rank")
    sample_jobs = jobs.join(top.select("job_id").distinct(), "job_id", "left_semi")
    tail = L.job_log_tail(sample_jobs, log_lines, lines)
    return top.join(tail, "job_id", "left")


def _log_list(jobs: DataFrame, log_lines: DataFrame, by: str) -> DataFrame:
    """``cluster_logs`` per group: the lines of ``cluster_logs`` in order, each with its file's exact line count; guard rows keep their status."""
    tail = cluster_logs(jobs, log_lines, [by])
    # the tail ends with the file's last line, whose number is the file's number of lines
    tail = tail.withColumn("n_lines", F.max("lineno").over(Window.partitionBy(by, "rank", "path")))
    fields = ["rank", "label", "lineno", "pattern", "state", "n", "job_id", "path", "line", "n_lines", "status"]
    return tail.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("cluster_logs"))


def _mem_used_pct(samples: DataFrame) -> DataFrame:
    """Used memory in percent as a series: total less free, cached and buffers, where one node has all four at one time."""
    total, *rest = (f"node_memory_{m}_bytes" for m in ("MemTotal", "MemFree", "Cached", "Buffers"))
    value = {m: F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in (total, *rest)}
    at = samples.where(F.col("metric").isin(total, *rest)).groupBy(F.col("labels")["instance"].alias("_i"), "ts").agg(*value.values())
    used = F.col(total) - F.col(rest[0]) - (F.col(rest[1]) + F.col(rest[2]))
    return at.select(F.lit("mem_used_pct").alias("metric"), F.create_map(F.lit("instance"), F.col("_i")).alias("labels"), "ts",
                     F.when(F.col(total) > 0, used / F.col(total) * 100).alias("value")).where("value is not null")


def _summary(of: Column, name: str) -> list[Column]:
    """min, max, avg and sample count over the per-node summaries of one metric."""
    mine = lambda c: F.when(of, F.col(c))
    return [F.min(mine("min")).alias(f"{name}_min"), F.max(mine("max")).alias(f"{name}_max"),
            (F.sum(F.when(of, F.col("avg") * F.col("n"))) / F.sum(mine("n"))).alias(f"{name}_avg"), F.sum(mine("n")).alias(f"{name}_samples")]


#: Runs meet the samples in so many parts of the nodes, one after another: what a part shuffles is gone before the next.
#: Grids take fewer than samples of whole runs: they shuffle less, and each part lays out its nodes' states anew.
NODE_PARTS, GRID_PARTS = 3, 2


def _run_metrics(runs: DataFrame, samples: DataFrame, as_of: str, lookback: str | int | None, kept: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Per run and node: load5 and used memory over all samples of the run, or on its own grid if a ``lookback`` is given."""
    if lookback is None:
        series = samples.where(F.col("metric") == "node_load5").select("metric", "labels", "ts", "value").unionByName(_mem_used_pct(samples))
        series = kept(series, "series")

    def met(part: tuple[int, int]) -> DataFrame:
        if lookback is None:
            return I.join_interval_metrics(runs, series, as_of, ["node_load5", "mem_used_pct"], part=part).replace("node_load5", "load5", ["metric"])
        return I.run_grid_metrics(runs, samples, as_of, lookback=lookback, part=part)

    of = NODE_PARTS if lookback is None else GRID_PARTS
    parts = [kept(met((k, of)).select("job_id", "metric", "n", "min", "max", "avg"), f"node-part-{k}") for k in range(of)]
    return functools.reduce(DataFrame.unionByName, parts)


LOG_TAIL = "array<struct<label:string,lineno:bigint,path:string,line:string>>"


def job_diagnosis(ids: DataFrame, jobs: DataFrame, job_steps: DataFrame, queue: DataFrame, nodes: DataFrame,
                  scripts: DataFrame, files: DataFrame, log_lines: DataFrame, samples: DataFrame, as_of: str,
                  metrics_as_of: str | None = None, metric_jobs: DataFrame | None = None,
                  interactive_partitions: Sequence[str] = ("visu",), roots: Sequence[str] = ("/work",), log_n: int = 30,
                  metric_lookback: str | int | None = None, log_texts: bool = True) -> DataFrame:
    """Full diagnosis of each requested job, its parts stored one after another.

    One row per requested id. A job whose queue rows are all PENDING gets the
    pending context (of its row of highest priority); the others get efficiency and
    verdicts, script facts with the file check of all paths and the
    parallelism note, their log tail (``log_tail``, the last ``log_n`` lines of each
    file, empty without ``log_texts``; ``log_lines`` counts these, ``log_lines_total`` all lines of the files),
    node load and used memory during the run (min, max, avg; from
    ``metric_jobs`` intervals, default ``jobs``) and the short-job note. With
    ``metric_lookback`` these are values on the run's own grid of about 100
    points, each the latest sample in the lookback; else all samples of the run.
    ``status``: ``pending``, ``ok``, ``unknown_key``, ``invalid_key``.
    """
    spark = ids.sparkSession
    # Each part is stored once it is done, and its shuffle files go: else those of all parts lie on disk at once.
    places: dict[str, str] = {}

    def kept(part: DataFrame, name: str) -> DataFrame:
        places[name] = run_folder(spark, f"diagnosis-{name}")
        return stored(part, name, places[name])

    def drop(names: Collection[str]) -> None:
        for name in names:
            discard(spark, places[name])

    req, queue = kept(Qo.requested_ids(ids), "requests"), Qo.current(queue, as_of)
    ok = req.where("_valid").select("job_id")
    # the queue rows of an array job are reduced to one row per requested id before any join
    q = queue.select(F.col("job_id").alias("queue_job_id"), F.col("state").alias("_qstate"), "reason", "priority", "partition")
    is_pending = F.col("_qstate") == "PENDING"
    qb = Qo.match_ids(req, q, "queue_job_id").groupBy("job_id").agg(
        F.count(F.lit(1)).alias("queue_rows"),
        F.coalesce(F.min(F.when(~is_pending, F.col("_qstate"))), F.max("_qstate")).alias("queue_state"),
        F.max(F.when(is_pending, F.struct("priority", "queue_job_id", "reason", "partition"))).alias("_p"))
    all_pending = F.col("queue_state") == "PENDING"
    qb = qb.select("job_id", "queue_rows", "queue_state",
                   *(F.when(all_pending, F.col("_p")[c]).alias(c) for c in ("reason", "priority", "partition")))
    qb = qb.join(F.broadcast(Qo.pending_count(queue)), "partition", "left").withColumn(  # one row a partition
        "pending_in_partition", F.when(all_pending, F.coalesce("pending_in_partition", F.lit(0))))
    qb = kept(qb, "queue")
    # what the parts need of the requested jobs, read and joined once
    mine = jobs.select("job_id", "user_name", "job_name", "elapsed_s", "state", "batch_flag", "partition", "work_dir", "stdout", "stderr")
    mine = kept(mine.join(ok, "job_id", "left_semi"), "jobs")
    steps = job_steps.join(ok, P.step_base_id(job_steps["step_id"]) == ok["job_id"], "left_semi")
    eff = kept(J.job_efficiency(steps, mine, interactive_partitions).select(
        "job_id", "is_service", "alloc_cpus", "n_nodes", "cpu_eff", "mem_eff", "time_eff", "verdicts"), "efficiency")
    asked = scripts.join(ok, "job_id", "left_semi")
    sf = kept(Fi.script_facts(mine, asked, roots).select(
        "job_id", "modules", "mechanisms", F.col("status").alias("script_status")), "scripts")
    fc = kept(Fi.file_check(asked, files, roots, (1 << 31) - 1).groupBy("job_id").agg(
        F.count_if(F.col("check") == "OK").alias("files_ok"), F.count_if(F.col("check") == "ABSENT").alias("files_absent")), "files")
    logs = kept(L.job_log_counts(mine, log_lines, log_n), "logs")
    runs = (metric_jobs if metric_jobs is not None else jobs).select("job_id", "node_list", "start_ts", "end_ts")
    runs = kept(runs.join(ok, "job_id", "left_semi"), "runs")
    met = _run_metrics(runs, samples, metrics_as_of or as_of, metric_lookback, kept)
    met = kept(met.groupBy("job_id").agg(*(c for m in ("load5", "mem_used_pct") for c in _summary(F.col("metric") == m, m))), "metrics")
    histogram = J.short_histogram(jobs, as_of, 7)
    short = J.short_stats_of(histogram).select("user_name", F.col("total_short").alias("short_total"), F.col("median_elapsed").alias("short_median"))
    same = J.short_names_of(histogram).withColumnRenamed("same_name", "short_same_name")
    me = mine.select("job_id", "user_name", "job_name", "elapsed_s", "state")
    me = kept(me.join(short, "user_name", "left").join(same, ["user_name", "job_name"], "left"), "short")
    parts = {"requests", "queue", "efficiency", "scripts", "files", "logs", "metrics", "short"}
    drop(places.keys() - parts)  # of use while the parts were made

    out = req.join(qb, "job_id", "left").join(me, "job_id", "left")
    for part in (eff, sf, fc, logs, met):
        out = out.join(part, "job_id", "left")
    if log_texts:  # last: a job's lines move no further once they are beside it
        out = kept(out, "report")
        drop(parts - {"logs"})
        out = out.join(L.log_texts(logs, log_lines, log_n), "log_files", "left")
    else:
        out = out.withColumn("log_tail", F.lit(None).cast(LOG_TAIL))
    svc = F.coalesce(F.col("is_service"), F.lit(False))
    status = (F.when(~F.col("_valid"), "invalid_key")
              .when(F.col("queue_state") == "PENDING", "pending")
              .when(F.col("user_name").isNull() & F.col("queue_state").isNull(), "unknown_key")
              .otherwise("ok"))
    return out.select(
        "job_id", status.alias("status"), "queue_rows", "queue_state", "reason", "priority", "partition", "pending_in_partition",
        "state", "elapsed_s", *(F.when(~F.coalesce(all_pending, F.lit(False)), F.col(c)).alias(c) for c in ("cpu_eff", "mem_eff", "time_eff", "verdicts")), "modules", "script_status", "files_ok", "files_absent",
        F.when(F.col("script_status") == "ok", S.parallel_note(F.col("mechanisms"), F.col("alloc_cpus"), F.col("n_nodes"))).alias("parallel_note"),
        "log_lines", "log_lines_total", F.when(F.col("log_files").isNotNull(), F.coalesce("log_tail", F.array().cast(LOG_TAIL))).alias("log_tail"), "log_files_missing", *(f"{m}_{x}" for m in ("load5", "mem_used_pct") for x in ("min", "max", "avg", "samples")),
        J.short_job_note(F.coalesce(F.col("elapsed_s"), F.lit(0)), svc, F.col("short_total")).alias("short_note"),
        "short_total", "short_same_name", "short_median",
    )
