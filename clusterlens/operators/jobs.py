"""Job-accounting operators: usage sums, histograms, failure clusters, history, efficiency.

Inputs are the canonical ``jobs`` / ``job_steps`` tables. Every operator
answers for all users / accounts / jobs at once; per-key views are a
``where`` on the result (or a ``guard_keys`` join for requested keys).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import parse as P
from ..functions import predicates as Q
from .guards import positive, top_per_group, with_total
from .queue import match_ids, requested_ids, snapshot_at


def _user(c: str = "user_name") -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("?"))


def in_window(jobs: DataFrame, as_of: str, days: float) -> DataFrame:
    """Jobs of the accounting window: still running, or ended at/after ``as_of - days``."""
    return jobs.where(Q.job_in_window("end_ts", Q.lookback_start(as_of, days=days)))


# ---------------------------------------------------------------- usage sums

def gpu_hours_by_user(jobs: DataFrame, as_of: str, days: float = 7) -> DataFrame:
    """GPU-hours per user, descending. Rows without a readable ``gres/gpu=`` are skipped.

    Integers are summed (GPU × seconds) and divided once, so the result does
    not depend on the summation order.
    """
    j = in_window(jobs, as_of, days).select(_user().alias("user_name"), P.tres_gpu("alloc_tres").alias("n_gpu"), "elapsed_s")
    agg = j.where(F.col("n_gpu").isNotNull()).groupBy("user_name").agg(
        (F.sum(F.col("n_gpu") * F.coalesce(F.col("elapsed_s"), F.lit(0))) / 3600.0).alias("gpu_hours"))
    return agg


def cpu_hours(jobs: DataFrame, by: Sequence[str] = ("user_name",)) -> DataFrame:
    """CPU-hours (``cpu=`` × elapsed / 3600, absent = 0) and job count per group."""
    cpu = F.coalesce(P.tres_cpu("alloc_tres"), F.lit(0)) * F.coalesce(F.col("elapsed_s"), F.lit(0))
    return jobs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_jobs"), (F.sum(cpu) / 3600.0).alias("cpu_hours"))


def state_histogram(jobs: DataFrame, by: Sequence[str] = ("user_name",)) -> DataFrame:
    """Jobs per first state token (blank = ``?``) per group."""
    return jobs.groupBy(*by, P.first_state("state").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def partition_histogram(jobs: DataFrame, by: Sequence[str] = ("user_name",), top: int = 6) -> DataFrame:
    """Top ``top`` partitions by job count per group, with the group's distinct partition total."""
    counts = jobs.groupBy(*by, F.coalesce(F.col("partition"), F.lit("?")).alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    limited = top_per_group(counts, by, [F.desc("n"), F.asc("partition")], top)
    return with_total(limited, counts, by, "n_partitions")


def top_members(jobs: DataFrame, by: Sequence[str] = ("account",), top: int = 8) -> DataFrame:
    """Per group, the ``top`` users by CPU-hours (jobs and CPU-hours each)."""
    per_user = cpu_hours(jobs.withColumn("user_name", _user()), [*by, "user_name"])
    return top_per_group(per_user, by, [F.desc("cpu_hours"), F.asc("user_name")], top)


# ----------------------------------------------------------------- clusters

def failure_clusters(
    jobs: DataFrame,
    by: Sequence[str] = (),
    min_size: int = 5,
    top: int = 3,
    users_shown: int = 5,
    exits_shown: int = 3,
) -> DataFrame:
    """Clusters of similar failing jobs: (normalised name, failure class), n ≥ ``min_size``, top ``top`` per group.

    Columns: ``by``…, pattern, state, n, n_users, users (first
    ``users_shown`` sorted), exits (top ``exits_shown`` exit codes with
    counts), n_exits (all of them), sample_job / sample_end (latest ended job; ties → larger id),
    rank. Users and exit codes are pre-aggregated per cluster before any
    per-cluster window, so a cluster holding a third of all jobs is still
    split across tasks.
    """
    keys = [*by, "pattern", "state"]
    base = jobs.select(
        *by,
        P.norm_job_name("job_name").alias("pattern"),
        Q.bad_state_key(P.first_state("state")).alias("state"),
        _user().alias("_user"),
        F.coalesce(F.nullif(F.col("exit_code"), F.lit("")), F.lit("?")).alias("exit_code"),
        F.col("job_id").alias("_job"),
        F.col("end_ts").alias("_end"),
    ).where(F.col("state").isNotNull())

    # One aggregate by user and exit code; clusters, their users and their codes are sums over it.
    per = base.groupBy(*keys, "_user", "exit_code").agg(
        F.count(F.lit(1)).alias("c"), F.max(F.when(F.col("_end").isNotNull(), F.struct("_end", "_job"))).alias("_latest"))
    clusters = per.groupBy(*keys).agg(F.sum("c").alias("n"), F.max("_latest").alias("_latest")).where(F.col("n") >= min_size)
    clusters = clusters.select(*keys, "n", F.col("_latest")["_job"].alias("sample_job"), F.col("_latest")["_end"].alias("sample_end"))
    ranked = top_per_group(clusters, by, [F.desc("n"), F.asc("pattern"), F.asc("state")], top)

    users = per.select(*keys, "_user").distinct()
    n_users = users.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_users"))
    shown = (top_per_group(users, keys, [F.asc("_user")], users_shown, "_r")
             .groupBy(*keys).agg(F.array_sort(F.collect_list("_user")).alias("users")))

    exits = per.groupBy(*keys, "exit_code").agg(F.sum("c").alias("c"))
    n_exits = exits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_exits"))
    exits_top = (top_per_group(exits, keys, [F.desc("c"), F.asc("exit_code")], exits_shown, "_r")
                 .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_r", "exit_code", "c"))).alias("_e"))
                 .select(*keys, F.transform("_e", lambda e: F.struct(e["exit_code"].alias("exit_code"), e["c"].alias("n"))).alias("exits")))

    return ranked.join(n_users, keys, "left").join(shown, keys, "left").join(exits_top, keys, "left").join(n_exits, keys, "left")


def exit_histogram(jobs: DataFrame, top: int = 3, min_size: int = 5) -> DataFrame:
    """Exit-code counts of every failure cluster of size ≥ ``min_size``, top ``top`` codes per cluster."""
    keys = ["pattern", "state"]
    base = jobs.select(
        P.norm_job_name("job_name").alias("pattern"),
        Q.bad_state_key(P.first_state("state")).alias("state"),
        F.coalesce(F.nullif(F.col("exit_code"), F.lit("")), F.lit("?")).alias("exit_code"),
    ).where(F.col("state").isNotNull())
    counts = base.groupBy(*keys, "exit_code").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("cluster_n")).where(F.col("cluster_n") >= min_size)
    return top_per_group(counts.join(sizes, keys, "inner"), keys, [F.desc("n"), F.asc("exit_code")], top)


# ------------------------------------------------------------------ history

def job_history(
    jobs: DataFrame,
    as_of: str,
    days: float = 7,
    top: int = 200,
    by: Sequence[str] = ("user_name",),
    user: str | None = None,
    account: str | None = None,
    state: str | None = None,
) -> DataFrame:
    """Most recent ``top`` jobs of the window per group, with the group's exact total.

    Order: end time descending, still-running (null end) first, job id
    descending as tie-break; ``rank`` 1 = most recent. ``account`` selects
    all its users (optionally narrowed by ``user``), else ``user``.
    """
    positive(top, "top")
    j = in_window(jobs, as_of, days)
    if account:
        j = j.where(F.col("account") == account)
        if user:
            j = j.where(F.col("user_name") == user)
    elif user:
        j = j.where(F.col("user_name") == user)
    if state:
        j = j.where(P.first_state("state") == state)
    limited = top_per_group(j, by, [F.col("end_ts").desc_nulls_first(), F.desc("job_id")], top)
    return with_total(limited, j, by)


def short_histogram(jobs: DataFrame, as_of: str, days: float = 7, max_elapsed_s: int = 300) -> DataFrame:
    """Short jobs (0 < elapsed < ``max_elapsed_s``) of the window counted by user, job name and elapsed seconds."""
    short = in_window(jobs, as_of, days).where((F.col("elapsed_s") > 0) & (F.col("elapsed_s") < max_elapsed_s))
    return short.groupBy(_user().alias("user_name"), "job_name", "elapsed_s").agg(F.count(F.lit(1)).alias("c"))


def short_job_stats(jobs: DataFrame, as_of: str, days: float = 7, max_elapsed_s: int = 300) -> DataFrame:
    """Per user: short jobs (0 < elapsed < ``max_elapsed_s``) of the window and their upper median.

    The upper median (element ``n // 2`` of the sorted list) is found from
    the per-user histogram of elapsed seconds — at most ``max_elapsed_s``
    values per user — so no user's jobs are ever sorted in one task.
    """
    return short_stats_of(short_histogram(jobs, as_of, days, max_elapsed_s))


def short_stats_of(histogram: DataFrame) -> DataFrame:
    """``short_job_stats`` out of a ``short_histogram``."""
    hist = histogram.groupBy("user_name", "elapsed_s").agg(F.sum("c").alias("c"))
    w = Window.partitionBy("user_name").orderBy("elapsed_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("cum", F.sum("c").over(w)).withColumn("total_short", F.sum("c").over(Window.partitionBy("user_name")))
    return hist.groupBy("user_name").agg(
        F.first("total_short").alias("total_short"),
        F.min(F.when(F.col("cum") >= F.floor(F.col("total_short") / 2) + 1, F.col("elapsed_s"))).alias("median_elapsed"),
    )


def short_names_of(histogram: DataFrame) -> DataFrame:
    """Short jobs per (user, job name) out of a ``short_histogram``."""
    return histogram.groupBy("user_name", "job_name").agg(F.sum("c").alias("same_name"))


def short_job_note(elapsed: Column, is_service: Column, total_short: Column) -> Column:
    """``isolated`` / ``moderate`` / ``grouping_candidate`` for a short job; null otherwise."""
    short = ~is_service & (elapsed > 0) & (elapsed < 300)
    return (F.when(~short, F.lit(None).cast("string"))
            .when(F.coalesce(total_short, F.lit(0)) == 0, "isolated")
            .when(total_short < 20, "moderate")
            .otherwise("grouping_candidate"))


# ---------------------------------------------------------------- efficiency

def job_efficiency(job_steps: DataFrame, jobs: DataFrame, interactive_partitions: Sequence[str] = ("visu",)) -> DataFrame:
    """CPU, memory and walltime efficiency with verdict codes, for every job (and array task).

    Main rows (no ``.`` in the id) carry the job's fields; step rows are
    reduced per base id (text before the first ``.``) to their peak RSS and
    count; of a job with no main row the first step row stands for it. The
    interactive flag comes from a left join to ``jobs``.
    """
    is_main = ~F.col("step_id").contains(".")
    rss = P.mem_bytes("max_rss")["bytes"]
    # Main rows pass through as they are; the steps are reduced to numbers per
    # job (peak RSS, count), a fixed-width hash aggregate with map-side combine.
    main = job_steps.where(is_main).select(
        F.col("step_id").alias("job_id"), "state", "elapsed_s", "alloc_cpus", "n_nodes", "total_cpu", "req_mem",
        "timelimit_min", rss.alias("main_rss"))
    fields = ["state", "elapsed_s", "alloc_cpus", "n_nodes", "total_cpu", "req_mem", "timelimit_min"]
    steps = job_steps.where(~is_main).groupBy(P.step_base_id("step_id").alias("job_id")).agg(
        F.max(rss).alias("step_rss"), F.count(F.lit(1)).alias("n_steps"), F.min_by(F.struct(*fields), "step_id").alias("_first"))
    main = main.withColumn("_main", F.lit(True))
    g = main.join(steps, "job_id", "full").withColumn("n_steps", F.coalesce("n_steps", F.lit(0)))
    g = g.select("job_id", "main_rss", "step_rss", "n_steps",
                 *(F.when(F.col("_main"), F.col(c)).otherwise(F.col("_first")[c]).alias(c) for c in fields))
    info = jobs.select("job_id", F.col("batch_flag"), F.col("partition"))
    e = g.join(info, "job_id", "left")

    # Each parsed text is computed once, in its own projection, and referenced by name below.
    e = e.select(
        "*",
        P.duration_seconds("total_cpu").alias("_cpu_used"),
        P.mem_bytes("req_mem").alias("_req"),
        P.limit_minutes("timelimit_min").alias("_limit"),
        F.when(F.col("n_steps") > 0, F.col("step_rss")).otherwise(F.col("main_rss")).alias("_rss"),
    )
    service = Q.is_interactive("batch_flag", "partition", interactive_partitions)
    elapsed = F.coalesce(F.col("elapsed_s"), F.lit(0))
    cpus = F.coalesce(F.col("alloc_cpus"), F.lit(0))
    nodes = F.coalesce(F.col("n_nodes"), F.lit(1))
    cpu_used = F.col("_cpu_used")
    cpu_eff = F.when(cpu_used.isNotNull() & (elapsed != 0) & (cpus != 0), cpu_used / (elapsed * cpus))
    max_rss = F.col("_rss")
    req = F.col("_req")
    req_bytes = (F.when(req["mode"] == "c", req["bytes"] * F.greatest(cpus, F.lit(1)))
                 .when(req["mode"] == "n", req["bytes"] * F.greatest(nodes, F.lit(1)))
                 .otherwise(req["bytes"]))
    e = e.withColumn("_req_bytes", F.when(req.isNotNull(), req_bytes))
    req_bytes = F.col("_req_bytes")
    mem_eff = F.when(max_rss.isNotNull() & req_bytes.isNotNull(), F.when(req_bytes != 0, max_rss / req_bytes).otherwise(F.lit(0.0)))
    limit = F.col("_limit")
    time_eff = F.when(limit.isNotNull() & (elapsed != 0) & (limit != 0), elapsed / (limit * 60))
    has_time = limit.isNotNull() & (elapsed != 0)
    state = F.coalesce(F.col("state"), F.lit(""))

    e = e.select(
        "job_id", "state", "elapsed_s", "alloc_cpus", "n_nodes",
        service.alias("is_service"),
        cpu_eff.alias("cpu_eff"),
        max_rss.alias("max_rss_bytes"),
        req_bytes.alias("req_bytes"),
        mem_eff.alias("mem_eff"),
        time_eff.alias("time_eff"),
        has_time.alias("_has_time"),
        state.alias("_state"),
    )
    svc, el = F.col("is_service"), F.coalesce(F.col("elapsed_s"), F.lit(0))
    verdicts = F.array_compact(F.array(
        F.when(~svc & (F.col("cpu_eff") < 0.5) & (el > 300), F.lit("cpu_under")),
        F.when(~svc & (F.col("mem_eff") < 0.4) & (el > 300), F.lit("mem_over"))
        .when(F.col("mem_eff") > 0.9, F.lit("mem_near_limit")),
        F.when(F.col("_has_time") & F.col("_state").contains("TIMEOUT"), F.lit("timeout"))
        .when(F.col("_has_time") & ~svc & (F.col("time_eff") < 0.2) & (el > 600), F.lit("time_over")),
        F.when(F.col("_state").contains("OUT_OF_MEMORY"), F.lit("oom")),
    ))
    return e.withColumn("verdicts", verdicts).withColumn(
        "ok", (F.size("verdicts") == 0) & ~svc).drop("_has_time", "_state")


def max_rss(job_steps: DataFrame) -> DataFrame:
    """Peak resident memory of each job: the largest over its steps if it has any, else its main row's."""
    is_main = ~F.col("step_id").contains(".")
    rss = P.mem_bytes("max_rss")["bytes"]
    return job_steps.groupBy(P.step_base_id("step_id").alias("job_id")).agg(
        F.coalesce(F.max(F.when(~is_main, rss)), F.when(F.count_if(~is_main) == 0, F.max(F.when(is_main, rss)))).alias("max_rss_bytes"),
        F.count_if(~is_main).alias("n_steps"))


def job_details(ids: DataFrame, queue: DataFrame, job_steps: DataFrame, as_of: str | None = None) -> DataFrame:
    """Live queue rows and accounting rows of each requested job or array task, one under the other.

    ``part`` says which side a row is from (``queue`` or ``accounting``; null
    where a request has no rows), so a job of Q queue rows and S accounting
    rows has Q + S rows. ``status``: ``ok``; ``not_in_queue`` (accounting
    only); ``no_accounting`` (queue only); ``unknown_key``; ``invalid_key``.
    """
    req = requested_ids(ids)
    q = snapshot_at(queue, as_of).select(F.col("job_id").alias("queue_job_id"), F.col("state").alias("queue_state"),
                                         "reason", "partition", "submit_ts", "node_list")
    s = job_steps.select("step_id", F.col("state").alias("acct_state"), "elapsed_s", "max_rss",
                         "exit_code" if "exit_code" in job_steps.columns else F.lit(None).cast("string").alias("exit_code"))
    rows = match_ids(req, q, "queue_job_id").withColumn("part", F.lit("queue")).unionByName(
        match_ids(req, s, "step_id").withColumn("part", F.lit("accounting")), allowMissingColumns=True)
    has = rows.groupBy("job_id").agg(F.bool_or(F.col("part") == "queue").alias("_q"), F.bool_or(F.col("part") == "accounting").alias("_s"))
    status = (F.when(~F.col("_valid"), "invalid_key").when(F.col("_q").isNull(), "unknown_key")
              .when(~F.col("_q"), "not_in_queue").when(~F.col("_s"), "no_accounting").otherwise("ok"))
    keyed = req.join(has, "job_id", "left").withColumn("status", status)
    found = keyed.where(F.col("_q").isNotNull()).select("job_id", "status").join(rows, "job_id", "inner")
    return found.unionByName(keyed.where(F.col("_q").isNull()).select("job_id", "status"), allowMissingColumns=True)
