"""Queue and node-state operators: filters, pending context, stuck jobs, memory over-reservation.

Tables with ``snapshot_ts`` hold a history of snapshots; ``snapshot_at``
reads the latest snapshot taken at or before ``as_of``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions import predicates as Q
from . import guards as G
from .guards import top_per_group

# Pending reasons that never resolve without intervention.
FATAL_REASONS = (
    "DependencyNeverSatisfied", "JobHeldAdmin", "JobHeldUser", "launch_failed_requeued_held",
    "PartitionNodeLimit", "PartitionTimeLimit", "PartitionConfig", "InvalidQOS", "InvalidAccount",
    "AccountNotAllowed", "QOSUsageThreshold",
)
# Pending reasons worth a check.
SUSPECT_REASONS = ("ReqNodeNotAvail", "BeginTime", "Licenses", "BadConstraints")

KB_PER_GB = 1 << 20
ALLOCATED_STATES = ("allocated", "mixed", "completing")


def snapshot_at(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows of the latest snapshot at or before ``as_of`` (the latest of all when None).

    A table without ``snapshot_ts`` is one snapshot and stays as it is. The
    snapshot's time is a scalar subquery over that one column; with
    date-partitioned storage both filters prune partitions.
    """
    if "snapshot_ts" not in df.columns:
        return df
    upto = df if as_of is None else df.where(F.col("snapshot_ts") <= F.to_timestamp_ntz(F.lit(as_of)))
    return upto.where(F.col("snapshot_ts") == upto.agg(F.max("snapshot_ts")).scalar())


def current(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """``snapshot_at`` without the time column: operators called with it take it as it is."""
    return snapshot_at(df, as_of).drop("snapshot_ts")


def requested_ids(ids: DataFrame) -> DataFrame:
    """Distinct requested ``job_id`` and whether each is well formed (``_valid``)."""
    return ids.select("job_id").distinct().withColumn("_valid", F.coalesce(Q.valid_job_id("job_id"), F.lit(False)))


def match_ids(req: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` of the job or array task that each valid requested ``job_id`` names.

    A base id (``5``) names all rows of the job; a task id (``5_1``) its own
    rows and the pending array row that holds it (``5_[1-9]``). All three
    are one equi-join: rows and requests are keyed by base id, by task id,
    or by base id and an open bracket, so tasks of one array job meet only
    their own rows.
    """
    base, part = P.base_job_id("job_id"), P.array_part("job_id")
    wanted = req.where("_valid").select(
        "job_id", part.alias("_task"),
        F.explode(F.when(part.isNull(), F.array(base)).otherwise(F.array(F.concat(base, F.lit("_"), part), F.concat(base, F.lit("_["))))).alias("_key"))
    base, part = P.base_job_id(id_col), P.array_part(id_col)
    inner = F.when(part.startswith("["), F.lit("[")).otherwise(part)
    own = rows.withColumn("_part", part).withColumn("_key", F.explode(F.array_compact(F.array(base, F.concat(base, F.lit("_"), inner)))))
    met = wanted.join(own, "_key", "inner")
    return met.where(~F.col("_key").endswith("_[") | P.holds_task("_part", "_task")).drop("_key", "_task", "_part")


def queue_filter(queue: DataFrame, user: str | None = None, account: str | None = None,
                 state: str | None = None, partition: str | None = None, users: DataFrame | None = None,
                 as_of: str | None = None) -> DataFrame:
    """Queue rows matching every non-empty equality filter.

    With ``users`` (the known logins) and a ``user``, the rows carry
    ``status = ok``, and one guard row says why there are none:
    ``invalid_key``, ``unknown_key`` (an unknown login is not an empty
    queue) or ``empty``.
    """
    rows = snapshot_at(queue, as_of).where(Q.opt_equals(user_name=user, account=account, state=state, partition=partition))
    if users is None or not user:
        return rows
    spark = queue.sparkSession
    known = users.where(F.col("user_name") == user).agg(F.count(F.lit(1))).scalar()
    found = rows.agg(F.count(F.lit(1))).scalar()
    status = (F.when(~Q.valid_name(F.lit(user)), "invalid_key").when(known == 0, "unknown_key")
              .when(found == 0, "empty"))
    guard = spark.range(1).select(F.lit(user).alias("user_name"), status.alias("status")).where(F.col("status").isNotNull())
    return rows.withColumn("status", F.lit("ok")).unionByName(guard, allowMissingColumns=True)


# ------------------------------------------------------------- node states

def partition_node_states(nodes: DataFrame, gres_shown: int = 20, as_of: str | None = None) -> DataFrame:
    """Per partition: allocated / idle / other / total node counts, availability and GPU resources."""
    nodes = current(nodes, as_of)
    st = F.lower(F.regexp_replace(F.col("state"), r"[*~#!%$@^-]+$", ""))
    counts = nodes.groupBy("partition").agg(
        F.count_if(st.isin(*ALLOCATED_STATES)).alias("allocated"),
        F.count_if(st == "idle").alias("idle"),
        F.count_if(~st.isin(*ALLOCATED_STATES, "idle")).alias("other"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("available", F.when(F.col("allocated") + F.col("idle") > 0, "up").otherwise("down"))
    g = nodes.where(F.col("gres").isNotNull() & (F.col("gres") != "(null)")).select("partition", "gres").distinct()
    gl = (top_per_group(g, ["partition"], [F.asc("gres")], gres_shown, "_r")
          .groupBy("partition").agg(F.array_sort(F.collect_list("gres")).alias("gres")))
    return counts.join(gl, "partition", "left")


def down_nodes(nodes: DataFrame, shown: int = 50, as_of: str | None = None) -> DataFrame:
    """Nodes with a down/drain reason grouped by (state, reason): count and the first ``shown`` names."""
    d = current(nodes, as_of).where(F.col("reason").isNotNull() & (F.trim("reason") != "")).select("state", "reason", "node").distinct()
    counts = d.groupBy("state", "reason").agg(F.count(F.lit(1)).alias("n_nodes"))
    names = (top_per_group(d, ["state", "reason"], [F.asc("node")], shown, "_r")
             .groupBy("state", "reason").agg(F.array_sort(F.collect_list("node")).alias("nodes")))
    return counts.join(names, ["state", "reason"], "left")


# ----------------------------------------------------------- pending jobs

def pending_count(queue: DataFrame, as_of: str | None = None) -> DataFrame:
    """PENDING rows per partition (arrays count once)."""
    return snapshot_at(queue, as_of).where(F.col("state") == "PENDING").groupBy("partition").agg(F.count(F.lit(1)).alias("pending_in_partition"))


def pending_context(ids: DataFrame, queue: DataFrame, nodes: DataFrame, as_of: str | None = None) -> DataFrame:
    """Reason, priority and partition of each requested job, with its partition's pending total and node states.

    One row per queue row of the requested job or array task. ``status``:
    ``ok`` (in the queue), ``not_in_queue`` (started, finished or purged:
    not pending), ``invalid_key``.
    """
    req, queue = requested_ids(ids), current(queue, as_of)
    q = queue.select(F.col("job_id").alias("queue_job_id"), "state", "reason", "priority", "partition")
    hits = match_ids(req, q, "queue_job_id")
    pn = partition_node_states(nodes, as_of=as_of).select("partition", "allocated", "idle", "other", "total")
    # few partitions hold all rows: joined by shuffle on them, a handful of tasks would hold the whole queue
    out = hits.join(F.broadcast(pending_count(queue).join(pn, "partition", "full")), "partition", "left")
    out = out.withColumn("pending_in_partition", F.coalesce("pending_in_partition", F.lit(0))).withColumn("status", F.lit("ok"))
    # one aggregate of both sides, where an anti join would hold an aggregate and two sorted inputs in a task
    both = req.withColumn("_hit", F.lit(False)).unionByName(hits.select("job_id", F.lit(None).cast("boolean").alias("_valid"), F.lit(True).alias("_hit")))
    miss = both.groupBy("job_id").agg(F.max("_valid").alias("_valid"), F.max("_hit").alias("_hit")).where(~F.col("_hit")).select(
        "job_id", F.when(F.col("_valid"), "not_in_queue").otherwise("invalid_key").alias("status"))
    return out.unionByName(miss, allowMissingColumns=True)


def pending_priority(priorities: DataFrame, job_id: str | None = None, partition: str | None = None, top: int = 60,
                     as_of: str | None = None) -> DataFrame:
    """Priority factors of pending jobs, highest first, with the exact total; ``status``: ``ok`` or one ``none_pending`` row."""
    p = snapshot_at(priorities, as_of)
    if job_id:
        p = p.where(P.base_job_id("job_id") == P.base_job_id(F.lit(job_id)))
    if partition:
        p = p.where(F.col("partition") == partition)
    return G.with_status(top_per_group(p, [], [F.desc("priority"), F.asc("job_id")], top), p, "none_pending")


def _reason_class(token: Column) -> Column:
    return F.when(token.isin(*FATAL_REASONS), "FATAL").when(token.isin(*SUSPECT_REASONS), "SUSPECT").otherwise("NORMAL")


def stuck_jobs(queue: DataFrame, as_of: str, by: Sequence[str] = (), top_users: int = 10,
               top_normal: int = 6, samples: int = 4) -> DataFrame:
    """PENDING work split FATAL / SUSPECT / NORMAL by the first reason token, counted in array tasks.

    Rows: for FATAL and SUSPECT, one per (reason, user) among the
    ``top_users`` users with most tasks (user tasks, oldest age in hours,
    up to ``samples`` job ids), with the reason's tasks and users; for
    NORMAL, one per reason among the ``top_normal`` largest. Every row
    carries the group's task totals. The reason class is a literal
    expression (no join); all aggregates are partial-then-final.
    """
    G.positive(top_users, "top_users")
    pend = snapshot_at(queue, as_of).where(F.col("state") == "PENDING").select(
        *by, "job_id", F.coalesce(F.col("user_name"), F.lit("")).alias("user_name"),
        P.array_task_count("job_id").alias("tasks"),
        P.reason_token("reason").alias("reason"),
        P.age_hours("submit_ts", F.to_timestamp_ntz(F.lit(as_of))).alias("age_h"),
    ).withColumn("bucket", _reason_class(F.col("reason")))

    # One row per (reason, user); all levels above come from it in one pass of grouping sets.
    rk = [*by, "bucket", "reason"]
    per_user = pend.groupBy(*rk, "user_name").agg(F.sum("tasks").alias("user_tasks"), F.greatest(F.lit(0.0), F.max("age_h")).alias("oldest_h"))
    of = lambda bucket: F.sum(F.when(F.col("_class") == bucket, F.col("user_tasks")).otherwise(0))
    levels = per_user.withColumn("_class", F.col("bucket")).groupingSets([rk, list(by)], *rk).agg(
        F.grouping_id().alias("_level"), F.sum("user_tasks").alias("n_tasks"), F.count(F.lit(1)).alias("n_users"),
        of("FATAL").alias("n_fatal"), of("SUSPECT").alias("n_suspect"))
    totals = levels.where("_level != 0").select(*by, "n_tasks", "n_fatal", "n_suspect")
    per_reason = levels.where("_level = 0").select(*rk, F.col("n_tasks").alias("reason_tasks"), F.col("n_users").alias("reason_users"))

    flagged = F.col("bucket") != "NORMAL"
    top_u = top_per_group(per_user.where(flagged), rk, [F.desc("user_tasks"), F.asc("user_name")], top_users, "user_rank")
    smp = (top_per_group(pend.where(flagged).select(*rk, "user_name", "job_id"), [*rk, "user_name"], [F.asc("job_id")], samples, "_r")
           .groupBy(*rk, "user_name").agg(F.array_sort(F.collect_list("job_id")).alias("samples")))
    # reasons per class are few (scheduler constants and their spellings), so all are ranked
    ranked = per_reason.withColumn("reason_rank", F.row_number().over(
        Window.partitionBy(*by, "bucket").orderBy(F.desc("reason_tasks"), F.asc("reason"))).cast("bigint"))
    shown = [*rk, "user_name", "user_tasks", "oldest_h", "user_rank", "reason_tasks", "reason_users", "samples", "reason_rank"]
    flagged_rows = top_u.join(ranked, rk, "left").join(smp, [*rk, "user_name"], "left").select(shown)
    normal_rows = ranked.where(~flagged & (F.col("reason_rank") <= top_normal)).drop("reason_users")
    rows = flagged_rows.unionByName(normal_rows, allowMissingColumns=True)
    if by:
        return rows.join(totals, list(by), "left")
    return G.attach_row(rows, totals)


# ------------------------------------------------------------------- memory

def partition_mem_ratio(nodes: DataFrame, overrides: Mapping[str, float] | None = None,
                        as_of: str | None = None) -> DataFrame:
    """GB of RAM per CPU of each partition: the highest over its node types; overrides win.

    Non-digits are stripped from the CPU and memory texts (``64+`` → 64);
    rows with zero CPUs or memory are skipped.
    """
    cpus = F.regexp_replace(F.col("cpus").cast("string"), r"[^0-9]", "").try_cast("bigint")
    mem = F.regexp_replace(F.col("mem_mb").cast("string"), r"[^0-9]", "").try_cast("double")
    measured = (snapshot_at(nodes, as_of).select("partition", cpus.alias("c"), mem.alias("m"))
                .where((F.col("c") > 0) & (F.col("m") > 0))
                .groupBy("partition").agg(F.max(F.col("m") / 1024 / F.col("c")).alias("measured_ratio")))
    if overrides:
        ov = F.create_map(*[x for k, v in overrides.items() for x in (F.lit(k), F.lit(float(v)))])
        return measured.withColumn("ratio", F.coalesce(ov[F.col("partition")], F.col("measured_ratio")))
    return measured.withColumn("ratio", F.col("measured_ratio"))


def memory_overreservation(queue: DataFrame, nodes: DataFrame, overrides: Mapping[str, float] | None = None,
                           factor: float = 2.0, top: int = 15, samples: int = 3, as_of: str | None = None) -> DataFrame:
    """RUNNING jobs reserving more than ``factor`` × the partition's GB/CPU, for every partition at once.

    Groups by (partition, user, GB/CPU rounded half-even): jobs, excess GB
    (mem − ratio·cpus), up to ``samples`` job ids; top ``top`` groups per
    partition by excess, with the partition totals (analysed, flagged,
    excess, sterilised CPUs = excess / ratio). Excesses are summed as whole
    KB, so ranks do not depend on the order of rows. Every partition with
    analysed jobs keeps a row; ``status``: ``ok``, ``empty`` (none flagged),
    ``no_node_data`` (no node of the partition tells its ratio). The ratio
    table has one row per partition and is broadcast: by shuffle, the few
    partitions would put all running jobs into as many tasks.
    """
    if factor < 1:
        raise ValueError(f"factor must be at least 1, not {factor}")
    G.positive(top, "top")
    ratio = partition_mem_ratio(nodes, overrides, as_of).select("partition", "ratio")
    run = snapshot_at(queue, as_of).where(F.col("state") == "RUNNING").select(
        "partition", "job_id", "user_name",
        P.tres_cpu("tres", anchored=False).alias("cpus"), P.tres_mem_gb("tres").alias("mem_gb"),
    ).where(F.col("cpus").isNotNull() & F.col("mem_gb").isNotNull())
    j = run.join(F.broadcast(ratio), "partition", "left")  # one row a partition
    j = j.withColumn("mem_cpu", F.when(F.col("cpus") > 0, F.col("mem_gb") / F.col("cpus")))
    over = F.coalesce(F.col("mem_cpu") > F.col("ratio") * factor, F.lit(False))
    excess_kb = F.round((F.col("mem_gb") - F.col("ratio") * F.col("cpus")) * KB_PER_GB).cast("bigint")
    j = j.withColumn("excess_kb", F.when(over, excess_kb))
    flag = j.where(F.col("excess_kb").isNotNull()).withColumn("gb_per_cpu", F.bround("mem_cpu", 0))
    totals = j.groupBy("partition").agg(
        F.count(F.lit(1)).alias("n_analyzed"),
        F.count("excess_kb").alias("n_flagged"),
        (F.sum("excess_kb") / KB_PER_GB).alias("excess_total_gb"),
        F.max("ratio").alias("ratio"),
    ).withColumn("sterilized_cpus", F.col("excess_total_gb") / F.col("ratio")).withColumn("threshold", F.col("ratio") * factor)
    gk = ["partition", "user_name", "gb_per_cpu"]
    groups = flag.groupBy(*gk).agg(F.count(F.lit(1)).alias("jobs"), F.sum("excess_kb").alias("excess_kb"))
    groups = top_per_group(groups, ["partition"], [F.desc("excess_kb"), F.asc("user_name"), F.asc("gb_per_cpu")], top)
    groups = groups.withColumn("excess_gb", F.col("excess_kb") / KB_PER_GB).drop("excess_kb")
    smp = (top_per_group(flag.select(*gk, "job_id"), gk, [F.asc("job_id")], samples, "_r")
           .groupBy(*gk).agg(F.array_sort(F.collect_list("job_id")).alias("samples")))
    status = F.when(F.col("ratio").isNull(), "no_node_data").when(F.col("jobs").isNull(), "empty").otherwise("ok")
    return (totals.join(groups.join(smp, gk, "left"), "partition", "left")
            .withColumn("ratio_multiple", F.col("gb_per_cpu") / F.col("ratio")).withColumn("status", status))


def running_counts(queue: DataFrame, by: str = "account", top_users: int = 8, as_of: str | None = None) -> DataFrame:
    """Queue rows of each group counted by state and by user (top ``top_users``), as (dim, value, n, rank)."""
    q = snapshot_at(queue, as_of).select(by, "state", "user_name")
    counts = q.groupingSets([[by, "state"], [by, "user_name"]], by, "state", "user_name").agg(
        F.grouping("state").alias("_of_users"), F.count(F.lit(1)).alias("n"))
    counts = counts.select(by, F.when(F.col("_of_users") == 1, "user").otherwise("state").alias("dim"),
                           F.when(F.col("_of_users") == 1, F.col("user_name")).otherwise(F.col("state")).alias("value"), "n")
    order = [F.desc("n"), F.asc("value")]
    # users of a group are cut before they are sorted; its states are few
    by_user = top_per_group(counts.where("dim = 'user'"), [by, "dim"], order, top_users)
    by_state = counts.where("dim = 'state'").withColumn("rank", F.row_number().over(Window.partitionBy(by, "dim").orderBy(*order)).cast("bigint"))
    return by_state.unionByName(by_user)


def jobs_by_node(queue: DataFrame, wanted: DataFrame, states: Sequence[str] = ("RUNNING", "COMPLETING"),
                 as_of: str | None = None) -> DataFrame:
    """Jobs on each wanted node (host lists expanded); a node without jobs keeps one row, status ``none_running``.

    Written as inner join ∪ anti join rather than a left join: the wanted
    nodes are the small side and can be broadcast (a left outer join could
    only build the big side), and a node running a third of all jobs is
    then never a skewed shuffle partition.
    """
    on = (snapshot_at(queue, as_of).where(F.col("state").isin(*states))
          .select("job_id", "user_name", "account", "job_name", "state", "n_cpus", F.explode(P.host_list("node_list")).alias("node")))
    w = wanted.select("node").distinct().withColumn("_valid", Q.valid_name("node"))
    valid = w.where("_valid").select("node")
    hits = on.join(valid, "node", "inner").withColumn("status", F.lit("ok"))
    idle = valid.join(on.select("node"), "node", "left_anti").withColumn("status", F.lit("none_running"))
    bad = w.where(~F.col("_valid")).select("node").withColumn("status", F.lit("invalid_key"))
    return hits.unionByName(idle, allowMissingColumns=True).unionByName(bad, allowMissingColumns=True)


def fairshare_lookup(shares: DataFrame, user: str | None = None, account: str | None = None, top: int | None = None,
                     as_of: str | None = None) -> DataFrame:
    """Share rows by mode: user only, account only, exactly the pair, or all.

    LevelFS falls back to FairShare; ``below_share`` = LevelFS < 1. When a
    user or an account is given and no row matches, one row with
    ``status = no_association`` is returned.
    """
    s = snapshot_at(shares, as_of)
    if user and account:
        s = s.where((F.col("user_name") == user) & (F.col("account") == account))
    elif user:
        s = s.where(F.col("user_name") == user)
    elif account:
        s = s.where(F.col("account") == account)
    s = s.select("account", "user_name", "norm_shares", "norm_usage",
                 F.coalesce("level_fs", "fair_share").alias("level_fs")).withColumn("below_share", F.col("level_fs") < 1)
    if top:
        s = top_per_group(s, [], [F.asc("account"), F.asc("user_name")], top)
    s = s.withColumn("status", F.lit("ok"))
    if user or account:
        probe = s.sparkSession.range(1).select(
            F.lit(account or None).cast("string").alias("account"), F.lit(user or None).cast("string").alias("user_name"), F.lit(None).cast("double").alias("norm_shares"),
            F.lit(None).cast("double").alias("norm_usage"), F.lit(None).cast("double").alias("level_fs"),
            F.lit(None).cast("boolean").alias("below_share"), F.lit("no_association").alias("status"))
        found = s.agg(F.count(F.lit(1)).alias("_n"))
        return s.unionByName(G.attach_row(probe, found).where(F.col("_n") == 0).drop("_n"), allowMissingColumns=True)
    return s
