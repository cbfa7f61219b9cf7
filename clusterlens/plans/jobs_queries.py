"""Registered job-accounting queries at the fixture ``as_of``.

Arrays are rendered to text (``array_join``) so the Spark rows and the
DuckDB rows hash alike; doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import jobs as J
from ..sources.fixtures import INTERACTIVE_PARTITIONS, JOBS_AS_OF, Tables
from .oracle_fixtures import with_fixtures as W
from .registry import query

_FS = r"coalesce(nullif(regexp_extract(state, '^\s*(\S+)', 1), ''), '?')"
_BAD = r"nullif(regexp_extract({x}, '^(FAILED|TIMEOUT|OUT_OF_MEMORY|NODE_FAIL)', 1), '')"
_NORM = "substr(regexp_replace(coalesce(nullif(job_name, ''), '?'), '[0-9]+', '#', 'g'), 1, 48)"
_WINDOW = "(end_ts IS NULL OR end_ts >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY)"


def _win(days: int) -> str:
    return _WINDOW.format(as_of=JOBS_AS_OF, days=days)


# ---------------------------------------------------------------------------------------------
_CLUSTERS_SQL = W(f"""
WITH b AS (
  SELECT account, {_NORM} AS pattern, {_BAD.format(x=_FS)} AS state,
         coalesce(nullif(user_name, ''), '?') AS user_name, coalesce(nullif(exit_code, ''), '?') AS exit_code, job_id, end_ts
  FROM jobs),
b2 AS (SELECT * FROM b WHERE state IS NOT NULL),
cl AS (
  SELECT account, pattern, state, count(*) AS n,
         arg_max(job_id, CASE WHEN end_ts IS NOT NULL THEN struct_pack(e := end_ts, j := job_id) END) AS sample_job,
         max(end_ts) AS sample_end
  FROM b2 GROUP BY account, pattern, state HAVING count(*) >= 5),
rk AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY n DESC, pattern, state) AS rank FROM cl QUALIFY rank <= 3),
us AS (SELECT account, pattern, state, user_name, row_number() OVER (PARTITION BY account, pattern, state ORDER BY user_name) AS r,
              count(*) OVER (PARTITION BY account, pattern, state) AS n_users
       FROM (SELECT DISTINCT account, pattern, state, user_name FROM b2)),
ua AS (SELECT account, pattern, state, max(n_users) AS n_users, string_agg(user_name, ',' ORDER BY user_name) AS users
       FROM us WHERE r <= 5 GROUP BY ALL),
ex AS (SELECT account, pattern, state, exit_code, count(*) AS c FROM b2 GROUP BY ALL),
exr AS (SELECT *, row_number() OVER (PARTITION BY account, pattern, state ORDER BY c DESC, exit_code) AS r FROM ex),
ea AS (SELECT account, pattern, state, string_agg(concat(exit_code, 'x', c), ';' ORDER BY r) AS exits FROM exr WHERE r <= 3 GROUP BY ALL)
SELECT rk.account, rk.pattern, rk.state, rk.n, ua.n_users, ua.users, ea.exits, rk.sample_job, rk.sample_end, rk.rank
FROM rk LEFT JOIN ua USING (account, pattern, state) LEFT JOIN ea USING (account, pattern, state)
""", "jobs")


def render_clusters(df):
    return df.select(
        *[c for c in df.columns if c not in ("users", "exits")],
        F.array_join("users", ",").alias("users"),
        F.array_join(F.transform("exits", lambda e: F.concat(e["exit_code"], F.lit("x"), e["n"].cast("string"))), ";").alias("exits"),
    )


@query("failure_clusters", _CLUSTERS_SQL)
def q_failure_clusters(spark, sf_dir):
    """Top 3 clusters of similar failing jobs in every account (size ≥ 5)."""
    t = Tables(spark, sf_dir)
    return render_clusters(J.failure_clusters(t.jobs, by=["account"], min_size=5, top=3).drop("n_exits"))


# ---------------------------------------------------------------------------------------------
@query("state_histogram", W(f"SELECT user_name, {_FS} AS state, count(*) AS n FROM jobs GROUP BY ALL", "jobs"))
def q_state_histogram(spark, sf_dir):
    """Jobs per first state token, per user."""
    return J.state_histogram(Tables(spark, sf_dir).jobs, ["user_name"])


@query("cpu_hours", W(r"""
SELECT account, count(*) AS n_jobs,
       round(sum(coalesce(CAST(nullif(regexp_extract(alloc_tres, '(?:^|,)cpu=([0-9]+)', 1), '') AS BIGINT), 0) * coalesce(elapsed_s, 0)) / 3600.0, 6) AS cpu_hours
FROM jobs GROUP BY account""", "jobs"))
def q_cpu_hours(spark, sf_dir):
    """CPU-hours and job count per account."""
    df = J.cpu_hours(Tables(spark, sf_dir).jobs, ["account"])
    return df.withColumn("cpu_hours", F.round("cpu_hours", 6))


@query("gpu_hours_by_user", W(rf"""
SELECT coalesce(nullif(user_name, ''), '?') AS user_name,
       round(sum(CAST(trim(regexp_extract(alloc_tres, 'gres/gpu=([^,]*)', 1)) AS BIGINT) * coalesce(elapsed_s, 0)) / 3600.0, 6) AS gpu_hours
FROM jobs
WHERE {_win(3650)} AND alloc_tres LIKE '%gres/gpu=%'
  AND regexp_matches(trim(regexp_extract(alloc_tres, 'gres/gpu=([^,]*)', 1)), '^[+-]?[0-9]+$')
GROUP BY 1""", "jobs"))
def q_gpu_hours_by_user(spark, sf_dir):
    """GPU-hours per user over the last 10 years of accounting."""
    df = J.gpu_hours_by_user(Tables(spark, sf_dir).jobs, JOBS_AS_OF, days=3650)
    return df.withColumn("gpu_hours", F.round("gpu_hours", 6))


@query("job_history", W(f"""
WITH w AS (SELECT * FROM jobs WHERE {_win(365)}),
t AS (SELECT user_name, count(*) AS total FROM w GROUP BY user_name),
r AS (SELECT job_id, user_name, account, state, elapsed_s, end_ts,
             row_number() OVER (PARTITION BY user_name ORDER BY end_ts DESC NULLS FIRST, job_id DESC) AS rank FROM w)
SELECT r.*, t.total FROM r JOIN t USING (user_name) WHERE rank <= 5""", "jobs"))
def q_job_history(spark, sf_dir):
    """The 5 most recent jobs of the last year of every user, with each user's exact total."""
    df = J.job_history(Tables(spark, sf_dir).jobs, JOBS_AS_OF, days=365, top=5, by=["user_name"])
    return df.select("job_id", "user_name", "account", "state", "elapsed_s", "end_ts", "rank", "total")


@query("partition_histogram", W("""
WITH c AS (SELECT user_name, coalesce(partition, '?') AS partition, count(*) AS n FROM jobs GROUP BY ALL),
t AS (SELECT user_name, count(*) AS n_partitions FROM c GROUP BY ALL)
SELECT c.user_name, c.partition, c.n, c.rank, t.n_partitions
FROM (SELECT *, row_number() OVER (PARTITION BY user_name ORDER BY n DESC, partition) AS rank FROM c) c
JOIN t USING (user_name) WHERE rank <= 6""", "jobs"))
def q_partition_histogram(spark, sf_dir):
    """Top 6 partitions by job count of every user, with the distinct partition total."""
    return J.partition_histogram(Tables(spark, sf_dir).jobs, ["user_name"], top=6).select(
        "user_name", "partition", "n", "rank", "n_partitions")


@query("top_members", W(r"""
WITH u AS (
  SELECT account, coalesce(nullif(user_name, ''), '?') AS user_name, count(*) AS n_jobs,
         sum(coalesce(CAST(nullif(regexp_extract(alloc_tres, '(?:^|,)cpu=([0-9]+)', 1), '') AS BIGINT), 0) * coalesce(elapsed_s, 0)) AS cpu_s
  FROM jobs GROUP BY ALL)
SELECT account, user_name, n_jobs, round(cpu_s / 3600.0, 6) AS cpu_hours,
       row_number() OVER (PARTITION BY account ORDER BY cpu_s DESC, user_name) AS rank
FROM u QUALIFY rank <= 8""", "jobs"))
def q_top_members(spark, sf_dir):
    """Top 8 users by CPU-hours of every account."""
    df = J.top_members(Tables(spark, sf_dir).jobs, ["account"], top=8)
    return df.withColumn("cpu_hours", F.round("cpu_hours", 6))


@query("exit_histogram", W(f"""
WITH b AS (SELECT {_NORM} AS pattern, {_BAD.format(x=_FS)} AS state, coalesce(nullif(exit_code, ''), '?') AS exit_code FROM jobs),
c AS (SELECT pattern, state, exit_code, count(*) AS n FROM b WHERE state IS NOT NULL GROUP BY ALL),
s AS (SELECT pattern, state, sum(n) AS cluster_n FROM c GROUP BY ALL HAVING sum(n) >= 5)
SELECT c.pattern, c.state, c.exit_code, c.n, CAST(s.cluster_n AS BIGINT) AS cluster_n,
       row_number() OVER (PARTITION BY c.pattern, c.state ORDER BY c.n DESC, c.exit_code) AS rank
FROM c JOIN s USING (pattern, state) QUALIFY rank <= 3""", "jobs"))
def q_exit_histogram(spark, sf_dir):
    """Top 3 exit codes of every failure cluster of size ≥ 5."""
    return J.exit_histogram(Tables(spark, sf_dir).jobs, top=3, min_size=5)


@query("short_job_stats", W(f"""
WITH s AS (SELECT coalesce(nullif(user_name, ''), '?') AS user_name, elapsed_s FROM jobs
           WHERE {_win(3650)} AND elapsed_s > 0 AND elapsed_s < 300),
r AS (SELECT user_name, elapsed_s, row_number() OVER (PARTITION BY user_name ORDER BY elapsed_s) AS rn,
             count(*) OVER (PARTITION BY user_name) AS n FROM s)
SELECT user_name, max(n) AS total_short, max(CASE WHEN rn = n // 2 + 1 THEN elapsed_s END) AS median_elapsed
FROM r GROUP BY user_name""", "jobs"))
def q_short_job_stats(spark, sf_dir):
    """Short jobs (< 300 s) of every user over 10 years, with the upper median duration."""
    return J.short_job_stats(Tables(spark, sf_dir).jobs, JOBS_AS_OF, days=3650)


EFF_CTES = r"""s AS (
  SELECT *, split_part(step_id, '.', 1) AS job_id, NOT contains(step_id, '.') AS is_main,
         CASE WHEN trim(max_rss) = '' OR trim(max_rss) IN ('0', 'INVALID', 'Unknown') THEN NULL
              ELSE TRY_CAST(regexp_extract(trim(max_rss), '^([0-9.]+)', 1) AS DOUBLE)
                   * CASE upper(regexp_extract(trim(max_rss), '([KMGTkmgt])[nc]?$', 1)) WHEN 'K' THEN 1024.0 WHEN 'M' THEN 1048576.0
                       WHEN 'G' THEN 1073741824.0 WHEN 'T' THEN 1099511627776.0 ELSE 1.0 END END AS rss
  FROM job_steps),
g AS (
  SELECT job_id, arg_max(state, CASE WHEN is_main THEN 1 END) AS state, arg_max(elapsed_s, CASE WHEN is_main THEN 1 END) AS elapsed_s,
         arg_max(alloc_cpus, CASE WHEN is_main THEN 1 END) AS alloc_cpus, arg_max(n_nodes, CASE WHEN is_main THEN 1 END) AS n_nodes,
         arg_max(total_cpu, CASE WHEN is_main THEN 1 END) AS total_cpu, arg_max(req_mem, CASE WHEN is_main THEN 1 END) AS req_mem,
         arg_max(timelimit_min, CASE WHEN is_main THEN 1 END) AS timelimit_min,
         max(CASE WHEN is_main THEN rss END) AS main_rss, max(CASE WHEN NOT is_main THEN rss END) AS step_rss,
         count(*) FILTER (WHERE NOT is_main) AS n_steps
  FROM s GROUP BY job_id),
e AS (
  SELECT g.*, (j.batch_flag = 0 OR j.partition IN ('furniture')) IS TRUE AS is_service,
    CASE WHEN total_cpu IS NULL OR total_cpu IN ('', 'INVALID', 'Unknown') THEN NULL
         ELSE CAST(split_part(total_cpu, ':', 1) AS DOUBLE) * 3600 + CAST(split_part(total_cpu, ':', 2) AS DOUBLE) * 60
              + CAST(split_part(total_cpu, ':', 3) AS DOUBLE) END AS cpu_used,
    CASE WHEN n_steps > 0 THEN step_rss ELSE main_rss END AS max_rss_bytes,
    TRY_CAST(regexp_extract(req_mem, '^([0-9.]+)', 1) AS DOUBLE)
      * CASE regexp_extract(req_mem, '([KMGT])[nc]?$', 1) WHEN 'K' THEN 1024.0 WHEN 'M' THEN 1048576.0 WHEN 'G' THEN 1073741824.0 WHEN 'T' THEN 1099511627776.0 ELSE 1.0 END
      * CASE WHEN req_mem LIKE '%c' THEN greatest(coalesce(alloc_cpus, 0), 1) WHEN req_mem LIKE '%n' THEN greatest(coalesce(n_nodes, 1), 1) ELSE 1 END AS req_bytes,
    CASE WHEN regexp_matches(timelimit_min, '^[0-9]+$') THEN CAST(timelimit_min AS BIGINT) END AS lim
  FROM g LEFT JOIN jobs j USING (job_id)),
f AS (
  SELECT *, CASE WHEN cpu_used IS NOT NULL AND coalesce(elapsed_s, 0) != 0 AND coalesce(alloc_cpus, 0) != 0 THEN cpu_used / (elapsed_s * alloc_cpus) END AS cpu_eff,
    CASE WHEN max_rss_bytes IS NOT NULL AND req_bytes IS NOT NULL THEN CASE WHEN req_bytes != 0 THEN max_rss_bytes / req_bytes ELSE 0.0 END END AS mem_eff,
    CASE WHEN lim IS NOT NULL AND coalesce(elapsed_s, 0) != 0 AND lim != 0 THEN coalesce(elapsed_s, 0) / (lim * 60.0) END AS time_eff,
    lim IS NOT NULL AND coalesce(elapsed_s, 0) != 0 AS has_time
  FROM e),
v AS (
  SELECT *, concat_ws(',',
      CASE WHEN NOT is_service AND cpu_eff < 0.5 AND coalesce(elapsed_s, 0) > 300 THEN 'cpu_under' END,
      CASE WHEN NOT is_service AND mem_eff < 0.4 AND coalesce(elapsed_s, 0) > 300 THEN 'mem_over' WHEN mem_eff > 0.9 THEN 'mem_near_limit' END,
      CASE WHEN has_time AND contains(coalesce(state, ''), 'TIMEOUT') THEN 'timeout'
           WHEN has_time AND NOT is_service AND time_eff < 0.2 AND coalesce(elapsed_s, 0) > 600 THEN 'time_over' END,
      CASE WHEN contains(coalesce(state, ''), 'OUT_OF_MEMORY') THEN 'oom' END) AS verdicts
  FROM f)"""

_EFF_SQL = W("WITH " + EFF_CTES + r"""
SELECT job_id, state, elapsed_s, alloc_cpus, n_nodes, is_service, round(cpu_eff, 6) AS cpu_eff, max_rss_bytes, req_bytes,
       round(mem_eff, 6) AS mem_eff, round(time_eff, 6) AS time_eff, verdicts, verdicts = '' AND NOT is_service AS ok
FROM v""", "job_steps", "jobs")


@query("job_efficiency", _EFF_SQL)
def q_job_efficiency(spark, sf_dir):
    """CPU / memory / walltime efficiency and verdicts of every job."""
    t = Tables(spark, sf_dir)
    df = J.job_efficiency(t.job_steps, t.jobs, INTERACTIVE_PARTITIONS)
    return df.select(
        "job_id", "state", "elapsed_s", "alloc_cpus", "n_nodes", "is_service",
        F.round("cpu_eff", 6).alias("cpu_eff"), "max_rss_bytes", "req_bytes", F.round("mem_eff", 6).alias("mem_eff"),
        F.round("time_eff", 6).alias("time_eff"), F.array_join("verdicts", ",").alias("verdicts"), "ok")
