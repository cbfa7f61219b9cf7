"""Registered text-parsing queries: the scalar functions applied to whole derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions import scripts as S
from ..operators import jobs as J
from ..operators.queue import snapshot_at
from ..sources.fixtures import JOBS_AS_OF, Tables
from ..sources.readers import parse_kv_records
from .oracle_fixtures import with_fixtures as W
from .registry import query

_RSS = r"""CASE WHEN trim({x}) = '' OR trim({x}) IN ('0', 'INVALID', 'Unknown') THEN NULL
  ELSE TRY_CAST(regexp_extract(trim({x}), '^([0-9.]+)', 1) AS DOUBLE)
     * CASE upper(regexp_extract(trim({x}), '([KMGTkmgt])[nc]?$', 1)) WHEN 'K' THEN 1024.0 WHEN 'M' THEN 1048576.0
         WHEN 'G' THEN 1073741824.0 WHEN 'T' THEN 1099511627776.0 ELSE 1.0 END END"""


@query("max_rss", W(f"""
SELECT split_part(step_id, '.', 1) AS job_id,
       coalesce(max(CASE WHEN contains(step_id, '.') THEN {_RSS.format(x='max_rss')} END),
                CASE WHEN count(*) FILTER (WHERE contains(step_id, '.')) = 0 THEN max(CASE WHEN NOT contains(step_id, '.') THEN {_RSS.format(x='max_rss')} END) END) AS max_rss_bytes,
       count(*) FILTER (WHERE contains(step_id, '.')) AS n_steps
FROM job_steps GROUP BY 1""", "job_steps"))
def q_max_rss(spark, sf_dir):
    """Peak RSS of every job: steps first, else the main row."""
    return J.max_rss(Tables(spark, sf_dir).job_steps)


@query("duration_seconds", W("""
SELECT step_id, total_cpu,
  CASE WHEN total_cpu IS NULL OR total_cpu IN ('', 'INVALID', 'Unknown') THEN NULL
       ELSE CAST(split_part(total_cpu, ':', 1) AS DOUBLE) * 3600 + CAST(split_part(total_cpu, ':', 2) AS DOUBLE) * 60
            + CAST(split_part(total_cpu, ':', 3) AS DOUBLE) END AS cpu_s
FROM job_steps""", "job_steps"))
def q_duration_seconds(spark, sf_dir):
    """CPU time text of every accounting row in seconds."""
    return Tables(spark, sf_dir).job_steps.select("step_id", "total_cpu", P.duration_seconds("total_cpu").alias("cpu_s"))


@query("mem_bytes", W(f"""
SELECT step_id, {_RSS.format(x='req_mem')} AS req_bytes,
       CASE WHEN ({_RSS.format(x='req_mem')}) IS NULL THEN NULL WHEN req_mem LIKE '%c' THEN 'c' WHEN req_mem LIKE '%n' THEN 'n' ELSE '' END AS req_mode,
       {_RSS.format(x='max_rss')} AS rss_bytes
FROM job_steps""", "job_steps"))
def q_mem_bytes(spark, sf_dir):
    """Requested memory (bytes, per-node/per-CPU mode) and peak RSS of every accounting row."""
    s = Tables(spark, sf_dir).job_steps
    return s.select("step_id", P.mem_bytes("req_mem").alias("r"), P.mem_bytes("max_rss")["bytes"].alias("rss_bytes")).select(
        "step_id", F.col("r.bytes").alias("req_bytes"), F.col("r.mode").alias("req_mode"), "rss_bytes")


@query("tres_fields", W(r"""
SELECT job_id, CAST(nullif(regexp_extract(alloc_tres, '(?:^|,)cpu=([0-9]+)', 1), '') AS BIGINT) AS cpus,
       CASE WHEN contains(alloc_tres, 'gres/gpu=') AND regexp_matches(trim(regexp_extract(alloc_tres, 'gres/gpu=([^,]*)', 1)), '^[+-]?[0-9]+$')
            THEN CAST(trim(regexp_extract(alloc_tres, 'gres/gpu=([^,]*)', 1)) AS BIGINT) END AS gpus,
       round(TRY_CAST(nullif(regexp_extract(alloc_tres, 'mem=([0-9.]+)([KMGT]?)', 1), '') AS DOUBLE)
         * CASE regexp_extract(alloc_tres, 'mem=([0-9.]+)([KMGT]?)', 2) WHEN 'K' THEN 1.0 / 1048576 WHEN 'M' THEN 1.0 / 1024
             WHEN 'G' THEN 1.0 WHEN 'T' THEN 1024.0 ELSE 1.0 / 1024 END, 9) AS mem_gb
FROM jobs""", "jobs"))
def q_tres_fields(spark, sf_dir):
    """CPUs, GPUs and memory (GB; no unit = MB) of every job's allocation text."""
    j = Tables(spark, sf_dir).jobs
    return j.select("job_id", P.tres_cpu("alloc_tres").alias("cpus"), P.tres_gpu("alloc_tres").alias("gpus"),
                    F.round(P.tres_mem_gb("alloc_tres"), 9).alias("mem_gb"))


@query("array_task_count", W(r"""
SELECT job_id, split_part(split_part(job_id, '_', 1), '.', 1) AS base_id,
  CASE WHEN regexp_matches(job_id, '_\[([^\]]+)\]') THEN CAST(greatest(1, list_sum(list_transform(
    string_split(split_part(regexp_extract(job_id, '_\[([^\]]+)\]', 1), '%', 1), ','),
    lambda p: CASE WHEN contains(trim(p), '-') THEN coalesce(CASE WHEN len(string_split(trim(p), '-')) = 2 THEN
        TRY_CAST(split_part(trim(p), '-', 2) AS BIGINT) - TRY_CAST(split_part(trim(p), '-', 1) AS BIGINT) + 1 END, 1)
      WHEN regexp_matches(trim(p), '^[0-9]+$') THEN 1 ELSE 0 END))) AS BIGINT) ELSE 1 END AS tasks
FROM queue""", "queue"))
def q_array_task_count(spark, sf_dir):
    """Task count and base id of every queue job id (array ranges, lists and limits)."""
    q = snapshot_at(Tables(spark, sf_dir).queue, JOBS_AS_OF)
    return q.select("job_id", P.base_job_id("job_id").alias("base_id"), P.array_task_count("job_id").alias("tasks"))


@query("host_list", W(r"""
SELECT job_id, unnest(list_transform(range(CAST(regexp_extract(node_list, '\[([0-9]+)-', 1) AS INTEGER),
                                         CAST(regexp_extract(node_list, '-([0-9]+)\]', 1) AS INTEGER) + 1),
       lambda i: concat('node', lpad(CAST(i AS VARCHAR), CAST(length(regexp_extract(node_list, '\[([0-9]+)-', 1)) AS INTEGER), '0')))) AS host
FROM queue""", "queue"))
def q_host_list(spark, sf_dir):
    """Every host of every queue job's node list."""
    q = snapshot_at(Tables(spark, sf_dir).queue, JOBS_AS_OF)
    return q.select("job_id", F.explode(P.host_list("node_list")).alias("host"))


_RES = """replace(replace(replace(replace(replace(replace(replace(replace({raw}, '%%', chr(0)),
    '%j', split_part(split_part(job_id, '_', 1), '.', 1)), '%J', split_part(split_part(job_id, '_', 1), '.', 1)),
    '%A', split_part(split_part(job_id, '_', 1), '.', 1)), '%x', coalesce(nullif(job_name, ''), 'job')),
    '%u', coalesce(user_name, '')), '%a', CASE WHEN contains(job_id, '_') THEN string_split(job_id, '_')[-1] ELSE '0' END), chr(0), '%')"""


def _abs(raw: str) -> str:
    r = _RES.format(raw=raw)
    return f"CASE WHEN starts_with({r}, '/') THEN {r} ELSE concat(rtrim(coalesce(work_dir, '')), '/', {r}) END"


@query("log_path", W(f"SELECT job_id, {_abs('stdout')} AS stdout_path, {_abs('stderr')} AS stderr_path FROM jobs", "jobs"))
def q_log_path(spark, sf_dir):
    """Resolved, absolute StdOut and StdErr paths of every job (patterns and work directory applied)."""
    j = Tables(spark, sf_dir).jobs

    def res(c):
        return S.absolute_log_path(S.log_path(F.col(c), F.col("job_id"), F.col("job_name"), F.col("user_name")), F.col("work_dir"))

    return j.select("job_id", res("stdout").alias("stdout_path"), res("stderr").alias("stderr_path"))


_KV_TEXT_SQL = """concat_ws(' ', concat('JobId=', job_id), concat('UserId=', user_name, '(1000)'), 'JobState=UNKNOWN',
   concat('JobState=', state), concat('Partition=', partition), concat('Reason=', reason), 'Dependency=(null)')"""


@query("parse_kv_records", W(rf"""
WITH t AS (SELECT {_KV_TEXT_SQL} AS rec FROM queue)
SELECT regexp_extract(rec, '^.*(?:^|\s)JobId=(\S*)', 1) AS job_id,
       split_part(regexp_extract(rec, '^.*(?:^|\s)UserId=(\S*)', 1), '(', 1) AS user_name,
       regexp_extract(rec, '^.*(?:^|\s)JobState=(\S*)', 1) AS state,
       regexp_extract(rec, '^.*(?:^|\s)Partition=(\S*)', 1) AS partition,
       regexp_extract(rec, '^.*(?:^|\s)Reason=(\S*)', 1) AS reason,
       len(list_filter(string_split_regex(rec, '\s+'), lambda x: contains(x, '='))) AS n_tokens
FROM t""", "queue"))
def q_parse_kv_records(spark, sf_dir):
    """Live job records rendered as key=value text (a duplicate key included) parsed back, last duplicate winning."""
    q = snapshot_at(Tables(spark, sf_dir).queue, JOBS_AS_OF)
    text = F.concat_ws(" ", F.concat(F.lit("JobId="), "job_id"), F.concat(F.lit("UserId="), "user_name", F.lit("(1000)")),
                       F.lit("JobState=UNKNOWN"), F.concat(F.lit("JobState="), "state"), F.concat(F.lit("Partition="), "partition"),
                       F.concat(F.lit("Reason="), "reason"), F.lit("Dependency=(null)"))
    m = q.select(parse_kv_records(text).alias("m"), F.size(F.filter(F.split(text, r"\s+"), lambda x: x.contains("="))).alias("n_tokens"))
    return m.select(F.col("m")["JobId"].alias("job_id"), F.split(F.col("m")["UserId"], r"\(").getItem(0).alias("user_name"),
                    F.col("m")["JobState"].alias("state"), F.col("m")["Partition"].alias("partition"),
                    F.col("m")["Reason"].alias("reason"), F.col("n_tokens").cast("bigint").alias("n_tokens"))
