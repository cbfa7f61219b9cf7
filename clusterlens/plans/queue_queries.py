"""Registered queue / node / share queries at the fixture ``as_of``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import jobs as J
from ..operators import queue as Qo
from ..sources.fixtures import JOBS_AS_OF, Tables
from .oracle_fixtures import with_fixtures as W
from .registry import query

_VALID_ID = "regexp_matches(replace(replace({x}, '_', ''), '.', ''), '^[A-Za-z0-9]+$')"
_BASE_ID = "split_part(split_part({x}, '_', 1), '.', 1)"
_PART = r"nullif(regexp_extract(split_part({x}, '.', 1), '^[^_]*_(.*)$', 1), '')"
# A request of a base id names every row of the job; one of a task its own rows and the pending array row that holds it.
NAMES = ("({r}_base = {q}_base AND ({r}_part IS NULL OR {q}_part = {r}_part OR (starts_with({q}_part, '[') AND len(list_filter("
         r"string_split(split_part(regexp_extract({q}_part, '^\[([^\]]*)\]', 1), '%', 1), ','), lambda p: TRY_CAST({r}_part AS BIGINT) "
         "BETWEEN TRY_CAST(split_part(p, '-', 1) AS BIGINT) AND TRY_CAST(split_part(p, '-', -1) AS BIGINT))) > 0)))")


# The same rule's last case alone: a pending array row that holds the requested task.
_HOLDS = (r"starts_with({q}_part, '[') AND list_bool_or([TRY_CAST({r}_part AS BIGINT) BETWEEN TRY_CAST(split_part(p, '-', 1) AS BIGINT) AND TRY_CAST(split_part(p, '-', -1) AS BIGINT) "
          r"FOR p IN string_split(split_part(regexp_extract({q}_part, '^\[([^\]]*)\]', 1), '%', 1), ',')])")


def id_parts(x: str, p: str) -> str:
    return f"{_BASE_ID.format(x=x)} AS {p}_base, {_PART.format(x=x)} AS {p}_part"


_TASKS = r"""CASE WHEN regexp_matches(job_id, '_\[([^\]]+)\]') THEN CAST(greatest(1, list_sum(list_transform(
    string_split(split_part(regexp_extract(job_id, '_\[([^\]]+)\]', 1), '%', 1), ','),
    lambda p: CASE WHEN contains(trim(p), '-') THEN coalesce(CASE WHEN len(string_split(trim(p), '-')) = 2 THEN
        TRY_CAST(split_part(trim(p), '-', 2) AS BIGINT) - TRY_CAST(split_part(trim(p), '-', 1) AS BIGINT) + 1 END, 1)
      WHEN regexp_matches(trim(p), '^[0-9]+$') THEN 1 ELSE 0 END))) AS BIGINT) ELSE 1 END"""
_TOKEN = r"coalesce(nullif(regexp_extract(split_part(reason, ',', 1), '^\s*(\S+)', 1), ''), 'None')"
_FATAL = ("'DependencyNeverSatisfied', 'JobHeldAdmin', 'JobHeldUser', 'launch_failed_requeued_held', 'PartitionNodeLimit', "
          "'PartitionTimeLimit', 'PartitionConfig', 'InvalidQOS', 'InvalidAccount', 'AccountNotAllowed', 'QOSUsageThreshold'")
_SUSPECT = "'ReqNodeNotAvail', 'BeginTime', 'Licenses', 'BadConstraints'"

_PNS = """
pns AS (
  SELECT partition,
    count(*) FILTER (WHERE lower(state) IN ('allocated', 'mixed', 'completing')) AS allocated,
    count(*) FILTER (WHERE lower(state) = 'idle') AS idle,
    count(*) FILTER (WHERE lower(state) NOT IN ('allocated', 'mixed', 'completing', 'idle')) AS other,
    count(*) AS total
  FROM nodes GROUP BY partition)"""


@query("queue_filter", W("SELECT * FROM queue WHERE state = 'RUNNING' AND account = 'acct1'", "queue"))
def q_queue_filter(spark, sf_dir):
    """Running jobs of account acct1."""
    return Qo.queue_filter(Tables(spark, sf_dir).queue, account="acct1", state="RUNNING", as_of=JOBS_AS_OF)


@query("pending_count", W("SELECT partition, count(*) AS pending_in_partition FROM queue WHERE state = 'PENDING' GROUP BY ALL", "queue"))
def q_pending_count(spark, sf_dir):
    """PENDING rows per partition."""
    return Qo.pending_count(Tables(spark, sf_dir).queue, as_of=JOBS_AS_OF)


@query("partition_node_states", W(f"""WITH {_PNS},
g AS (SELECT partition, string_agg(gres, ',' ORDER BY gres) AS gres FROM (SELECT DISTINCT partition, gres FROM nodes WHERE gres IS NOT NULL AND gres != '(null)') GROUP BY ALL)
SELECT pns.*, CASE WHEN allocated + idle > 0 THEN 'up' ELSE 'down' END AS available, g.gres FROM pns LEFT JOIN g USING (partition)""", "nodes"))
def q_partition_node_states(spark, sf_dir):
    """Allocated / idle / other / total nodes and GPU resources per partition."""
    df = Qo.partition_node_states(Tables(spark, sf_dir).nodes, as_of=JOBS_AS_OF)
    return df.withColumn("gres", F.array_join("gres", ","))


@query("down_nodes", W("""SELECT state, reason, count(*) AS n_nodes, string_agg(node, ',' ORDER BY node) AS nodes
FROM (SELECT DISTINCT state, reason, node FROM nodes WHERE reason IS NOT NULL AND trim(reason) != '') GROUP BY ALL""", "nodes"))
def q_down_nodes(spark, sf_dir):
    """Down / drained nodes grouped by state and reason."""
    return Qo.down_nodes(Tables(spark, sf_dir).nodes, as_of=JOBS_AS_OF).withColumn("nodes", F.array_join("nodes", ","))


@query("pending_context", W(f"""WITH {_PNS},
pc AS (SELECT partition, count(*) AS pc FROM queue WHERE state = 'PENDING' GROUP BY ALL),
r AS (SELECT DISTINCT job_id AS req_id, {_VALID_ID.format(x='job_id')} AS valid, {id_parts('job_id', 'r')} FROM job_requests),
q AS (SELECT job_id AS qid, {id_parts('job_id', 'q')}, job_id AS queue_job_id, state, reason, priority, partition FROM queue)
SELECT r.req_id AS job_id, q.queue_job_id, q.state, q.reason, q.priority, q.partition,
       CASE WHEN q.qid IS NOT NULL THEN coalesce(pc.pc, 0) END AS pending_in_partition,
       pns.allocated, pns.idle, pns.other, pns.total,
       CASE WHEN NOT r.valid THEN 'invalid_key' WHEN q.qid IS NULL THEN 'not_in_queue' ELSE 'ok' END AS status
FROM r LEFT JOIN q ON {NAMES.format(r='r', q='q')} AND r.valid
LEFT JOIN pc ON pc.partition = q.partition LEFT JOIN pns ON pns.partition = q.partition""", "queue", "nodes", "job_requests"))
def q_pending_context(spark, sf_dir):
    """Why-pending context of every requested job id (known, unknown and invalid ids)."""
    t = Tables(spark, sf_dir)
    return Qo.pending_context(t.job_requests, t.queue, t.nodes, as_of=JOBS_AS_OF).select(
        "job_id", "queue_job_id", "state", "reason", "priority", "partition", "pending_in_partition",
        "allocated", "idle", "other", "total", "status")


@query("pending_priority", W("""WITH p AS (SELECT * FROM priorities WHERE partition = 'building')
SELECT p.*, row_number() OVER (ORDER BY priority DESC, job_id) AS rank, (SELECT count(*) FROM p) AS total, 'ok' AS status
FROM p QUALIFY rank <= 60""", "priorities"))
def q_pending_priority(spark, sf_dir):
    """The 60 highest-priority pending jobs of partition building, with factors and the exact total."""
    return Qo.pending_priority(Tables(spark, sf_dir).priorities, partition="building", top=60, as_of=JOBS_AS_OF)


_STUCK_SQL = W(f"""
WITH p AS (
  SELECT job_id, coalesce(user_name, '') AS user_name, {_TASKS} AS tasks, {_TOKEN} AS reason,
         (epoch_us(TIMESTAMP '{JOBS_AS_OF}') - epoch_us(submit_ts)) / 3.6e9 AS age_h
  FROM queue WHERE state = 'PENDING'),
b AS (SELECT *, CASE WHEN reason IN ({_FATAL}) THEN 'FATAL' WHEN reason IN ({_SUSPECT}) THEN 'SUSPECT' ELSE 'NORMAL' END AS bucket FROM p),
tot AS (SELECT CAST(sum(tasks) AS BIGINT) AS n_tasks, CAST(sum(CASE WHEN bucket = 'FATAL' THEN tasks ELSE 0 END) AS BIGINT) AS n_fatal,
               CAST(sum(CASE WHEN bucket = 'SUSPECT' THEN tasks ELSE 0 END) AS BIGINT) AS n_suspect FROM b),
f AS (SELECT * FROM b WHERE bucket != 'NORMAL'),
pr AS (SELECT bucket, reason, CAST(sum(tasks) AS BIGINT) AS reason_tasks, count(DISTINCT user_name) AS reason_users FROM f GROUP BY ALL),
prr AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY reason_tasks DESC, reason) AS reason_rank FROM pr),
pu AS (SELECT bucket, reason, user_name, CAST(sum(tasks) AS BIGINT) AS user_tasks, greatest(0.0, max(age_h)) AS oldest_h FROM f GROUP BY ALL),
pur AS (SELECT *, row_number() OVER (PARTITION BY bucket, reason ORDER BY user_tasks DESC, user_name) AS user_rank FROM pu QUALIFY user_rank <= 10),
sm AS (SELECT bucket, reason, user_name, string_agg(job_id, ',' ORDER BY job_id) AS samples FROM (
         SELECT *, row_number() OVER (PARTITION BY bucket, reason, user_name ORDER BY job_id) AS r FROM f) WHERE r <= 4 GROUP BY ALL),
nr AS (SELECT bucket, reason, CAST(sum(tasks) AS BIGINT) AS reason_tasks FROM b WHERE bucket = 'NORMAL' GROUP BY ALL),
nrr AS (SELECT *, row_number() OVER (ORDER BY reason_tasks DESC, reason) AS reason_rank FROM nr QUALIFY reason_rank <= 6)
SELECT pur.bucket, pur.reason, pur.user_name, pur.user_tasks, round(pur.oldest_h, 6) AS oldest_h, pur.user_rank,
       prr.reason_tasks, prr.reason_users, sm.samples, prr.reason_rank, tot.n_tasks, tot.n_fatal, tot.n_suspect
FROM pur LEFT JOIN prr USING (bucket, reason) LEFT JOIN sm USING (bucket, reason, user_name) CROSS JOIN tot
UNION ALL
SELECT bucket, reason, NULL, NULL, NULL, NULL, reason_tasks, NULL, NULL, reason_rank, tot.n_tasks, tot.n_fatal, tot.n_suspect
FROM nrr CROSS JOIN tot""", "queue")


@query("stuck_jobs", _STUCK_SQL)
def q_stuck_jobs(spark, sf_dir):
    """Fatal / suspect / normal pending work, in array tasks, with the top 10 users per stuck reason."""
    df = Qo.stuck_jobs(Tables(spark, sf_dir).queue, JOBS_AS_OF, top_users=10)
    return df.withColumn("samples", F.array_join("samples", ",")).withColumn("oldest_h", F.round("oldest_h", 6))


_RATIO = """ratio AS (
  SELECT partition, max(TRY_CAST(regexp_replace(CAST(mem_mb AS VARCHAR), '[^0-9]', '', 'g') AS DOUBLE) / 1024
                        / TRY_CAST(regexp_replace(cpus, '[^0-9]', '', 'g') AS BIGINT)) AS measured_ratio
  FROM nodes WHERE TRY_CAST(regexp_replace(cpus, '[^0-9]', '', 'g') AS BIGINT) > 0
           AND TRY_CAST(regexp_replace(CAST(mem_mb AS VARCHAR), '[^0-9]', '', 'g') AS DOUBLE) > 0
  GROUP BY partition)"""


@query("partition_mem_ratio", W(f"WITH {_RATIO} SELECT partition, round(measured_ratio, 6) AS measured_ratio, round(measured_ratio, 6) AS ratio FROM ratio", "nodes"))
def q_partition_mem_ratio(spark, sf_dir):
    """GB of RAM per CPU of every partition (highest node type)."""
    df = Qo.partition_mem_ratio(Tables(spark, sf_dir).nodes, as_of=JOBS_AS_OF)
    return df.select("partition", F.round("measured_ratio", 6).alias("measured_ratio"), F.round("ratio", 6).alias("ratio"))


_MISUSE_SQL = W(f"""
WITH {_RATIO},
run AS (
  SELECT partition, job_id, user_name, CAST(nullif(regexp_extract(tres, 'cpu=([0-9]+)', 1), '') AS BIGINT) AS cpus,
         TRY_CAST(nullif(regexp_extract(tres, 'mem=([0-9.]+)([KMGT]?)', 1), '') AS DOUBLE)
           * CASE regexp_extract(tres, 'mem=([0-9.]+)([KMGT]?)', 2) WHEN 'K' THEN 1.0 / 1048576 WHEN 'M' THEN 1.0 / 1024 WHEN 'G' THEN 1.0
               WHEN 'T' THEN 1024.0 ELSE 1.0 / 1024 END AS mem_gb
  FROM queue WHERE state = 'RUNNING'),
j AS (SELECT run.*, ratio.measured_ratio AS ratio, CASE WHEN cpus > 0 THEN mem_gb / cpus END AS mem_cpu
      FROM run LEFT JOIN ratio USING (partition) WHERE cpus IS NOT NULL AND mem_gb IS NOT NULL),
fl AS (SELECT *, CAST(round((mem_gb - ratio * cpus) * 1048576) AS BIGINT) AS excess, round_even(mem_cpu, 0) AS gb_per_cpu FROM j WHERE mem_cpu > ratio * 2.0),
tot AS (SELECT partition, count(*) AS n_analyzed, count(*) FILTER (WHERE mem_cpu > ratio * 2.0) AS n_flagged,
               sum(CASE WHEN mem_cpu > ratio * 2.0 THEN CAST(round((mem_gb - ratio * cpus) * 1048576) AS BIGINT) END) / 1048576 AS excess_total_gb, max(ratio) AS ratio FROM j GROUP BY ALL),
g AS (SELECT partition, user_name, gb_per_cpu, count(*) AS jobs, sum(excess) / 1048576 AS excess_gb FROM fl GROUP BY ALL),
gr AS (SELECT *, row_number() OVER (PARTITION BY partition ORDER BY excess_gb DESC, user_name, gb_per_cpu) AS rank FROM g QUALIFY rank <= 15),
sm AS (SELECT partition, user_name, gb_per_cpu, string_agg(job_id, ',' ORDER BY job_id) AS samples FROM (
        SELECT *, row_number() OVER (PARTITION BY partition, user_name, gb_per_cpu ORDER BY job_id) AS r FROM fl) WHERE r <= 3 GROUP BY ALL)
SELECT tot.partition, gr.user_name, gr.gb_per_cpu, gr.jobs, round(gr.excess_gb, 6) AS excess_gb, gr.rank, sm.samples,
       tot.n_analyzed, tot.n_flagged, round(tot.excess_total_gb, 6) AS excess_total_gb, round(tot.ratio, 6) AS ratio,
       round(tot.excess_total_gb / tot.ratio, 6) AS sterilized_cpus, round(tot.ratio * 2.0, 6) AS threshold,
       round(gr.gb_per_cpu / tot.ratio, 6) AS ratio_multiple,
       CASE WHEN tot.ratio IS NULL THEN 'no_node_data' WHEN gr.jobs IS NULL THEN 'empty' ELSE 'ok' END AS status
FROM tot LEFT JOIN gr ON gr.partition IS NOT DISTINCT FROM tot.partition
LEFT JOIN sm ON sm.partition = gr.partition AND sm.user_name = gr.user_name AND sm.gb_per_cpu = gr.gb_per_cpu""", "queue", "nodes")


@query("memory_overreservation", _MISUSE_SQL)
def q_memory_overreservation(spark, sf_dir):
    """Running jobs above 2× their partition's GB/CPU, top 15 (user, GB/CPU) groups per partition."""
    t = Tables(spark, sf_dir)
    df = Qo.memory_overreservation(t.queue, t.nodes, factor=2.0, top=15, as_of=JOBS_AS_OF)
    out = df.withColumn("samples", F.array_join("samples", ","))
    for c in ("excess_gb", "excess_total_gb", "ratio", "sterilized_cpus", "threshold", "ratio_multiple"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("running_counts", W("""
WITH s AS (SELECT account, state, count(*) AS n FROM queue GROUP BY ALL),
u AS (SELECT account, user_name, count(*) AS n FROM queue GROUP BY ALL)
SELECT account, 'state' AS dim, state AS value, n, row_number() OVER (PARTITION BY account ORDER BY n DESC, state) AS rank FROM s
UNION ALL
SELECT * FROM (SELECT account, 'user' AS dim, user_name AS value, n, row_number() OVER (PARTITION BY account ORDER BY n DESC, user_name) AS rank FROM u) WHERE rank <= 8""", "queue"))
def q_running_counts(spark, sf_dir):
    """Queue rows per account by state and by user (top 8)."""
    return Qo.running_counts(Tables(spark, sf_dir).queue, "account", top_users=8, as_of=JOBS_AS_OF)


@query("jobs_by_node", W("""
WITH on_node AS (
  SELECT job_id, user_name, account, job_name, state, n_cpus,
         unnest(list_transform(range(CAST(regexp_extract(node_list, '\\[([0-9]+)-', 1) AS INTEGER), CAST(regexp_extract(node_list, '-([0-9]+)\\]', 1) AS INTEGER) + 1),
                lambda i: concat('node', lpad(CAST(i AS VARCHAR), CAST(length(regexp_extract(node_list, '\\[([0-9]+)-', 1)) AS INTEGER), '0')))) AS node
  FROM queue WHERE state IN ('RUNNING', 'COMPLETING')),
w AS (SELECT DISTINCT node FROM nodes)
SELECT w.node, o.job_id, o.user_name, o.account, o.job_name, o.state, o.n_cpus,
       CASE WHEN NOT regexp_matches(w.node, '^[A-Za-z0-9._-]+$') THEN 'invalid_key' WHEN o.job_id IS NULL THEN 'none_running' ELSE 'ok' END AS status
FROM w LEFT JOIN on_node o USING (node)""", "queue", "nodes"))
def q_jobs_by_node(spark, sf_dir):
    """Running jobs on every known node (host lists expanded); idle nodes keep a status row."""
    t = Tables(spark, sf_dir)
    return Qo.jobs_by_node(t.queue, t.nodes.select("node"), as_of=JOBS_AS_OF)


@query("fairshare_lookup", W("""SELECT account, user_name, norm_shares, norm_usage, coalesce(level_fs, fair_share) AS level_fs,
       coalesce(level_fs, fair_share) < 1 AS below_share, 'ok' AS status FROM shares WHERE account = 'acct3'""", "shares"))
def q_fairshare_lookup(spark, sf_dir):
    """Fair-share rows of every member of account acct3 (account mode)."""
    return Qo.fairshare_lookup(Tables(spark, sf_dir).shares, account="acct3", as_of=JOBS_AS_OF)


@query("job_details", W(f"""
WITH r AS (SELECT DISTINCT job_id AS req_id, {_VALID_ID.format(x='job_id')} AS valid, {id_parts('job_id', 'r')} FROM job_requests),
q AS (SELECT {id_parts('job_id', 'q')}, job_id AS queue_job_id, state AS queue_state, reason, partition, submit_ts, node_list FROM queue),
s AS (SELECT {id_parts('step_id', 's')}, step_id, state AS acct_state, elapsed_s, max_rss FROM job_steps),
v AS (SELECT * FROM r WHERE valid),
qa AS (SELECT req_id, q.* EXCLUDE (q_base, q_part) FROM v JOIN q ON r_base = q_base WHERE r_part IS NULL
       UNION ALL SELECT req_id, q.* EXCLUDE (q_base, q_part) FROM v JOIN q ON r_base = q_base AND r_part = q_part
       UNION ALL SELECT req_id, q.* EXCLUDE (q_base, q_part) FROM v JOIN q ON r_base = q_base WHERE r_part IS NOT NULL AND {_HOLDS.format(r='r', q='q')}),
sa AS (SELECT req_id, s.* EXCLUDE (s_base, s_part) FROM v JOIN s ON r_base = s_base WHERE r_part IS NULL
       UNION ALL SELECT req_id, s.* EXCLUDE (s_base, s_part) FROM v JOIN s ON r_base = s_base AND r_part = s_part
       UNION ALL SELECT req_id, s.* EXCLUDE (s_base, s_part) FROM v JOIN s ON r_base = s_base WHERE r_part IS NOT NULL AND {_HOLDS.format(r='r', q='s')}),
a AS (SELECT req_id, 'queue' AS part, queue_job_id, queue_state, reason, partition, submit_ts, node_list,
             NULL::VARCHAR AS step_id, NULL::VARCHAR AS acct_state, NULL::BIGINT AS elapsed_s, NULL::VARCHAR AS max_rss FROM qa
      UNION ALL
      SELECT req_id, 'accounting', NULL, NULL, NULL, NULL, NULL, NULL, step_id, acct_state, elapsed_s, max_rss FROM sa)
SELECT r.req_id AS job_id, a.* EXCLUDE (req_id), NULL::VARCHAR AS exit_code,
       CASE WHEN NOT r.valid THEN 'invalid_key' WHEN a.part IS NULL THEN 'unknown_key'
            WHEN iq.req_id IS NULL THEN 'not_in_queue' WHEN ia.req_id IS NULL THEN 'no_accounting' ELSE 'ok' END AS status
FROM r LEFT JOIN a USING (req_id) LEFT JOIN (SELECT DISTINCT req_id FROM qa) iq USING (req_id) LEFT JOIN (SELECT DISTINCT req_id FROM sa) ia USING (req_id)""", "queue", "job_steps", "job_requests"))
def q_job_details(spark, sf_dir):
    """Live record and all accounting rows of every requested job id."""
    t = Tables(spark, sf_dir)
    return J.job_details(t.job_requests, t.queue, t.job_steps, as_of=JOBS_AS_OF)


_OVERRIDES = {"building": 2.0, "machinery": 6.5}


@query("join_ratio_override", W(f"""WITH {_RATIO}
SELECT partition, round(measured_ratio, 6) AS measured_ratio,
       round(coalesce(CASE partition WHEN 'building' THEN 2.0 WHEN 'machinery' THEN 6.5 END, measured_ratio), 6) AS ratio
FROM ratio""", "nodes"))
def q_join_ratio_override(spark, sf_dir):
    """GB/CPU of every partition with configured overrides (building 2.0, machinery 6.5) winning over the measured value."""
    df = Qo.partition_mem_ratio(Tables(spark, sf_dir).nodes, _OVERRIDES, as_of=JOBS_AS_OF)
    return df.select("partition", F.round("measured_ratio", 6).alias("measured_ratio"), F.round("ratio", 6).alias("ratio"))
