"""The canonical tables written as DuckDB SQL over the raw test tables.

These are the independent oracle twins of ``sources/fixtures.py``: each
CTE text reproduces one derived table for the DuckDB side of the
correctness check. ``with_fixtures(sql, *names)`` prefixes a query with
the CTEs it needs (dependencies included).
"""

from __future__ import annotations

K = "o_orderkey"


def _mem_unit() -> str:
    return f"CASE {K} % 3 WHEN 0 THEN 'G' WHEN 1 THEN '' ELSE 'M' END"


_IDENTITY = f"""
    concat('u', o_custkey) AS user_name,
    concat('acct', c_nationkey) AS account,
    lower(c_mktsegment) AS partition,
    concat(substr(o_orderpriority, 3), '_', {K} % 97, '_step', {K} % 11) AS job_name"""

_STATE = f"""CASE {K} % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'TIMEOUT' WHEN 2 THEN 'OUT_OF_MEMORY'
      WHEN 3 THEN 'NODE_FAIL' WHEN 4 THEN concat('CANCELLED by ', o_custkey) WHEN 5 THEN '' ELSE 'COMPLETED' END"""

_ELAPSED = "CAST(floor(o_totalprice) AS BIGINT) % 7200"
# Jobs are dealt over all hosts with samples and all log files, however many there are.
_HOSTS = "(SELECT max(user_id) + 1 FROM events)"
_FILES = "(SELECT count(*) FROM documents)"


def _pad3(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), CAST(greatest(3, length(CAST({x} AS VARCHAR))) AS INTEGER), '0')"


def _node_range(more: int = 1) -> str:
    first = f"({K} % {_HOSTS})"
    return f"concat('node[', {_pad3(first)}, '-', {_pad3(f'{first} + {more}')}, ']')"


_TWO_NODES = _node_range()


def _log(expr: str) -> str:
    return f"concat('/work/logs/', {expr}, '.log')"


_STDOUT = f"""CASE {K} % 4 WHEN 0 THEN {_log(f'{K} % {_FILES}')} WHEN 1 THEN '%x_%j.log' WHEN 2 THEN '/dev/null'
      ELSE {_log(f'({K} + 1) % {_FILES}')} END"""


def _hms(t: str) -> str:
    return (f"concat(CAST(CAST(floor({t} / 3600) AS BIGINT) AS VARCHAR), ':', lpad(CAST(CAST(floor({t} / 60) AS BIGINT) % 60 AS VARCHAR), 2, '0'),"
            f" ':', lpad(CAST({t} % 60 AS VARCHAR), 2, '0'))")


_CPU_S = f"CAST(floor(({_ELAPSED}) * (1 + {K} % 4) * ({K} % 10) / 10) AS BIGINT)"

FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {
    "jobs": (f"""SELECT CAST({K} AS VARCHAR) AS job_id, {_IDENTITY},
    {_STATE} AS state,
    {_ELAPSED} AS elapsed_s,
    concat('cpu=', 1 + {K} % 64, ',mem=', 1 + {K} % 512, {_mem_unit()}, ',node=', 1 + {K} % 4,
           CASE WHEN {K} % 5 = 0 THEN concat(',gres/gpu=', 1 + {K} % 8) ELSE '' END) AS alloc_tres,
    {_TWO_NODES} AS node_list,
    o_orderdate - to_seconds({_ELAPSED}) AS start_ts,
    o_orderdate AS end_ts,
    concat({K} % 3, ':0') AS exit_code,
    concat('/work/u', o_custkey) AS work_dir,
    CASE WHEN {K} % 13 = 0 THEN 0 ELSE 1 END AS batch_flag,
    {_STDOUT} AS stdout,
    CASE WHEN {K} % 3 = 0 THEN {_STDOUT} WHEN {K} % 3 = 1 THEN {_log(f'({K} * 7) % {_FILES}')} ELSE '' END AS stderr
  FROM orders JOIN customer ON o_custkey = c_custkey""", ()),
    "job_steps": (f"""SELECT CAST({K} AS VARCHAR) AS step_id, concat('u', o_custkey) AS user_name,
    concat(substr(o_orderpriority, 3), '_', {K} % 97, '_step', {K} % 11) AS job_name,
    {_STATE} AS state, {_ELAPSED} AS elapsed_s,
    CASE WHEN {K} % 17 = 0 THEN 'INVALID' ELSE {_hms(_CPU_S)} END AS total_cpu,
    CAST(1 + {K} % 4 AS INTEGER) AS alloc_cpus, CAST(1 + {K} % 2 AS INTEGER) AS n_nodes,
    concat(1 + {K} % 8, CASE {K} % 4 WHEN 0 THEN 'Gc' WHEN 1 THEN 'Gn' ELSE 'G' END) AS req_mem,
    CASE WHEN {K} % 7 = 0 THEN concat({K} % 4000, 'M') ELSE '' END AS max_rss,
    CASE WHEN {K} % 9 = 0 THEN 'UNLIMITED' ELSE CAST(30 + {K} % 600 AS VARCHAR) END AS timelimit_min,
    {_TWO_NODES} AS node_list, o_orderdate AS end_ts
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT concat(l_orderkey, '.', l_linenumber), NULL, 'step', 'COMPLETED', NULL,
    concat(lpad(CAST(max(l_suppkey) % 3 AS VARCHAR), 2, '0'), ':', lpad(CAST(max(l_partkey) % 60 AS VARCHAR), 2, '0'), ':00'),
    NULL, NULL, '', concat(max(CAST(floor(l_extendedprice) AS BIGINT)) * 64, 'K'), '', '', NULL
  FROM lineitem GROUP BY l_orderkey, l_linenumber""", ()),
    "queue": (f"""SELECT TIMESTAMP '2001-08-01 00:00:00' AS snapshot_ts,
    job_id, {_IDENTITY},
    CASE WHEN {K} % 10 = 7 AND ends_with(job_id, ']') THEN 'PENDING' WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE 'COMPLETING' END AS state,
    CAST(1 + {K} % 4 AS INTEGER) AS n_nodes, CAST(1 + {K} % 64 AS INTEGER) AS n_cpus,
    concat('cpu=', 1 + {K} % 64, ',mem=', 1 + {K} % 512, {_mem_unit()}) AS tres,
    o_orderdate AS submit_ts,
    CASE {K} % 9 WHEN 0 THEN 'DependencyNeverSatisfied' WHEN 1 THEN 'JobHeldUser'
      WHEN 2 THEN 'ReqNodeNotAvail, UnavailableNodes:node001' WHEN 3 THEN 'Licenses' WHEN 4 THEN 'Resources'
      WHEN 5 THEN '' ELSE 'Priority' END AS reason,
    CAST(floor(o_totalprice) AS BIGINT) % 100000 AS priority,
    {_node_range(2)} AS node_list
  FROM (SELECT *, unnest(CASE WHEN {K} % 10 = 7 THEN [concat({K}, '_1'), concat({K}, '_2'), concat({K}, '_[3-6%2]')]
      WHEN {K} % 6 = 0 THEN [concat({K}, '_[1-', 1 + {K} % 20, '%4]')] WHEN {K} % 6 = 1 THEN [concat({K}, '_[1,3,5-7]')]
      ELSE [CAST({K} AS VARCHAR)] END) AS job_id
    FROM orders JOIN customer ON o_custkey = c_custkey)""", ()),
    "priorities": ("""SELECT snapshot_ts, job_id, user_name, partition, priority, priority % 1000 AS age,
    CAST(floor(priority / 1000) AS BIGINT) % 50 AS fairshare,
    priority - priority % 1000 - (CAST(floor(priority / 1000) AS BIGINT) % 50) * 1000 AS jobsize
  FROM queue WHERE state = 'PENDING'""", ("queue",)),
    "nodes": ("""SELECT TIMESTAMP '2001-08-01 00:00:00' AS snapshot_ts,
    concat('node', lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0')) AS node,
    CASE s_suppkey % 5 WHEN 0 THEN 'automobile' WHEN 1 THEN 'building' WHEN 2 THEN 'furniture' WHEN 3 THEN 'household' ELSE 'machinery' END AS partition,
    CASE WHEN s_acctbal < 0 THEN 'down' WHEN s_suppkey % 3 = 0 THEN 'idle' WHEN s_suppkey % 3 = 1 THEN 'allocated' ELSE 'mixed' END AS state,
    CASE WHEN s_acctbal < 0 THEN concat('maintenance ', s_suppkey % 4) END AS reason,
    concat(32 * (1 + s_suppkey % 2), CASE WHEN s_suppkey % 4 = 0 THEN '+' ELSE '' END) AS cpus,
    CAST(32 * (1 + s_suppkey % 2) * (2048 + 1024 * (s_suppkey % 3)) AS BIGINT) AS mem_mb,
    CASE WHEN s_suppkey % 5 = 2 THEN concat('gpu:a100:', 1 + s_suppkey % 4) ELSE '(null)' END AS gres
  FROM supplier""", ()),
    "shares": ("""SELECT concat('acct', c_nationkey) AS account, concat('u', c_custkey) AS user_name,
    (1 + c_custkey % 10) / 100.0::DOUBLE AS norm_shares, (1 + c_custkey % 37) / 1000.0::DOUBLE AS norm_usage,
    CASE WHEN c_custkey % 11 != 0 THEN round(((1 + c_custkey % 10) / 100.0::DOUBLE) / ((1 + c_custkey % 37) / 1000.0::DOUBLE), 6) END AS level_fs,
    round(((1 + c_custkey % 10) / 100.0::DOUBLE) / (((1 + c_custkey % 10) / 100.0::DOUBLE) + ((1 + c_custkey % 37) / 1000.0::DOUBLE)), 6) AS fair_share
  FROM customer""", ()),
    "docs": ("""SELECT concat('logs-', substr(CAST(ts AS VARCHAR), 1, 10)) AS idx, event_id AS doc_id, ts,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    concat('node', user_id % 20) AS host, event_type,
    CASE WHEN event_id % 3 = 0 THEN concat(' ', event_type, ' ', props, ' ') ELSE '' END AS message,
    value, props
  FROM events""", ()),
    "log_lines": ("""SELECT concat('/work/logs/', doc_id, '.log') AS path, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS lineno,
    unnest(string_split(text, chr(10))) AS line
  FROM documents""", ()),
    "files": ("""SELECT concat('/work/u', o_custkey, '/o', o_orderkey, '.dat') AS path, concat('/work/u', o_custkey) AS parent,
    concat('o', o_orderkey, '.dat') AS name, 'f' AS kind, CAST(floor(o_totalprice) AS BIGINT) * 1024 AS size,
    o_orderdate AS mtime, concat('u', o_custkey) AS owner
  FROM orders
  UNION ALL
  SELECT concat('/work/u', o_custkey), '/work', concat('u', o_custkey), 'd', NULL, max(o_orderdate), concat('u', o_custkey)
  FROM orders GROUP BY o_custkey""", ()),
    "scripts": (f"""SELECT CAST({K} AS VARCHAR) AS job_id,
    concat('#!/bin/bash', chr(10), 'module load gcc/', {K} % 5, ' -q python', chr(10),
      CASE {K} % 4 WHEN 0 THEN 'mpirun ' WHEN 1 THEN 'srun ' WHEN 2 THEN 'OMP_NUM_THREADS=4 ' ELSE '' END,
      './run /work/u', o_custkey, '/o', CASE WHEN {K} % 3 = 0 THEN {K} + 10000000 ELSE {K} END, '.dat.', chr(10)) AS script
  FROM orders""", ()),
    "job_requests": (f"""SELECT CASE WHEN {K} % 50 = 0 THEN concat({K}, '!') WHEN {K} % 7 = 0 THEN concat('x', {K})
    WHEN {K} % 20 IN (11, 17) THEN concat({K}, '_4') ELSE CAST({K} AS VARCHAR) END AS job_id FROM orders""", ()),
    "jobs_recent": (f"""SELECT CAST({K} AS VARCHAR) AS job_id, {_TWO_NODES} AS node_list,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours((date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) % 30) * 24 + {K} % 24) - to_seconds(({_ELAPSED}) * 12) AS start_ts,
    CASE WHEN {K} % 20 != 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours((date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) % 30) * 24 + {K} % 24) END AS end_ts
  FROM orders""", ()),
    "login_requests": ("""SELECT CASE WHEN c_custkey % 50 = 0 THEN concat('u', c_custkey, ';') WHEN c_custkey % 13 = 0 THEN concat('v', c_custkey)
    ELSE concat('u', c_custkey) END AS user_name FROM customer""", ()),
    "account_requests": ("""SELECT CASE WHEN n_nationkey % 7 = 0 THEN concat('grp', n_nationkey) ELSE concat('acct', n_nationkey) END AS account
  FROM nation""", ()),
    "users": ("SELECT concat('u', c_custkey) AS user_name FROM customer", ()),
    "assoc": ("SELECT concat('acct', c_nationkey) AS account, concat('u', c_custkey) AS user_name FROM customer", ()),
}

_EV_COUNTER = "CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) % 7 AS DOUBLE)"
_INST = "concat('node', lpad(CAST(user_id AS VARCHAR), CAST(greatest(3, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0'), ':9100')"
_HOST = "concat('node', lpad(CAST(user_id AS VARCHAR), CAST(greatest(3, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0'))"
_GPU_COLS = (f"concat({_HOST}, ':9400') AS instance, CAST(event_id % 4 AS VARCHAR) AS gpu, NULL AS mode, NULL AS cpu, NULL AS device, "
             f"{_HOST} AS hostname, CASE WHEN user_id % 2 = 0 THEN 'NVIDIA A100' ELSE 'NVIDIA H100' END AS model")
_NODE_COLS = f"{_INST} AS instance, NULL AS gpu, NULL AS mode, NULL AS cpu, NULL AS device, NULL AS hostname, NULL AS model"


def _emit(event_type: str, metric: str, value: str, cols: str = _NODE_COLS) -> str:
    return f"SELECT '{metric}' AS metric, {cols}, ts, CAST({value} AS DOUBLE) AS value FROM ev WHERE event_type = '{event_type}'"


FIXTURES["ev"] = (f"SELECT *, {_EV_COUNTER} AS counter FROM events", ())
FIXTURES["samples"] = ("\n  UNION ALL ".join([
    _emit("click", "node_load5", "value"),
    _emit("click", "node_boot_time_seconds", "epoch(ts) - floor(value) * 3600"),
    _emit("view", "node_load1", "value"),
    _emit("signup", "node_memory_MemTotal_bytes", "274877906944.0"),
    _emit("signup", "node_memory_MemFree_bytes", "floor(value) * 268435456"),
    _emit("signup", "node_memory_Cached_bytes", "floor(value) * 67108864"),
    _emit("signup", "node_memory_Buffers_bytes", "floor(value) * 16777216"),
    _emit("error", "node_cpu_seconds_total", "counter",
          f"{_INST} AS instance, NULL AS gpu, 'idle' AS mode, CAST(event_id % 2 AS VARCHAR) AS cpu, NULL AS device, NULL AS hostname, NULL AS model"),
    _emit("error", "node_network_receive_bytes_total", "counter * 1000",
          f"{_INST} AS instance, NULL AS gpu, NULL AS mode, NULL AS cpu, 'eth0' AS device, NULL AS hostname, NULL AS model"),
    _emit("error", "node_network_transmit_bytes_total", "counter * 500",
          f"{_INST} AS instance, NULL AS gpu, NULL AS mode, NULL AS cpu, 'eth0' AS device, NULL AS hostname, NULL AS model"),
    _emit("error", "DCGM_FI_DEV_XID_ERRORS", "counter", _GPU_COLS),
    _emit("purchase", "DCGM_FI_DEV_GPU_UTIL", "floor(value) % 101", _GPU_COLS),
    _emit("purchase", "DCGM_FI_DEV_FB_USED", "floor(value) * 64", _GPU_COLS),
    _emit("purchase", "DCGM_FI_DEV_FB_FREE", "81920 - floor(value) * 64", _GPU_COLS),
    _emit("purchase", "DCGM_FI_DEV_GPU_TEMP", "30 + floor(value) % 50", _GPU_COLS),
    _emit("purchase", "DCGM_FI_DEV_POWER_USAGE", "100 + value", _GPU_COLS),
]), ("ev",))


def with_fixtures(body: str, *names: str) -> str:
    order: list[str] = []

    def need(n: str) -> None:
        for dep in FIXTURES[n][1]:
            need(dep)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS (\n  {FIXTURES[n][0]}\n)" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
