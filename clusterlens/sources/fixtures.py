"""Canonical cluster-operations tables derived by Spark from the test tables.

The driver's test data is a TPC-H-like star schema plus event, document and
text tables. Each function here maps it onto one canonical table of the
engine (jobs, job_steps, queue, nodes, shares, samples, docs, log_lines,
files, scripts), row for row, so every query's work grows with the inputs.
All derivations are narrow projections or joins against the small
``customer`` dimension; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

# The "now" of each data family (the test data is historic).
JOBS_AS_OF = "2001-08-01 00:00:00"
# Snapshots taken an hour before and after; state tables hold all of them.
EARLIER, LATER = "2001-07-31 23:00:00", "2001-08-01 01:00:00"
METRICS_AS_OF = "2024-01-30 23:59:59"
INTERACTIVE_PARTITIONS = ("furniture",)
READ_ROOTS = ("/work",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.col("o_orderkey")


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad3(c: Column) -> Column:
    text = _s(c)  # longer numbers stay whole
    return F.lpad(text, F.greatest(F.lit(3), F.length(text)), F.lit("0"))


def _mem_unit(k: Column) -> Column:
    return F.when(k % 3 == 0, "G").when(k % 3 == 1, "").otherwise("M")


def _orders_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # customer is a dimension (1/10 of orders): Spark's size-checked
    # auto-broadcast threshold decides whether it is broadcast.
    return o.join(c, o.o_custkey == c.c_custkey, "inner")


def _job_identity(k: Column) -> list[Column]:
    return [
        F.concat(F.lit("u"), _s(F.col("o_custkey"))).alias("user_name"),
        F.concat(F.lit("acct"), _s(F.col("c_nationkey"))).alias("account"),
        F.lower(F.col("c_mktsegment")).alias("partition"),
        F.concat(F.substring(F.col("o_orderpriority"), 3, 1 << 20), F.lit("_"), _s(k % 97), F.lit("_step"), _s(k % 11)).alias("job_name"),
    ]


def _job_state(k: Column) -> Column:
    return (F.when(k % 10 == 0, "FAILED").when(k % 10 == 1, "TIMEOUT").when(k % 10 == 2, "OUT_OF_MEMORY")
            .when(k % 10 == 3, "NODE_FAIL").when(k % 10 == 4, F.concat(F.lit("CANCELLED by "), _s(F.col("o_custkey"))))
            .when(k % 10 == 5, "").otherwise("COMPLETED"))


def _elapsed() -> Column:
    return F.floor(F.col("o_totalprice")).cast("bigint") % 7200


def _hosts(spark: SparkSession, sf_dir: str) -> Column:
    """Number of hosts with samples: jobs are dealt over all of them, however many there are."""
    return table(spark, sf_dir, "events").agg(F.max("user_id") + 1).scalar()


def _log_files(spark: SparkSession, sf_dir: str) -> Column:
    """Number of log files, one for each document."""
    return table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()


def _node_range(k: Column, hosts: Column, more: int = 1) -> Column:
    first = k % hosts
    return F.concat(F.lit("node["), _pad3(first), F.lit("-"), _pad3(first + more), F.lit("]"))


def _log_file(c: Column) -> Column:
    return F.concat(F.lit("/work/logs/"), _s(c), F.lit(".log"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting rows, one per job (orders ⋈ customer)."""
    k, hosts, files = _k(), _hosts(spark, sf_dir), _log_files(spark, sf_dir)
    stdout = (F.when(k % 4 == 0, _log_file(k % files)).when(k % 4 == 1, F.lit("%x_%j.log"))
              .when(k % 4 == 2, F.lit("/dev/null")).otherwise(_log_file((k + 1) % files)))
    stderr = F.when(k % 3 == 0, stdout).when(k % 3 == 1, _log_file((k * 7) % files)).otherwise(F.lit(""))
    tres = F.concat(
        F.lit("cpu="), _s(1 + k % 64), F.lit(",mem="), _s(1 + k % 512), _mem_unit(k), F.lit(",node="), _s(1 + k % 4),
        F.when(k % 5 == 0, F.concat(F.lit(",gres/gpu="), _s(1 + k % 8))).otherwise(F.lit("")),
    )
    return _orders_customer(spark, sf_dir).select(
        _s(k).alias("job_id"),
        *_job_identity(k),
        _job_state(k).alias("state"),
        _elapsed().alias("elapsed_s"),
        tres.alias("alloc_tres"),
        _node_range(k, hosts).alias("node_list"),
        F.timestamp_add("SECOND", -_elapsed(), F.col("o_orderdate")).alias("start_ts"),
        F.col("o_orderdate").alias("end_ts"),
        F.concat(_s(k % 3), F.lit(":0")).alias("exit_code"),
        F.concat(F.lit("/work/u"), _s(F.col("o_custkey"))).alias("work_dir"),
        F.when(k % 13 == 0, 0).otherwise(1).alias("batch_flag"),
        stdout.alias("stdout"),
        stderr.alias("stderr"),
    )


def _hms(t: Column) -> Column:
    return F.concat(_s(F.floor(t / 3600).cast("bigint")), F.lit(":"), F.lpad(_s(F.floor(t / 60).cast("bigint") % 60), 2, "0"),
                    F.lit(":"), F.lpad(_s(t % 60), 2, "0"))


def job_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting rows with steps: one main row per order, one step per (order, line number)."""
    k, hosts = _k(), _hosts(spark, sf_dir)
    cpu_s = F.floor(_elapsed() * (1 + k % 4) * (k % 10) / 10).cast("bigint")
    main = _orders_customer(spark, sf_dir).select(
        _s(k).alias("step_id"),
        *_job_identity(k)[:1],
        _job_identity(k)[3],
        _job_state(k).alias("state"),
        _elapsed().alias("elapsed_s"),
        F.when(k % 17 == 0, F.lit("INVALID")).otherwise(_hms(cpu_s)).alias("total_cpu"),
        (1 + k % 4).cast("int").alias("alloc_cpus"),
        (1 + k % 2).cast("int").alias("n_nodes"),
        F.concat(_s(1 + k % 8), F.when(k % 4 == 0, "Gc").when(k % 4 == 1, "Gn").otherwise("G")).alias("req_mem"),
        F.when(k % 7 == 0, F.concat(_s(k % 4000), F.lit("M"))).otherwise(F.lit("")).alias("max_rss"),
        F.when(k % 9 == 0, F.lit("UNLIMITED")).otherwise(_s(30 + k % 600)).alias("timelimit_min"),
        _node_range(k, hosts).alias("node_list"),
        F.col("o_orderdate").alias("end_ts"),
    )
    li = table(spark, sf_dir, "lineitem")
    steps = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.max(F.floor(F.col("l_extendedprice")).cast("bigint")).alias("mx_price"),
        F.max("l_suppkey").alias("mx_supp"),
        F.max("l_partkey").alias("mx_part"),
    ).select(
        F.concat(_s(F.col("l_orderkey")), F.lit("."), _s(F.col("l_linenumber"))).alias("step_id"),
        F.lit(None).cast("string").alias("user_name"),
        F.lit("step").alias("job_name"),
        F.lit("COMPLETED").alias("state"),
        F.lit(None).cast("bigint").alias("elapsed_s"),
        F.concat(F.lpad(_s(F.col("mx_supp") % 3), 2, "0"), F.lit(":"), F.lpad(_s(F.col("mx_part") % 60), 2, "0"), F.lit(":00")).alias("total_cpu"),
        F.lit(None).cast("int").alias("alloc_cpus"),
        F.lit(None).cast("int").alias("n_nodes"),
        F.lit("").alias("req_mem"),
        F.concat(_s(F.col("mx_price") * 64), F.lit("K")).alias("max_rss"),
        F.lit("").alias("timelimit_min"),
        F.lit("").alias("node_list"),
        F.lit(None).cast("timestamp_ntz").alias("end_ts"),
    )
    return main.unionByName(steps)


def _taken(*times: str) -> Column:
    return F.array(*(F.to_timestamp_ntz(F.lit(t)) for t in times))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue snapshots (orders ⋈ customer): all jobs at ``JOBS_AS_OF``, every fifth, pending, in the ones before and after.

    Array jobs hold one pending row of several tasks, or (every tenth order)
    two started tasks beside the pending rest.
    """
    k = _k()
    jid = (F.when(k % 10 == 7, F.array(*(F.concat(_s(k), F.lit(t)) for t in ("_1", "_2", "_[3-6%2]"))))
           .when(k % 6 == 0, F.array(F.concat(_s(k), F.lit("_[1-"), _s(1 + k % 20), F.lit("%4]"))))
           .when(k % 6 == 1, F.array(F.concat(_s(k), F.lit("_[1,3,5-7]")))).otherwise(F.array(_s(k))))
    reason = (F.when(k % 9 == 0, "DependencyNeverSatisfied").when(k % 9 == 1, "JobHeldUser")
              .when(k % 9 == 2, "ReqNodeNotAvail, UnavailableNodes:node001").when(k % 9 == 3, "Licenses")
              .when(k % 9 == 4, "Resources").when(k % 9 == 5, "").otherwise("Priority"))
    now = F.to_timestamp_ntz(F.lit(JOBS_AS_OF))
    state = (F.when((F.col("snapshot_ts") != now) | F.col("job_id").endswith("]") & (k % 10 == 7), "PENDING")
             .when(F.col("o_orderstatus") == "P", "PENDING").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("COMPLETING"))
    rows = _orders_customer(spark, sf_dir).withColumn("job_id", F.explode(jid))
    rows = rows.withColumn("snapshot_ts", F.explode(F.when(k % 5 == 0, _taken(EARLIER, JOBS_AS_OF, LATER)).otherwise(_taken(JOBS_AS_OF))))
    return rows.select(
        "snapshot_ts",
        "job_id",
        *_job_identity(k),
        state.alias("state"),
        (1 + k % 4).cast("int").alias("n_nodes"),
        (1 + k % 64).cast("int").alias("n_cpus"),
        F.concat(F.lit("cpu="), _s(1 + k % 64), F.lit(",mem="), _s(1 + k % 512), _mem_unit(k)).alias("tres"),
        F.col("o_orderdate").alias("submit_ts"),
        reason.alias("reason"),
        (F.floor(F.col("o_totalprice")).cast("bigint") % 100000).alias("priority"),
        _node_range(k, _hosts(spark, sf_dir), 2).alias("node_list"),
    )


def priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority factors of pending jobs, split from the queue priority."""
    q = queue(spark, sf_dir).where(F.col("state") == "PENDING")
    p = F.col("priority")
    return q.select(
        "snapshot_ts", "job_id", "user_name", "partition", "priority",
        (p % 1000).alias("age"), (F.floor(p / 1000).cast("bigint") % 50).alias("fairshare"),
        (p - p % 1000 - (F.floor(p / 1000).cast("bigint") % 50) * 1000).alias("jobsize"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node states (supplier): partition, state, reason, CPUs (text, ``64+`` form) and memory; all were drained a snapshot before."""
    n = F.col("s_suppkey")
    part = (F.when(n % 5 == 0, "automobile").when(n % 5 == 1, "building").when(n % 5 == 2, "furniture")
            .when(n % 5 == 3, "household").otherwise("machinery"))
    before = F.col("snapshot_ts") == F.to_timestamp_ntz(F.lit(EARLIER))
    state = (F.when(before, "drained").when(F.col("s_acctbal") < 0, "down").when(n % 3 == 0, "idle").when(n % 3 == 1, "allocated")
             .otherwise("mixed"))
    return table(spark, sf_dir, "supplier").withColumn("snapshot_ts", F.explode(_taken(EARLIER, JOBS_AS_OF))).select(
        "snapshot_ts",
        F.concat(F.lit("node"), _pad3(n)).alias("node"),
        part.alias("partition"),
        state.alias("state"),
        F.when(before, "power").when(F.col("s_acctbal") < 0, F.concat(F.lit("maintenance "), _s(n % 4))).alias("reason"),
        F.concat(_s(32 * (1 + n % 2)), F.when(n % 4 == 0, "+").otherwise("")).alias("cpus"),
        (32 * (1 + n % 2) * F.when(before, 16384).otherwise(2048 + 1024 * (n % 3))).cast("bigint").alias("mem_mb"),
        F.when(n % 5 == 2, F.concat(F.lit("gpu:a100:"), _s(1 + n % 4))).otherwise(F.lit("(null)")).alias("gres"),
    )


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fair-share associations (customer); all levels were 9 a snapshot before."""
    c = F.col("c_custkey")
    ns = (1 + c % 10) / F.lit(100.0)
    nu = (1 + c % 37) / F.lit(1000.0)
    before = F.col("snapshot_ts") == F.to_timestamp_ntz(F.lit(EARLIER))
    return table(spark, sf_dir, "customer").withColumn("snapshot_ts", F.explode(_taken(EARLIER, JOBS_AS_OF))).select(
        "snapshot_ts",
        F.concat(F.lit("acct"), _s(F.col("c_nationkey"))).alias("account"),
        F.concat(F.lit("u"), _s(c)).alias("user_name"),
        ns.alias("norm_shares"),
        nu.alias("norm_usage"),
        F.when(before, 9.0).when(c % 11 != 0, F.round(ns / nu, 6)).alias("level_fs"),
        F.round(ns / (ns + nu), 6).alias("fair_share"),
    )


def _instance(user_id: Column) -> Column:
    return F.concat(F.lit("node"), _pad3(user_id), F.lit(":9100"))


def _with_counter(events: DataFrame) -> DataFrame:
    """Events with their place in their (type, user) series, modulo 7: a counter that is reset now and then."""
    ev = events.withColumn("_d", F.to_date("ts"))
    # Counter = position of the event in its (type, user) series, mod 7. The
    # position is numbered per day and offset by the counts of earlier days,
    # so a user holding a third of all events is still split across tasks.
    g = ["event_type", "user_id"]
    in_day = F.row_number().over(Window.partitionBy(*g, "_d").orderBy("ts", "event_id"))
    per_day = ev.groupBy(*g, "_d").agg(F.count(F.lit(1)).alias("_n"))
    per_day = per_day.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*g).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ev = ev.withColumn("_r", in_day).join(per_day.select(*g, "_d", "_off"), [*g, "_d"], "inner")
    return ev.withColumn("counter", ((F.col("_off") + F.col("_r")) % 7).cast("double"))


def samples(spark: SparkSession, sf_dir: str, metrics: Collection[str] | None = None) -> DataFrame:
    """Metric samples (events): node exporter and GPU series with a label map; of ``metrics`` alone, if given.

    click → load5 and boot time; view → load1; signup → memory gauges;
    error → counters (idle CPU seconds, network bytes, XID errors) that
    reset every 7 samples; purchase → five per-GPU gauges. Events of a type
    without a wanted metric are not read.
    """
    events = table(spark, sf_dir, "events")
    inst = _instance(F.col("user_id"))
    host = F.concat(F.lit("node"), _pad3(F.col("user_id")))
    gpu = _s(F.col("event_id") % 4)
    v = F.col("value")
    fb = F.floor(v) * 64
    none = F.lit(None).cast("string")

    def emit(event_type: str, rows: list[tuple]) -> DataFrame | None:
        rows = [r for r in rows if metrics is None or r[0] in metrics]
        if not rows:
            return None
        ev = events.where(F.col("event_type") == event_type)
        ev = _with_counter(ev) if event_type == "error" else ev
        parts = [
            F.struct(F.lit(m).alias("metric"), val.cast("double").alias("value"),
                     F.map_filter(F.create_map(*[x for kv in labels for x in kv]), lambda _k, lv: lv.isNotNull()).alias("labels"))
            for m, val, labels in rows
        ]
        return ev.select("ts", F.explode(F.array(*parts)).alias("s"))

    node_l = [(F.lit("instance"), inst)]
    gpu_l = [(F.lit("instance"), F.concat(host, F.lit(":9400"))), (F.lit("Hostname"), host), (F.lit("gpu"), gpu),
             (F.lit("modelName"), F.when(F.col("user_id") % 2 == 0, "NVIDIA A100").otherwise("NVIDIA H100"))]
    frames = [
        emit("click", [("node_load5", v, node_l),
                       ("node_boot_time_seconds", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - F.floor(v) * 3600, node_l)]),
        emit("view", [("node_load1", v, node_l)]),
        emit("signup", [("node_memory_MemTotal_bytes", F.lit(274877906944.0), node_l),
                        ("node_memory_MemFree_bytes", F.floor(v) * 268435456, node_l),
                        ("node_memory_Cached_bytes", F.floor(v) * 67108864, node_l),
                        ("node_memory_Buffers_bytes", F.floor(v) * 16777216, node_l)]),
        emit("error", [("node_cpu_seconds_total", F.col("counter"), node_l + [(F.lit("mode"), F.lit("idle")), (F.lit("cpu"), _s(F.col("event_id") % 2))]),
                       ("node_network_receive_bytes_total", F.col("counter") * 1000, node_l + [(F.lit("device"), F.lit("eth0"))]),
                       ("node_network_transmit_bytes_total", F.col("counter") * 500, node_l + [(F.lit("device"), F.lit("eth0"))]),
                       ("DCGM_FI_DEV_XID_ERRORS", F.col("counter"), gpu_l)]),
        emit("purchase", [("DCGM_FI_DEV_GPU_UTIL", F.floor(v) % 101, gpu_l),
                          ("DCGM_FI_DEV_FB_USED", fb, gpu_l),
                          ("DCGM_FI_DEV_FB_FREE", 81920 - fb, gpu_l),
                          ("DCGM_FI_DEV_GPU_TEMP", 30 + F.floor(v) % 50, gpu_l),
                          ("DCGM_FI_DEV_POWER_USAGE", 100 + v, gpu_l)]),
    ]
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError(f"no such metrics: {metrics}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select(F.col("s.metric").alias("metric"), F.col("s.labels").alias("labels"), "ts", F.col("s.value").alias("value"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log documents (events): daily index, level, host, message, props JSON."""
    ev = table(spark, sf_dir, "events")
    message = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), F.col("event_type"), F.lit(" "), F.col("props"), F.lit(" "))).otherwise(F.lit(""))
    return ev.select(
        F.concat(F.lit("logs-"), F.substring(_s(F.col("ts")), 1, 10)).alias("idx"),
        F.col("event_id").alias("doc_id"),
        "ts",
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("node"), _s(F.col("user_id") % 20)).alias("host"),
        F.col("event_type").alias("event_type"),
        message.alias("message"),
        F.col("value").alias("value"),
        "props",
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files as numbered lines (documents: one file per document, whole text)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(_log_file(F.col("doc_id")).alias("path"), F.posexplode(F.split(F.col("text"), "\n")).alias("pos", "line")).select(
        "path", (F.col("pos") + 1).cast("bigint").alias("lineno"), "line"
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File inventory (orders): one data file per job plus the per-user directories."""
    o = table(spark, sf_dir, "orders")
    k = _k()
    parent = F.concat(F.lit("/work/u"), _s(F.col("o_custkey")))
    f = o.select(
        F.concat(parent, F.lit("/o"), _s(k), F.lit(".dat")).alias("path"),
        parent.alias("parent"),
        F.concat(F.lit("o"), _s(k), F.lit(".dat")).alias("name"),
        F.lit("f").alias("kind"),
        (F.floor(F.col("o_totalprice")).cast("bigint") * 1024).alias("size"),
        F.col("o_orderdate").alias("mtime"),
        F.concat(F.lit("u"), _s(F.col("o_custkey"))).alias("owner"),
    )
    d = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("mtime")).select(
        F.concat(F.lit("/work/u"), _s(F.col("o_custkey"))).alias("path"),
        F.lit("/work").alias("parent"),
        F.concat(F.lit("u"), _s(F.col("o_custkey"))).alias("name"),
        F.lit("d").alias("kind"),
        F.lit(None).cast("bigint").alias("size"),
        "mtime",
        F.concat(F.lit("u"), _s(F.col("o_custkey"))).alias("owner"),
    )
    return f.unionByName(d)


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scripts (orders): module lines, a launcher and a data path (a third of them absent)."""
    o = table(spark, sf_dir, "orders")
    k = _k()
    nl = F.lit("\n")
    launcher = F.when(k % 4 == 0, "mpirun ").when(k % 4 == 1, "srun ").when(k % 4 == 2, "OMP_NUM_THREADS=4 ").otherwise("")
    target = F.when(k % 3 == 0, k + 10000000).otherwise(k)
    return o.select(
        _s(k).alias("job_id"),
        F.concat(F.lit("#!/bin/bash"), nl, F.lit("module load gcc/"), _s(k % 5), F.lit(" -q python"), nl, launcher,
                 F.lit("./run /work/u"), _s(F.col("o_custkey")), F.lit("/o"), _s(target), F.lit(".dat."), nl).alias("script"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known logins (customer)."""
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), _s(F.col("c_custkey"))).alias("user_name"))


def assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account → user associations (customer)."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("acct"), _s(F.col("c_nationkey"))).alias("account"),
        F.concat(F.lit("u"), _s(F.col("c_custkey"))).alias("user_name"),
    )


def jobs_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs moved into the metric month (orders): 2024-01 ends, 12× longer runs, every 20th still running."""
    k = _k()
    end = F.timestamp_add("HOUR", (F.datediff(F.col("o_orderdate"), F.lit("1995-01-01")) % 30) * 24 + k % 24,
                          F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    return table(spark, sf_dir, "orders").select(
        _s(k).alias("job_id"),
        _node_range(k, _hosts(spark, sf_dir)).alias("node_list"),
        F.timestamp_add("SECOND", -_elapsed() * 12, end).alias("start_ts"),
        F.when(k % 20 != 0, end).alias("end_ts"),
    )


def job_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested job ids (orders): mostly known ids, some unknown (``x<k>``), some invalid (``<k>!``), some array tasks (``<k>_4``)."""
    k = _k()
    rid = F.when(k % 50 == 0, F.concat(_s(k), F.lit("!"))).when(k % 7 == 0, F.concat(F.lit("x"), _s(k)))
    rid = rid.when(k % 20 == 17, F.concat(_s(k), F.lit("_4"))).when(k % 20 == 11, F.concat(_s(k), F.lit("_4"))).otherwise(_s(k))
    return table(spark, sf_dir, "orders").select(rid.alias("job_id"))


def login_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested logins (customer): mostly known, some unknown (``v<c>``), some invalid (``u<c>;``)."""
    c = F.col("c_custkey")
    lid = (F.when(c % 50 == 0, F.concat(F.lit("u"), _s(c), F.lit(";"))).when(c % 13 == 0, F.concat(F.lit("v"), _s(c)))
           .otherwise(F.concat(F.lit("u"), _s(c))))
    return table(spark, sf_dir, "customer").select(lid.alias("user_name"))


def account_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested accounts (nation): known ``acct<n>``, unknown ``grp<n>`` for every 7th nation."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.when(n % 7 == 0, F.concat(F.lit("grp"), _s(n))).otherwise(F.concat(F.lit("acct"), _s(n))).alias("account"))


TABLES = {
    "login_requests": login_requests, "account_requests": account_requests,
    "job_requests": job_requests, "jobs_recent": jobs_recent,
    "jobs": jobs, "job_steps": job_steps, "queue": queue, "priorities": priorities, "nodes": nodes,
    "shares": shares, "samples": samples, "docs": docs, "log_lines": log_lines, "files": files,
    "scripts": scripts, "users": users, "assoc": assoc,
}


class Tables:
    """Lazy accessor: ``t.jobs`` is the derived table, derived inside the query's own plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = TABLES[name](self.spark, self.sf_dir)
        return self._cache[name]

    def samples_of(self, *metrics: str) -> DataFrame:
        """The samples of these metrics, as a store partitioned by metric gives them."""
        return samples(self.spark, self.sf_dir, metrics)

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)
