"""Metric operators over ``samples(metric, labels MAP, ts, value)``.

A series is (metric, labels); it is keyed here by ``series`` — the label
map rendered as sorted ``k=v`` text — because maps cannot be grouped.
Times are TIMESTAMP_NTZ and every "now" is an explicit ``as_of``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import predicates as Q
from ..functions import render as R
from .guards import attach_row, positive, top_per_group, with_total
from .queue import snapshot_at

US = 1_000_000
STEP_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def duration_us(text: str | int | float) -> int:
    """``30m`` / ``6h`` / ``1d`` / seconds → microseconds (a parameter, parsed on the driver)."""
    if isinstance(text, (int, float)):
        return int(text * US)
    t = text.strip()
    if t[-1] in STEP_UNITS:
        return int(float(t[:-1]) * STEP_UNITS[t[-1]] * US)
    return int(float(t) * US)


def series_text(labels: Column) -> Column:
    """Label map → ``k1=v1,k2=v2`` with keys sorted: a groupable, stable series key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def select_series(samples: DataFrame, metric: str | Sequence[str] | None = None,
                  matchers: Mapping[str, str] | None = None, regex_matchers: Mapping[str, str] | None = None) -> DataFrame:
    """Samples of the wanted metric(s) whose labels match ``k=v`` and anchored ``k=~re``."""
    s = samples
    if metric is not None:
        s = s.where(F.col("metric") == metric) if isinstance(metric, str) else s.where(F.col("metric").isin(*metric))
    for k, v in (matchers or {}).items():
        s = s.where(F.col("labels")[k] == v)
    for k, rx in (regex_matchers or {}).items():
        s = s.where(F.coalesce(F.col("labels")[k], F.lit("")).rlike(f"^(?:{rx})$"))
    return s.withColumn("series", series_text(F.col("labels")))


def _since(as_of: str, lookback_us: int) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {-lookback_us}, to_timestamp_ntz('{as_of}'))")


def _asof(as_of: str) -> Column:
    return F.to_timestamp_ntz(F.lit(as_of))


def instant_vector(samples: DataFrame, metric: str | Sequence[str] | None, as_of: str, lookback: str | int = "5m",
                   matchers: Mapping[str, str] | None = None, regex_matchers: Mapping[str, str] | None = None) -> DataFrame:
    """Latest sample of every series within (as_of − lookback, as_of].

    ``max_by(value, (ts, value))`` per series: partial aggregation keeps one
    row per series per map task, so a dense series never gathers in one task.
    """
    s = select_series(samples, metric, matchers, regex_matchers)
    s = s.where((F.col("ts") > _since(as_of, duration_us(lookback))) & (F.col("ts") <= _asof(as_of)))
    return s.groupBy("metric", "series").agg(
        F.max_by("labels", F.struct("ts", "value")).alias("labels"),
        F.max("ts").alias("ts"),
        F.max_by("value", F.struct("ts", "value")).alias("value"),
    )


def instant_listing(samples: DataFrame, metric: str, as_of: str, lookback: str | int = "5m", top: int = 50, **kw) -> DataFrame:
    """``instant_vector`` limited to ``top`` series (by series key) with the exact series total."""
    v = instant_vector(samples, metric, as_of, lookback, **kw)
    return with_total(top_per_group(v, [], [F.asc("metric"), F.asc("series")], top), v, (), "n_series")


def range_points(samples: DataFrame, metric: str | Sequence[str] | None, as_of: str, hours: float, step: str | int = "30m",
                 lookback: str | int = "5m", matchers: Mapping[str, str] | None = None,
                 regex_matchers: Mapping[str, str] | None = None) -> DataFrame:
    """Values of every series on the grid start + i·step (start = as_of − hours, i = 0..N).

    A grid point p takes the latest sample in (p − lookback, p]. Samples are
    first reduced to the latest one per (series, first servable point); each
    survivor is expanded to the grid points it can serve, p ∈ [t, t + lookback),
    with ``sequence`` over grid indices — no join — then ``max_by`` per
    (series, point). NaN and null values are dropped.
    """
    step_us, lb_us = duration_us(step), duration_us(lookback)
    span_us = int(hours * 3600 * US)
    n_points = span_us // step_us
    start = _since(as_of, span_us)
    s = select_series(samples, metric, matchers, regex_matchers)
    s = s.where((F.col("ts") > _since(as_of, span_us + lb_us)) & (F.col("ts") <= _asof(as_of)) & Q.not_nan("value"))
    off = F.timestamp_diff("MICROSECOND", start, F.col("ts"))
    # First grid point a sample can serve: k = ceil(off / step). Only the latest
    # sample of each (series, k) can ever win a grid point, so samples are first
    # reduced to one per (series, k) — a partial/final aggregate — and only
    # those are expanded to the points they serve.
    s = s.withColumn("k", F.ceil(off / F.lit(float(step_us))).cast("bigint"))
    latest = F.struct("ts", "value")
    s = s.groupBy("metric", "series", "k").agg(F.max(latest).alias("_l"), F.max_by("labels", latest).alias("labels")).select(
        "metric", "series", "k", "labels", F.col("_l.ts").alias("ts"), F.col("_l.value").alias("value"))
    off = F.timestamp_diff("MICROSECOND", start, F.col("ts"))
    lo = F.greatest(F.col("k"), F.lit(0)).cast("bigint")
    hi = F.least(F.ceil((off + F.lit(lb_us)) / F.lit(float(step_us))) - 1, F.lit(n_points)).cast("bigint")
    pts = s.where(hi >= lo).select("metric", "series", "labels", "ts", "value", F.explode(F.sequence(lo, hi)).alias("i"))
    return pts.groupBy("metric", "series", "i").agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"),
        F.max_by("labels", F.struct("ts", "value")).alias("labels"),
    ).withColumn("t", F.expr(f"timestampadd(MICROSECOND, i * {step_us}, timestampadd(MICROSECOND, {-span_us}, to_timestamp_ntz('{as_of}')))"))


def series_summary(points: DataFrame) -> DataFrame:
    """first / min / max / avg / last / n of each series' grid values."""
    return points.groupBy("metric", "series").agg(
        F.min_by("value", "i").alias("first"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("avg"),
        F.max_by("value", "i").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )


def range_summary(samples: DataFrame, metric: str, as_of: str, hours: float = 24, step: str = "30m",
                  lookback: str | int = "5m", top: int = 10, retry_step: str | None = "5m", **kw) -> DataFrame:
    """Per-series summary over a range, with the ``step`` used; a grid without any value is retried at ``retry_step``.

    The choice is made inside the plan: the samples of the second grid pass a filter on the first grid's number of
    points, a scalar subquery, so nothing runs while the plan is built and at most one of the grids is expanded.
    """
    pts = range_points(samples, metric, as_of, hours, step, lookback, **kw).withColumn("step", F.lit(step))
    if retry_step and step != retry_step:
        empty = pts.select(F.count(F.lit(1))).scalar() == 0
        pts = pts.unionByName(range_points(samples.where(empty), metric, as_of, hours, retry_step, lookback, **kw).withColumn("step", F.lit(retry_step)))
    summ = series_summary(pts.withColumn("series", F.struct("series", "step"))).select("metric", "series.series", "first", "min", "max", "avg", "last", "n", "series.step")
    return with_total(top_per_group(summ, [], [F.asc("metric"), F.asc("series")], top), summ, (), "n_series")


def _two_latest(s: DataFrame) -> DataFrame:
    last2 = top_per_group(s.select("metric", "series", "labels", "ts", "value"), ["metric", "series"],
                          [F.desc("ts"), F.desc("value")], 2, "_r")
    return last2.groupBy("metric", "series").agg(
        F.max_by("labels", "_r").alias("labels"),
        F.max(F.when(F.col("_r") == 1, F.col("value"))).alias("v1"),
        F.max(F.when(F.col("_r") == 1, F.col("ts"))).alias("t1"),
        F.max(F.when(F.col("_r") == 2, F.col("value"))).alias("v0"),
        F.max(F.when(F.col("_r") == 2, F.col("ts"))).alias("t0"),
    )


def irate(samples: DataFrame, metric: str | Sequence[str], as_of: str, lookback: str | int = "5m",
          matchers: Mapping[str, str] | None = None, regex_matchers: Mapping[str, str] | None = None) -> DataFrame:
    """Per-second rate from the last two samples of each series in the lookback; a drop is a counter reset (rate = v1 / dt)."""
    s = select_series(samples, metric, matchers, regex_matchers)
    s = s.where((F.col("ts") > _since(as_of, duration_us(lookback))) & (F.col("ts") <= _asof(as_of)))
    two = _two_latest(s)
    dt = F.timestamp_diff("MICROSECOND", F.col("t0"), F.col("t1")) / F.lit(float(US))
    inc = F.when(F.col("v1") < F.col("v0"), F.col("v1")).otherwise(F.col("v1") - F.col("v0"))
    return two.where(F.col("v0").isNotNull()).select("metric", "series", "labels", F.when(dt > 0, inc / dt).alias("rate"))


def counter_increase(samples: DataFrame, metric: str | Sequence[str], as_of: str, window: str | int = "24h",
                     bucket: str | int = "1h", matchers: Mapping[str, str] | None = None) -> DataFrame:
    """Reset-corrected increase of each counter series over (as_of − window, as_of] (no edge extrapolation).

    Two levels so that one dense series is still split across tasks: within
    each (series, time bucket) the corrected deltas are summed with ``lag``;
    then the buckets of a series (window / bucket of them, a bounded number)
    are chained, adding the corrected delta across each bucket boundary.
    """
    b_us = duration_us(bucket)
    s = select_series(samples, metric, matchers)
    s = s.where((F.col("ts") > _since(as_of, duration_us(window))) & (F.col("ts") <= _asof(as_of)) & Q.not_nan("value"))
    s = s.withColumn("b", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(b_us)).cast("bigint"))
    w = Window.partitionBy("metric", "series", "b").orderBy("ts", "value")
    prev = F.lag("value").over(w)
    s = s.withColumn("d", F.when(prev.isNull(), F.lit(0.0)).when(F.col("value") < prev, F.col("value")).otherwise(F.col("value") - prev))
    per_b = s.groupBy("metric", "series", "b").agg(
        F.sum("d").alias("inside"),
        F.min_by("value", F.struct("ts", "value")).alias("first_v"),
        F.max_by("value", F.struct("ts", "value")).alias("last_v"),
        F.max_by("labels", F.struct("ts", "value")).alias("labels"),
    )
    wb = Window.partitionBy("metric", "series").orderBy("b")
    prev_last = F.lag("last_v").over(wb)
    per_b = per_b.withColumn("edge", F.when(prev_last.isNull(), F.lit(0.0))
                             .when(F.col("first_v") < prev_last, F.col("first_v")).otherwise(F.col("first_v") - prev_last))
    return per_b.groupBy("metric", "series").agg(
        F.max_by("labels", "b").alias("labels"), (F.sum("inside") + F.sum("edge")).alias("increase"))


def topk_nodes(samples: DataFrame, as_of: str, pattern: str = ".*", top: int = 10, lookback: str | int = "5m") -> DataFrame:
    """The ``top`` (1..50) highest load5 among instances fully matching ``pattern`` (optional ``:9100``).

    A pattern with other characters than those of host patterns is an error of the caller.
    """
    positive(top, "top")
    if not re.match(Q.PATTERN_RX, pattern):
        raise ValueError(f"not a host pattern: {pattern!r}")
    v = instant_vector(samples, "node_load5", as_of, lookback, regex_matchers={"instance": f"(?:{pattern})(:9100)?"})
    v = v.select(R.strip_port(F.col("labels")["instance"]).alias("node"), "value", "series")
    return top_per_group(v, [], [F.desc("value"), F.asc("node"), F.asc("series")], top).drop("series")


NODE_GAUGES = ("node_load1", "node_load5", "node_memory_MemTotal_bytes", "node_memory_MemFree_bytes",
               "node_memory_Cached_bytes", "node_memory_Buffers_bytes", "node_boot_time_seconds")
NODE_COUNTERS = ("node_cpu_seconds_total", "node_network_receive_bytes_total", "node_network_transmit_bytes_total")


def node_health(wanted: DataFrame, samples: DataFrame, nodes: DataFrame, as_of: str, lookback: str | int = "5m") -> DataFrame:
    """Load, CPU busy %, memory, network bit rates and uptime of each wanted node, in one conditional-aggregate pass.

    ``status``: ``ok`` (exporter knows the node); ``scheduler_only`` (no
    metrics, but the node table has it: its state is given);
    ``unknown`` (in neither); ``invalid_key``. Missing values stay null.
    """
    g = instant_vector(samples, list(NODE_GAUGES), as_of, lookback).select(
        R.strip_port(F.col("labels")["instance"]).alias("node"), "metric", "value")
    r = irate(samples, list(NODE_COUNTERS), as_of, lookback).select(
        R.strip_port(F.col("labels")["instance"]).alias("node"), "metric", F.col("labels")["mode"].alias("mode"), F.col("rate"))
    gv = g.groupBy("node").agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in NODE_GAUGES])
    rv = r.groupBy("node").agg(
        F.avg(F.when((F.col("metric") == "node_cpu_seconds_total") & (F.col("mode") == "idle"), F.col("rate"))).alias("idle_rate"),
        F.sum(F.when(F.col("metric") == "node_network_receive_bytes_total", F.col("rate"))).alias("rx_rate"),
        F.sum(F.when(F.col("metric") == "node_network_transmit_bytes_total", F.col("rate"))).alias("tx_rate"),
    )
    sched = snapshot_at(nodes, as_of).groupBy("node").agg(F.min("state").alias("sched_state"), F.min("reason").alias("sched_reason"))
    w = wanted.select("node").distinct().withColumn("_valid", Q.valid_name("node"))
    out = w.join(gv, "node", "left").join(rv, "node", "left").join(sched, "node", "left")
    used = F.col("node_memory_MemTotal_bytes") - F.col("node_memory_MemFree_bytes") - (F.col("node_memory_Cached_bytes") + F.col("node_memory_Buffers_bytes"))
    status = (F.when(~F.col("_valid"), "invalid_key").when(F.col("node_load1").isNotNull(), "ok")
              .when(F.col("sched_state").isNotNull(), "scheduler_only").otherwise("unknown"))
    return out.select(
        "node",
        F.col("node_load1").alias("load1"), F.col("node_load5").alias("load5"),
        (100 - F.col("idle_rate") * 100).alias("cpu_busy_pct"),
        F.col("node_memory_MemTotal_bytes").alias("mem_total"), used.alias("mem_used"),
        F.when(F.col("node_memory_MemTotal_bytes") > 0, used / F.col("node_memory_MemTotal_bytes") * 100).alias("mem_pct"),
        (F.col("rx_rate") * 8).alias("net_rx_bits"), (F.col("tx_rate") * 8).alias("net_tx_bits"),
        ((F.unix_micros(_asof(as_of).cast("timestamp")) / F.lit(float(US)) - F.col("node_boot_time_seconds")) / 86400).alias("uptime_days"),
        F.when(F.col("node_load1").isNull(), F.col("sched_state")).alias("sched_state"),
        status.alias("status"),
    )


GPU_GAUGES = {
    "DCGM_FI_DEV_GPU_UTIL": "util",
    "DCGM_FI_DEV_FB_USED": "fb_used_mib",
    "DCGM_FI_DEV_FB_FREE": "fb_free_mib",
    "DCGM_FI_DEV_GPU_TEMP": "temp_c",
    "DCGM_FI_DEV_POWER_USAGE": "power_w",
}


def gpu_host_detail(samples: DataFrame, as_of: str, lookback: str | int = "5m", host_pattern: str | None = None,
                    wanted: DataFrame | None = None) -> DataFrame:
    """Per (host, GPU): utilisation, framebuffer used / total GiB, temperature, power, model.

    Keyed by (host, gpu) — the GPU index alone repeats across hosts. Of ``wanted`` hosts (host), each keeps a row with a
    ``status``: ``ok``; ``no_gpu`` (the host has samples in the lookback, but none of a GPU); ``no_metrics`` (it has
    none at all, which says nothing about its GPUs); ``invalid_key``.
    """
    if wanted is not None:
        wanted = wanted.select("host").distinct()
        valid = Q.valid_name("host")
        own = samples.withColumn("host", R.host_of(F.col("labels"))).join(wanted.where(valid), "host", "left_semi")
        found = gpu_host_detail(own.drop("host"), as_of, lookback, host_pattern)
        seen = own.where((F.col("ts") > _since(as_of, duration_us(lookback))) & (F.col("ts") <= _asof(as_of))).select("host").distinct().withColumn("_seen", F.lit(True))
        quiet = wanted.join(found.select("host").distinct(), "host", "left_anti").join(seen, "host", "left")
        why = F.when(~valid, "invalid_key").when(F.col("_seen"), "no_gpu").otherwise("no_metrics")
        return found.withColumn("status", F.lit("ok")).unionByName(quiet.select("host", why.alias("status")), allowMissingColumns=True)
    v = instant_vector(samples, list(GPU_GAUGES), as_of, lookback)
    v = v.select(R.host_of(F.col("labels")).alias("host"), F.col("labels")["gpu"].alias("gpu"),
                 F.col("labels")["modelName"].alias("model"), "metric", "value")
    if host_pattern:
        v = v.where(F.col("host").rlike(f"^(?:{host_pattern})(\\..*)?$"))
    p = v.groupBy("host", "gpu").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(n) for m, n in GPU_GAUGES.items()],
        F.max("model").alias("model"),
    ).where(F.col("util").isNotNull())
    total = F.coalesce(F.col("fb_used_mib"), F.lit(0.0)) + F.coalesce(F.col("fb_free_mib"), F.lit(0.0))
    return p.select(
        "host", "gpu", "util",
        (F.col("fb_used_mib") / 1024).alias("fb_used_gib"),
        F.when(F.col("fb_used_mib").isNotNull() & (total > 0), total / 1024).alias("fb_total_gib"),
        "temp_c", "power_w", "model",
        F.row_number().over(Window.partitionBy("host").orderBy(F.col("gpu").try_cast("int").asc_nulls_last(), F.asc("gpu"))).cast("bigint").alias("gpu_order"),
    )


def gpu_overview(samples: DataFrame, as_of: str, lookback: str | int = "5m", top: int = 10) -> DataFrame:
    """Fleet view of GPU utilisation, with fleet totals on every row.

    Rows: the ``top`` hosts by mean utilisation (``busy_rank``) and every
    host with an idle GPU (< 5 %), each with its GPU count, mean and idle GPUs.

    Fleet columns: GPUs, hosts, mean utilisation, busy (> 80) and idle (< 5) GPU counts.
    """
    positive(top, "top")
    v = instant_vector(samples, "DCGM_FI_DEV_GPU_UTIL", as_of, lookback).where(Q.not_nan("value"))
    v = v.select(R.host_of(F.col("labels")).alias("host"), "value")
    per_host = v.groupBy("host").agg(F.count(F.lit(1)).alias("gpus"), F.avg("value").alias("mean_util"),
                                     F.count_if(F.col("value") < 5).alias("idle_gpus"))
    fleet = v.agg(F.count(F.lit(1)).alias("fleet_gpus"), F.avg("value").alias("fleet_mean_util"),
                  F.count_if(F.col("value") > 80).alias("fleet_busy"), F.count_if(F.col("value") < 5).alias("fleet_idle"))
    hosts = per_host.agg(F.count(F.lit(1)).alias("fleet_hosts"))
    ranks = top_per_group(per_host.select("host", "mean_util"), [], [F.desc("mean_util"), F.asc("host")], top, "busy_rank").drop("mean_util")
    ranked = per_host.join(ranks, "host", "left").where(F.col("busy_rank").isNotNull() | (F.col("idle_gpus") > 0))
    return attach_row(attach_row(ranked, fleet), hosts)


def gpu_errors(samples: DataFrame, as_of: str, window: str = "24h", top: int = 10) -> DataFrame:
    """GPUs whose XID error counter increased over the window, largest first (``top``), with the exact count."""
    inc = counter_increase(samples, "DCGM_FI_DEV_XID_ERRORS", as_of, window).where(F.col("increase") > 0)
    inc = inc.select(R.host_of(F.col("labels")).alias("host"), F.col("labels")["gpu"].alias("gpu"), "increase", "series")
    return with_total(top_per_group(inc, [], [F.desc("increase"), F.asc("series")], top), inc, (), "n_gpus").drop("series")
