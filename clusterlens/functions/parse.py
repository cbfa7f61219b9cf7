"""Typed values out of scheduler text, as Column expressions.

Every function takes and returns a ``Column`` and uses only built-in
Spark functions, so it stays inside whole-stage codegen. ANSI mode is on
in Spark 4: all casts of free text go through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_or_lit


def _try_int(c: Column) -> Column:
    """Integer of a text like Python's ``int()``: optional sign, ASCII digits, spaces around."""
    t = F.trim(c)
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("bigint"))


def duration_seconds(c) -> Column:
    """``[D-]HH:MM:SS(.f)`` and shorter forms → seconds (DOUBLE).

    Empty, ``INVALID`` and ``Unknown`` give null, as does any part that is
    not a number. Parts are folded base 60, so ``1-02:03`` = 86,400 + 123.
    """
    s = col_or_lit(c)
    has_days = F.instr(s, "-") > 0
    days = F.when(has_days, _try_int(F.substring_index(s, "-", 1))).otherwise(F.lit(0))
    rest = F.when(has_days, F.substring(s, F.instr(s, "-") + 1, 1 << 30)).otherwise(s)
    parts = F.transform(F.split(rest, ":"), lambda p: F.when(F.trim(p).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), F.trim(p).try_cast("double")))
    folded = F.aggregate(parts, F.lit(0.0).cast("double"), lambda acc, p: acc * 60 + p)
    bad = s.isNull() | (s == "") | s.isin("INVALID", "Unknown")
    return F.when(bad, F.lit(None).cast("double")).otherwise(days.cast("double") * 86400 + folded)


# Binary multipliers of a memory unit letter.
MEM_UNITS = {"K": 1024, "M": 1024**2, "G": 1024**3, "T": 1024**4}


def mem_bytes(c) -> Column:
    """``3971344K`` / ``16G`` / ``16Gn`` / ``4000Mc`` → struct(bytes DOUBLE, mode STRING).

    Trailing ``n``/``c`` is the per-node / per-CPU mode; K/M/G/T in any case
    are 1024-based; no unit means bytes. Empty, ``0``, ``INVALID``,
    ``Unknown`` and unreadable numbers give null.
    """
    s = F.trim(col_or_lit(c))
    rx = r"^(.*?)([KMGTkmgt]?)([nc]?)$"
    unit = F.upper(F.regexp_extract(s, rx, 2))
    num_txt = F.regexp_extract(s, rx, 1)
    num = F.when(num_txt.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), num_txt.try_cast("double"))
    mult = F.coalesce(*[F.when(unit == k, F.lit(float(v))) for k, v in MEM_UNITS.items()], F.lit(1.0))
    bad = s.isNull() | s.isin("", "0", "INVALID", "Unknown") | num.isNull()
    return F.when(~bad, F.struct((num * mult).alias("bytes"), F.regexp_extract(s, rx, 3).alias("mode")))


# GB per unit letter of ``mem=`` in a TRES string (no unit = MB).
TRES_MEM_GB = {"K": 1 / 1024**2, "M": 1 / 1024, "G": 1.0, "T": 1024.0, "": 1 / 1024}


def tres_mem_gb(c) -> Column:
    """GB of ``mem=<n>[KMGT]`` in a TRES string; no unit means MB. Null if absent."""
    s = col_or_lit(c)
    num = F.regexp_extract(s, r"mem=([0-9.]+)([KMGT]?)", 1)
    unit = F.regexp_extract(s, r"mem=([0-9.]+)([KMGT]?)", 2)
    mult = F.coalesce(*[F.when(unit == k, F.lit(v)) for k, v in TRES_MEM_GB.items()])
    return F.when(num != "", num.try_cast("double") * mult)


def tres_cpu(c, anchored: bool = True) -> Column:
    """CPUs of ``cpu=<n>``; anchored form requires start or a comma before it."""
    pattern = r"(?:^|,)cpu=([0-9]+)" if anchored else r"cpu=([0-9]+)"
    v = F.regexp_extract(col_or_lit(c), pattern, 1)
    return F.when(v != "", v.try_cast("bigint"))


def tres_gpu(c) -> Column:
    """GPUs of the untyped ``gres/gpu=<n>`` token, up to the next comma; null if absent or unreadable."""
    s = col_or_lit(c)
    v = F.regexp_extract(s, r"gres/gpu=([^,]*)", 1)
    return F.when(s.contains("gres/gpu="), _try_int(v))


def array_task_count(c) -> Column:
    """Tasks of a pending array id ``123_[1-100%4]`` → 100; plain id → 1.

    The ``%limit`` is dropped; a range ``a-b`` counts b-a+1, a single index 1;
    a range that does not parse counts 1 (so ``1-100:2`` is 1); minimum 1.
    """
    s = col_or_lit(c)
    rx = r"_\[([^\]]+)\]"
    inner = F.substring_index(F.regexp_extract(s, rx, 1), "%", 1)

    def one(p: Column) -> Column:
        t = F.trim(p)
        ends = F.split(t, "-")
        rng = F.when(F.size(ends) == 2, _try_int(F.element_at(ends, 2)) - _try_int(F.element_at(ends, 1)) + 1)
        return (F.when(F.instr(t, "-") > 0, F.coalesce(rng, F.lit(1)))
                .when(t.rlike("^[0-9]+$"), F.lit(1))
                .otherwise(F.lit(0))).cast("bigint")

    total = F.aggregate(F.split(inner, ","), F.lit(0).cast("bigint"), lambda acc, p: acc + one(p))
    return F.when(s.rlike(rx), F.greatest(total, F.lit(1).cast("bigint"))).otherwise(F.lit(1).cast("bigint"))


def first_state(c) -> Column:
    """First whitespace token of a state (``CANCELLED by 12`` → ``CANCELLED``); blank → ``?``."""
    return F.coalesce(F.nullif(F.regexp_extract(col_or_lit(c), r"^\s*(\S+)", 1), F.lit("")), F.lit("?"))


def reason_token(c) -> Column:
    """First word before the first comma of a pending reason; blank → ``None``."""
    head = F.substring_index(col_or_lit(c), ",", 1)
    return F.coalesce(F.nullif(F.regexp_extract(head, r"^\s*(\S+)", 1), F.lit("")), F.lit("None"))


def norm_job_name(c) -> Column:
    """Job name for clustering: empty → ``?``, ASCII digit runs → ``#``, then 48 chars."""
    name = F.coalesce(F.nullif(col_or_lit(c), F.lit("")), F.lit("?"))
    return F.substring(F.regexp_replace(name, "[0-9]+", "#"), 1, 48)


def base_job_id(c) -> Column:
    """Job id without array index and step: ``123_4.batch`` → ``123``."""
    return F.substring_index(F.substring_index(col_or_lit(c), "_", 1), ".", 1)


def array_part(c) -> Column:
    """Array part of a job id: ``123_4.batch`` → ``4``, ``123_[1-9%2]`` → ``[1-9%2]``; null without one."""
    return F.nullif(F.regexp_extract(F.substring_index(col_or_lit(c), ".", 1), r"^[^_]*_(.*)$", 1), F.lit(""))


def holds_task(part, task) -> Column:
    """Whether the pending array part ``[1,3,5-9:2%4]`` holds the task number ``task``."""
    inner = F.substring_index(F.regexp_extract(col_or_lit(part), r"^\[([^\]]*)\]", 1), "%", 1)
    n = _try_int(col_or_lit(task))

    def one(p: Column) -> Column:
        ends = F.substring_index(p, ":", 1)
        lo, hi = _try_int(F.substring_index(ends, "-", 1)), _try_int(F.substring_index(ends, "-", -1))
        step = F.when(F.instr(p, ":") > 0, _try_int(F.substring_index(p, ":", -1)))
        return F.coalesce((n >= lo) & (n <= hi) & ((n - lo) % F.greatest(step, F.lit(1)) == 0), F.lit(False))

    return F.exists(F.split(inner, ","), one)


def step_base_id(c) -> Column:
    """Id of the job a step row belongs to: text before the first ``.``."""
    return F.substring_index(col_or_lit(c), ".", 1)


def limit_minutes(c) -> Column:
    """Time limit in minutes when the text is all ASCII digits, else null."""
    s = col_or_lit(c)
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("bigint"))


def host_list(c) -> Column:
    """Expand a host list ``a[001-003,007],b1,r[1-2]n[08-10]`` → array of hosts.

    Each comma-separated item may hold any number of bracket groups; they are
    multiplied out, the last one running fastest. Zero padding of a range's
    lower bound is kept; a range without two numbers is taken as it is. An
    item without brackets is itself.
    """
    s = col_or_lit(c)
    items = F.split(s, r",(?![^\[]*\])")

    def part(p: Column) -> Column:
        lo, hi = F.substring_index(p, "-", 1), F.substring_index(p, "-", -1)
        padded = lambda i: F.lpad(i.cast("string"), F.greatest(F.length(lo), F.length(i.cast("string"))), F.lit("0"))
        return F.when(p.rlike("^[0-9]+-[0-9]+$"), F.transform(F.sequence(lo.try_cast("bigint"), hi.try_cast("bigint")), padded)).otherwise(F.array(p))

    def choices(segment: Column) -> Column:
        inner = F.regexp_extract(segment, r"^\[([^\]]*)\]$", 1)
        return F.when(segment.startswith("["), F.flatten(F.transform(F.split(inner, ","), part))).otherwise(F.array(segment))

    def expand(item: Column) -> Column:
        segments = F.regexp_extract_all(item, F.lit(r"\[[^\]]*\]|[^\[]+"), F.lit(0))
        return F.aggregate(segments, F.array(F.lit("")), lambda done, segment: F.flatten(
            F.transform(done, lambda d: F.transform(choices(segment), lambda x: F.concat(d, x)))))

    return F.when(s.isNull() | (F.trim(s) == ""), F.array().cast("array<string>")).otherwise(
        F.filter(F.flatten(F.transform(items, expand)), lambda h: h != "")
    )


def age_hours(ts, as_of) -> Column:
    """Hours from ``ts`` to ``as_of`` (both TIMESTAMP_NTZ); null when ts is null."""
    return F.timestamp_diff("MICROSECOND", col_or_lit(ts), col_or_lit(as_of)) / F.lit(3.6e9)
