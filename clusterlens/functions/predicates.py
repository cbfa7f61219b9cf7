"""Boolean Column predicates: key validation, confinement, state classes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_or_lit

# Allowed characters of names, label regexes and index patterns.
NAME_RX = r"^[A-Za-z0-9._-]+$"
PATTERN_RX = r"^[A-Za-z0-9_.*+?|:^$()\[\]-]+$"
INDEX_RX = r"^[a-z0-9_.*,-]+$"

# Final states that count as a failure, matched as prefixes in this order.
BAD_STATES = ("FAILED", "TIMEOUT", "OUT_OF_MEMORY", "NODE_FAIL")

# Node-list texts that mean "no node".
NO_NODE_TEXTS = ("", "None assigned", "Unknown", "(null)")


def _nonempty_match(c, rx: str) -> Column:
    s = col_or_lit(c)
    return F.coalesce(s.rlike(rx), F.lit(False))


def valid_name(c) -> Column:
    return _nonempty_match(c, NAME_RX)


def valid_pattern(c) -> Column:
    return _nonempty_match(c, PATTERN_RX)


def valid_index(c) -> Column:
    return _nonempty_match(c, INDEX_RX)


def valid_job_id(c) -> Column:
    """ASCII letters and digits once ``_`` and ``.`` are removed."""
    return _nonempty_match(F.translate(col_or_lit(c), "_.", ""), r"^[A-Za-z0-9]+$")


def glob_to_regex(pattern: str) -> str:
    """Case-sensitive shell glob (``* ? [..]``) → anchored Java regex (done once on the driver)."""
    out, i, n = [], 0, len(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = pattern.find("]", i + 2 if i + 1 < n and pattern[i + 1] in "!^" else i + 1)
            if j == -1:
                out.append(r"\[")
            else:
                body = pattern[i + 1:j]
                neg = body[:1] in ("!", "^")
                body = body[1:] if neg else body
                body = body.replace("\\", r"\\").replace("[", r"\[")
                out.append("[" + ("^" if neg else "") + body + "]")
                i = j
        else:
            out.append(re.escape(ch))
        i += 1
    return "^(?:" + "".join(out) + ")$"


def index_glob(c, pattern: str) -> Column:
    """Index name matches a comma list of globs (any of them)."""
    parts = [p.strip() for p in pattern.split(",") if p.strip()] or ["*"]
    s = col_or_lit(c)
    out = F.lit(False)
    for p in parts:
        out = out | s.rlike(glob_to_regex(p))
    return out


def index_allowed(c, allowed: Sequence[str] | None) -> Column:
    """Index name matches one of the allowed globs; an empty list allows all."""
    if not allowed:
        return F.lit(True)
    s = col_or_lit(c)
    out = F.lit(False)
    for p in allowed:
        out = out | s.rlike(glob_to_regex(p))
    return out


def request_allowed(pattern: str, allowed: Sequence[str] | None) -> bool:
    """A requested comma list passes only if *every* part is allowed (driver-side check of a parameter)."""
    if not allowed:
        return True
    parts = [p.strip() for p in pattern.split(",") if p.strip()]
    return bool(parts) and all(any(re.match(glob_to_regex(a), p) for a in allowed) for p in parts)


def index_refusal(pattern: str, allowed: Sequence[str] | None) -> str | None:
    """Why a requested comma list of indices is refused: ``invalid_index``, ``not_allowed``, or None (it is not)."""
    if not re.match(INDEX_RX, pattern or ""):
        return "invalid_index"
    return None if request_allowed(pattern, allowed) else "not_allowed"


def normalize_path(c) -> Column:
    """Lexical normalisation of an absolute path: ``.`` and empty parts dropped, ``..`` folded."""
    parts = F.split(col_or_lit(c), "/")
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when((p == "") | (p == "."), acc)
        .when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))),
    )
    return F.concat(F.lit("/"), F.array_join(folded, "/"))


def path_under_roots(c, roots: Sequence[str] = ("/work",)) -> Column:
    """Absolute path that, once normalised, is a root or lies below ``root + '/'``."""
    s = col_or_lit(c)
    norm = normalize_path(s)
    inside = F.lit(False)
    for r in roots:
        r = r.rstrip("/")
        inside = inside | (norm == F.lit(r)) | norm.startswith(r + "/")
    return F.coalesce(s.startswith("/") & inside, F.lit(False))


def bad_state_key(state) -> Column:
    """The failure class a state starts with, else null."""
    rx = "^(" + "|".join(BAD_STATES) + ")"
    return F.nullif(F.regexp_extract(F.coalesce(col_or_lit(state), F.lit("")), rx, 1), F.lit(""))


def is_bad_state(state) -> Column:
    return bad_state_key(state).isNotNull()


def is_interactive(batch_flag=None, partition=None, interactive_partitions: Sequence[str] = ("visu",)) -> Column:
    """Batch flag 0 (no script), or a partition of the interactive list."""
    out = F.lit(False)
    if batch_flag is not None:
        out = out | F.coalesce(col_or_lit(batch_flag) == 0, F.lit(False))
    if partition is not None and interactive_partitions:
        out = out | F.coalesce(col_or_lit(partition).isin(*interactive_partitions), F.lit(False))
    return out


def has_gpu(tres) -> Column:
    return F.coalesce(col_or_lit(tres).contains("gres/gpu="), F.lit(False))


def not_nan(value) -> Column:
    v = col_or_lit(value)
    return v.isNotNull() & ~F.isnan(v)


def nodelist_known(c) -> Column:
    s = col_or_lit(c)
    return s.isNotNull() & ~F.trim(s).isin(*NO_NODE_TEXTS)


def opt_equals(**filters) -> Column:
    """Conjunction of ``col == value`` for every non-empty value; no filter = true."""
    out = F.lit(True)
    for name, value in filters.items():
        if value not in (None, ""):
            out = out & (F.col(name) == F.lit(value))
    return out


def lookback_start(as_of: str, days: float = 0, hours: float = 0, minutes: float = 0) -> Column:
    """``as_of`` minus a span, as a TIMESTAMP_NTZ literal expression."""
    micros = int(round(((days * 24 + hours) * 60 + minutes) * 60 * 1_000_000))
    return F.expr(f"timestampadd(MICROSECOND, {-micros}, to_timestamp_ntz('{as_of}'))")


def job_in_window(end_ts, start: Column) -> Column:
    """Accounting window: jobs still running (no end) or ended at/after the start."""
    e = col_or_lit(end_ts)
    return e.isNull() | (e >= start)
