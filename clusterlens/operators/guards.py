"""Result guards shared by all operators.

* ``with_total``: a limited listing always carries the exact total of the
  rows it was cut from, computed by a separate aggregate — per group a
  grouped count joined on the group key, globally a scalar subquery (never
  ``count(*) over ()``, which funnels every row through one task).
* ``guard_keys``: one row per requested key with a ``status`` saying why a
  result is empty (``ok``, ``empty``, ``unknown_key``, ``invalid_key``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Top ``n`` rows per group (``by`` empty = global).

    Per group: ``row_number() <= n``, which Spark plans as a
    ``WindowGroupLimit`` on both sides of the shuffle, so a hot group ships
    at most ``n`` rows per map task. Globally: ``orderBy.limit``
    (``TakeOrderedAndProject``), plus the rank as a column.
    """
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    if by:
        # filter on the raw row_number (so Spark infers the group limit), then widen to BIGINT
        ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
        return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))
    limited = df.orderBy(*order).limit(n)
    # n rows at most: the global window below runs on the limited rows only.
    return limited.withColumn(rank_col, F.row_number().over(w).cast("bigint"))


def with_total(limited: DataFrame, full: DataFrame, by: Sequence[str] = (), total_col: str = "total") -> DataFrame:
    """Attach the exact row count of ``full`` (per ``by`` group) to ``limited``."""
    if by:
        totals = full.groupBy(*by).agg(F.count(F.lit(1)).alias(total_col))
        return limited.join(totals, list(by), "left")
    return limited.withColumn(total_col, full.agg(F.count(F.lit(1))).scalar())


def with_status(limited: DataFrame, full: DataFrame, empty: str = "no_match") -> DataFrame:
    """``limited`` with the exact ``total`` of ``full`` and ``status = ok``; without any row, one row of ``total = 0`` saying so."""
    total = full.agg(F.count(F.lit(1)).alias("total"))
    none = total.where("total = 0").withColumn("status", F.lit(empty))
    return with_total(limited, full).withColumn("status", F.lit("ok")).unionByName(none, allowMissingColumns=True)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row global aggregate (a total) to every row of ``df``.

    Each value is a scalar subquery (``DataFrame.scalar()``): computed once
    by its own partial/final aggregate and inlined as a constant — no join,
    no pairs. Spark merges the scalar subqueries over the same input.
    """
    for c in one_row.columns:
        df = df.withColumn(c, one_row.select(c).scalar())
    return df


def positive(n: int, name: str) -> int:
    """``n`` as it is; a limit below 1 is an error of the caller."""
    if n < 1:
        raise ValueError(f"{name} must be at least 1, not {n}")
    return n


def keys_frame(spark, name: str, keys: Sequence[str]) -> DataFrame:
    """Requested keys as a one-column DataFrame (parameters, not data)."""
    return spark.createDataFrame([(k,) for k in keys], f"{name} string")


def guard_keys(
    requested: DataFrame,
    key: str,
    known: DataFrame,
    result: DataFrame,
    valid=None,
    result_key: str | None = None,
) -> DataFrame:
    """Left-join requested keys to known keys and to the result rows.

    Every requested key keeps at least one row; ``status`` is
    ``invalid_key`` (fails ``valid``, a function of the key column), ``unknown_key`` (not in ``known``),
    ``empty`` (known, no result row) or ``ok``.
    """
    result_key = result_key or key
    kn = known.select(F.col(key).alias("__k")).distinct().withColumn("__known", F.lit(True))
    res = result.withColumnRenamed(result_key, "__rk").withColumn("__hit", F.lit(True))
    r = requested.select(F.col(key).alias("__req")).distinct()
    valid_col = F.lit(True) if valid is None else valid(F.col("__req"))
    out = (
        r.withColumn("__valid", F.coalesce(valid_col, F.lit(False)))
        .join(kn, F.col("__req") == F.col("__k"), "left")
        .join(res, (F.col("__req") == F.col("__rk")) & F.col("__valid") & F.col("__known").isNotNull(), "left")
    )
    status = (
        F.when(~F.col("__valid"), "invalid_key")
        .when(F.col("__known").isNull(), "unknown_key")
        .when(F.col("__hit").isNull(), "empty")
        .otherwise("ok")
    )
    return out.withColumn("status", status).withColumnRenamed("__req", key).drop("__k", "__known", "__rk", "__hit", "__valid")


def left_join_split(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left`` LEFT OUTER JOIN ``right`` written as inner join ∪ anti join.

    Same rows as the left outer join, but the big, possibly skewed side
    (``right``: one key may hold a third of its rows) goes through an inner
    join, where AQE may split a skewed partition on either side or broadcast
    the small left side; the unmatched left rows come from an anti join
    against the *distinct* right keys, which are pre-aggregated map-side.
    """
    on = list(on)
    hits = left.join(right, on, "inner")
    miss = left.join(right.select(*on).distinct(), on, "left_anti")
    return hits.unionByName(miss, allowMissingColumns=True)
