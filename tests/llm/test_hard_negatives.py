"""Hard negatives against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clusterlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, vector array<bigint>, rid long, score int, part string"
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchor, k_pos=5, k_neg=5, low=80, high=100):
    rows = [(i, l, v) for i, l, v, *_ in rows if l is not None and v is not None and None not in v]
    order = lambda s: (-s[1], rows[s[0]][0] is None, rows[s[0]][0] or 0)
    out = []
    for a, (i, label, v) in enumerate(rows):
        if i is None or not anchor(i):
            continue
        scores = [(b, sum(x * y for x, y in zip(v, w, strict=True))) for b, (_, _, w) in enumerate(rows) if b != a and len(w) == len(v)]
        for p, ps in sorted((s for s in scores if rows[s[0]][1] == label), key=order)[:k_pos]:
            fit = sorted((s for s in scores if rows[s[0]][1] != label and low * ps <= 100 * s[1] <= high * ps), key=order)[:k_neg]
            out += [(i, rows[p][0], r, rows[n][0], ps, ns) for r, (n, ns) in enumerate(fit, 1)]
    return sorted(out, key=str)


def found(spark, rows, anchor, **options):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3)
    got = hn.hard_negatives(df, anchor, **options)
    assert got.columns == RESULT
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(rng, n, dim, spread=1.0, scale=200):
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] * 2 + rng.normal(size=(n, dim))
    return np.floor(x * scale * np.exp(spread * rng.normal(size=(n, 1)))).astype(int).tolist()


@pytest.mark.parametrize("spread, low, high", [(0.0, 80, 100), (1.0, 80, 100), (0.6, 33, 95)])
def test_against_brute_force(spark, spread, low, high):
    rng = np.random.default_rng(int(spread * 10))
    rows = [(k, int(rng.integers(0, 4)), v) for k, v in enumerate(vectors(rng, 700, 8, spread))]
    rows += [(1000 + k, 0, rows[5][2]) for k in range(60)] + [(2000 + k, 1, rows[5][2]) for k in range(60)]  # ties
    assert found(spark, rows, F.col("vec_id") % 20 == 0, low=low, high=high) == brute(rows, lambda i: i % 20 == 0, low=low, high=high)


def test_odd_rows(spark):
    rows = [
        (0, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [3, 3]), (2, 2, [3, 3]), (3, 2, [0, 0]), (4, 1, [0, 0]), (None, 1, [2, 5]), (None, 2, [3, 4]), (5, None, [3, 4]), (6, 2, None), (7, 2, [3, None]),
        (10, 1, [1, 2, 3]), (11, 2, [1, 2, 2]), (20, 3, [5, 5]), (30, 1, []), (31, 2, []), (32, 1, []), (40, 1, [-3, -4]), (50, 1, [1 << 29, 1 << 29]), (51, 1, [1 << 29, (1 << 29) - 1]), (52, 2, [1 << 29, (1 << 29) - 3]), (60, 2, [3, 3]), (60, 2, [3, 3]),
    ]
    assert found(spark, rows, F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)
    assert found(spark, rows, F.lit(False)) == [] and found(spark, rows[:0], F.lit(True)) == []
    assert found(spark, rows, F.col("vec_id") % 10 == 0, n_positives=1, n_negatives=2) == brute(rows, lambda i: i % 10 == 0, 1, 2)


def block(rng, n, dim, spread, bounds=None, lists=True, targets=None):
    x = rng.normal(size=(n, dim))
    x = np.floor(1000 * np.exp(spread * rng.normal(size=(n, 1))) * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    rows = {"vectors": x, "len2": (x * x).sum(axis=1), "rid": np.arange(n) + (0 if lists else 1 << 20), "ids": np.arange(n), "nulls": np.zeros(n, bool), "label": rng.integers(0, 3, n), "bounds": np.full(n, hn.NONE) if bounds is None else bounds}
    return hn.Block(pa.Table.from_batches([hn._packed_row(rows, dim, 0, 0, lists, targets or [[]] * n)]).to_pylist()[0])


def test_pruning_keeps_every_row_that_reaches_the_bound_and_excludes_others():
    rng = np.random.default_rng(2)
    rows = block(rng, 3000, 4, 0.02)
    plain = block(rng, 200, 4, 0.02, lists=False)
    scores = plain.vectors.astype(np.int64) @ rows.vectors.astype(np.int64).T
    bounds = np.sort(scores, axis=1)[:, -8]
    anchors = hn.Block({**{c: getattr(plain, c) for c in ("dim", "n", "top", "targets")}, "rids": plain.rid.tobytes(), "ids": plain.ids.tobytes(), "nulls": plain.nulls.tobytes(), "labels": plain.label.tobytes(), "bounds": bounds.tobytes(), "kind": plain.vectors.dtype.str, "vectors": plain.vectors.tobytes(), "lists": b""})
    few, everything = hn.candidates(anchors, rows)
    assert len(few) > 100, len(few)
    assert sum(map(len, few.values())) < 0.1 * len(few) * rows.n  # the ranges do exclude
    for a, at in few.items():
        assert set(np.flatnonzero(scores[a] >= bounds[a])) <= set(at.tolist())
    left_out = set(range(anchors.n)) - set(few) - set(everything.tolist())
    assert all((scores[a] < bounds[a]).all() for a in left_out)


def test_buckets_end_where_vectors_get_short(spark):
    rows = [(k, 1, [k + 1, 0]) for k in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<bigint>").selectExpr("vec_id rid", "vec_id", "bigint(label) label", "0L part", "vector", "2 dim", "vector[0] * vector[0] len2", "cast(null as bigint) bound", "cast(null as array<bigint>) targets").coalesce(1)
    from clusterlens.llm.common import ship

    ship(spark)
    buckets = hn._pack(df, 1 << 10, True).select("n", "top").collect()
    assert sum(r["n"] for r in buckets) == 2000 and len(buckets) > 3 and max(r["n"] for r in buckets) <= 1 << 10
