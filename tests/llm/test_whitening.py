"""Whitening against a local computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterlens.llm import queries, whitening

RESULT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(vectors, most):
    """n, deviations, whitened coordinates up to sign, shares."""
    x = np.array(vectors, dtype=object)
    fit = np.array(sorted({tuple(v) for v in vectors}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s).astype(np.float64) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1], found[:, ::-1]
    m = min(most, int((values > 1e-10 * values[0]).sum()))
    white = ((n * x - s).astype(np.float64) / n) @ found[:, :m] / np.sqrt(values[:m])
    return n, ((n * x - s) ** 2).sum(axis=1), white, (values / values.sum())[:m]


def check(rows, got, most):
    n, deviation, white, shares = brute([v for _, v in rows], most)
    by_row = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9 and abs(r["explained"] - shares[r["component"] - 1]) < 1e-9
        by_row.setdefault((r["vec_id"], int(r["deviation"])), {}).setdefault(r["component"], []).append(r["whitened"])
    assert len(got) == len(rows) * len(shares)
    table = {k: [v[c + 1][0] for c in range(len(shares))] for k, v in by_row.items()}
    assert all(max(x) - min(x) < 1e-9 for v in by_row.values() for x in v.values())  # copies agree
    own = np.array([table[(i, int(d))] for (i, _), d in zip(rows, deviation, strict=True)])
    signs = np.sign((own * white).sum(axis=0))
    assert np.abs(own * signs - white).max() < 1e-7


@pytest.mark.parametrize("n, d, most", [(400, 20, 16), (90, 5, 16), (300, 3, 2)])
def test_against_a_local_computation(spark, n, d, most):
    rng = np.random.default_rng(n)
    x = (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 50 + 1_000_000).astype(int).tolist()
    rows = [(k, v) for k, v in enumerate(x)] + [(n + k, x[0]) for k in range(n // 2)]  # one vector holds a third of all rows
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "vec_id long, vector array<bigint>, projected string, `index` int").repartition(5)
    got = whitening.whiten(df, most)
    assert got.columns == RESULT
    check(rows, got.collect(), most)


def test_odd_rows(spark):
    rows = [(1, [1, 2, 3]), (2, [1, 2, 4]), (2, [5, 2, 4]), (None, [7, 2, 0]), (3, [1, 2, 3])]
    odd = [(10, None), (11, []), (12, [1, None, 3]), (13, [1, 2]), (14, [3, 4]), (15, [1, 2, 3, 4])]
    df = spark.createDataFrame(rows + odd, "vec_id long, vector array<bigint>")
    check([(i if i is not None else None, v) for i, v in rows], whitening.whiten(df, 16).collect(), 16)  # the second dimension has no spread
    schema = df.schema
    for few in ([], [(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(few, schema)).collect() == []


def test_many_blocks_agree_with_few(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(k, v) for k, v in enumerate(rng.integers(-500, 500, (200, 4)).tolist())]
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 3)
    check(rows, whitening.whiten(spark.createDataFrame(rows, "vec_id long, vector array<bigint>")).collect(), 16)


def test_query_on_the_given_table(spark):
    got = queries.QUERIES["op12_embedding_whitening"](spark, "/root/testdata/sf0.001")
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r["vec_id"], [int(np.floor(64 * float(x))) + 1_000_000 for x in r["embedding"]]) for r in table]
    check(rows, got.collect(), 16)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert got.groupBy("component").agg(F.avg("whitened").alias("m")).where("abs(m) > 1e-9").count() == 0
