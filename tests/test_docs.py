"""Lenient predicates, index scopes and the field catalogue on awkward documents."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clusterlens.operators import docs as D

ROWS = [
    (1, "logs-a", "abc", 5, True, dt.datetime(2024, 1, 1), [1, 2], '{"k": 1, "s": "5", "n": {"x y": 2}}', (7, "u")),
    (2, "logs-b", "5", None, False, dt.datetime(2024, 1, 2), [], '{"k": "x"}', (8, None)),
    (3, "logs-b", None, -3, None, None, None, "no json", None),
]
SCHEMA = "doc_id long, idx string, level string, value long, flag boolean, ts timestamp_ntz, tags array<int>, props string, st struct<a: int, b: string>"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.mark.parametrize(
    "tree, ids",
    [
        ({"field": "level", "eq": 5}, [2]), ({"field": "level", "eq": "abc"}, [1]), ({"field": "level", "like": "a*"}, [1]), ({"field": "value", "like": "5"}, []),
        ({"field": "value", "eq": "abc"}, []), ({"field": "value", "eq": "5"}, [1]), ({"field": "value", "lt": 4.5}, [3]), ({"field": "value", "ge": " 4.5 "}, [1]), ({"field": "value", "eq": True}, []),
        ({"field": "flag", "eq": "TRUE"}, [1]), ({"field": "flag", "eq": 1}, []), ({"field": "ts", "ge": "2024-01-02"}, [2]), ({"field": "ts", "ge": "soon"}, []), ({"field": "ts", "lt": dt.date(2024, 1, 2)}, [1]),
        ({"field": "tags", "eq": 2}, [1]), ({"field": "tags", "eq": "x"}, []), ({"field": "st.a", "gt": 7}, [2]), ({"field": "st.b", "eq": "u"}, [1]), ({"field": "st.c", "eq": "u"}, []), ({"field": "st", "eq": 1}, []),
        ({"field": "props.k", "eq": 1}, [1]), ({"field": "props.k", "eq": "x"}, [2]), ({"field": "props.n.x y", "ge": 2}, [1]), ({"field": "props.s", "in": [5, 6]}, [1]), ({"field": "level", "in": []}, []),
        ({"not": {"field": "level", "eq": 5}}, [1, 3]), ({"field": "nothing", "exists": False}, [1, 2, 3]), ({"field": "tags", "exists": True}, [1, 2]), ({"all": []}, [1, 2, 3]), ({"any": []}, []),
        ({"any": [{"field": "value", "eq": "?"}, {"all": [{"field": "level", "eq": 5}, {"field": "flag", "eq": False}]}]}, [2]),
    ],
)
def test_lenient_predicates(docs, tree, ids):
    assert sorted(r["doc_id"] for r in docs.where(D.lenient(docs, tree)).collect()) == ids


def test_unknown_comparisons_are_refused(docs):
    with pytest.raises(ValueError, match="unknown comparison"):
        D.lenient(docs, {"field": "level", "regex": "x"})


def test_statuses_of_index_scopes(docs):
    def status(index, allowed=None, tree=None):
        return {r["status"] for r in D.doc_search(docs, tree, index=index, allowed=allowed).collect()}

    assert status("logs-*") == {"ok"} and status("logs-a,audit", ["logs-*"]) == {"not_allowed"} and status("Logs") == {"invalid_index"} and status("") == {"invalid_index"}
    assert status("audit") == {"unknown_index"} and status("logs-a", tree={"field": "level", "eq": "none"}) == {"no_match"}
    got = D.doc_search(docs, allowed=["logs-b"], index=None).collect()
    assert {r["idx"] for r in got} == {"logs-b"} and {r["total"] for r in got} == {2}
    assert {r["status"] for r in D.terms_agg(docs, "level", index="audit").collect()} == {"unknown_index"}
    assert {r["status"] for r in D.recent_docs(docs, "2024-01-03 00:00:00", 10_000, index="logs-b,x", allowed=["logs-?"]).collect()} == {"not_allowed"}


def test_scopes_prune_partitions(spark, docs, tmp_path):
    docs.drop("tags", "st").write.partitionBy("idx").parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    for found in (D.doc_search(stored, {"field": "value", "ge": 1}, index="logs-a", allowed=["logs-*"]), D.terms_agg(stored, "level", index="logs-a"), D.recent_docs(stored, "2024-01-03 00:00:00", index="logs-a")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        assert scans and all("PartitionFilters: [isnotnull(idx" in s or "PartitionFilters: [RLIKE" in s or "RLIKE" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in scans)
    assert "GreaterThanOrEqual(value,1)" in D.doc_search(stored, {"field": "value", "ge": "1"}, index="logs-a")._jdf.queryExecution().executedPlan().toString()


def test_field_catalog_walks_everything(spark):
    deep = {"x": 1}
    for _ in range(25):
        deep = {"d": deep}
    texts = ['{"a:b":1,"a.c":[{"k":1},{"k":null,"l":[]},{"k":[["s"]]}],"`q`\\"r":true,"e":{}}', '{"a:b":2.5,"big":123456789012345678901234567890}', "{bad", None, "3", "[1,[2.5]]", json.dumps(deep)]
    rows = [(k, f"i{k % 2}", t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, idx string, j string")
    got = {r["field"]: (r["type"], r["n_docs"], r["conflict"]) for r in D.field_catalog(df, ["j"], by=()).collect()}
    assert got == {
        "doc_id": ("long", 7, False), "j.a:b": ("double|long", 2, True), "j.a.c.k": ("long|string", 1, True), 'j.`q`"r': ("boolean", 1, False), "j.e": ("object", 1, False),
        "j.big": ("long", 1, False), "j": ("double|long", 2, True), "j" + ".d" * 20 + ".d": ("object", 1, False),
    }
    per = D.field_catalog(df, ["j"], top=2).collect()
    assert {(r["idx"], r["n_docs_total"], r["n_unreadable"], r["n_fields"]) for r in per} == {("i0", 4, 1, 7), ("i1", 3, 0, 4)} and len(per) == 4
    assert D.field_catalog(df.limit(0), ["j"]).count() == 0
    plan = D.field_catalog(df, ["j"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert df.select(F.size(D.json_leaves(F.col("j"), "j", 1))).count() == 7
