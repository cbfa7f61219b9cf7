"""Readers on small files written to a fresh scratch folder."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from clusterlens.sources import readers as Rd


def _scratch():
    return tempfile.mkdtemp(prefix="clusterlens-test-")


def test_read_delimited(spark):
    d = _scratch()
    with open(os.path.join(d, "acct.txt"), "w") as f:
        f.write("JobID|User|State\n\n1|alice|COMPLETED\n2|bob\n3|carl|FAILED|extra\n")
    rows = Rd.read_delimited(spark, os.path.join(d, "acct.txt")).orderBy("JobID").collect()
    assert [tuple(r) for r in rows] == [("1", "alice", "COMPLETED"), ("2", "bob", None), ("3", "carl", "FAILED")]


def test_parse_kv_records_last_duplicate_wins(spark):
    df = spark.createDataFrame([("JobId=5 JobState=PENDING Reason=Priority noeq JobState=RUNNING Cmd=a=b",)], "t string")
    m = df.select(Rd.parse_kv_records(F.col("t")).alias("m")).collect()[0]["m"]
    assert m == {"JobId": "5", "JobState": "RUNNING", "Reason": "Priority", "Cmd": "a=b"}


def test_read_log_lines_numbers_across_splits(spark):
    d = _scratch()
    texts = {"a.log": [f"line {i}" for i in range(1, 3001)], "b.log": ["x", "", "z"]}
    for name, lines in texts.items():
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = Rd.read_log_lines(spark, d)
        got = {(os.path.basename(r["path"]), r["lineno"]): r["line"] for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 3003
    assert all(got[("a.log", i)] == f"line {i}" for i in range(1, 3001))
    assert got[("b.log", 2)] == "" and got[("b.log", 3)] == "z"


def test_read_file_inventory(spark):
    d = _scratch()
    os.makedirs(os.path.join(d, "sub"))
    for name, size in (("x.dat", 10), ("sub/y.dat", 3)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"0" * size)
    rows = {r["name"]: r for r in Rd.read_file_inventory(spark, d).collect()}
    assert rows["x.dat"]["size"] == 10 and rows["y.dat"]["parent"].endswith("/sub") and rows["y.dat"]["kind"] == "f"


def test_read_docs_and_metric_answers(spark):
    d = _scratch()
    with open(os.path.join(d, "logs-1.json"), "w") as f:
        f.write(json.dumps({"@timestamp": "2024-01-02T03:04:05", "message": "boom", "level": "ERROR"}) + "\n")
        f.write(json.dumps({"@timestamp": "2024-01-02T03:05:05", "msg": "ok", "_index": "other"}) + "\n")
    docs = {r["idx"]: r for r in Rd.read_docs(spark, os.path.join(d, "logs-1.json")).collect()}
    assert set(docs) == {"logs-1", "other"} and str(docs["logs-1"]["ts"]) == "2024-01-02 03:04:05"
    ans = {"status": "success", "data": {"resultType": "matrix", "result": [
        {"metric": {"__name__": "node_load1", "instance": "n1:9100"}, "values": [[1704164645, "1.5"], [1704164705, "NaN"]]}]}}
    with open(os.path.join(d, "ans.json"), "w") as f:
        json.dump(ans, f)
    s = Rd.read_metric_answers(spark, os.path.join(d, "ans.json")).orderBy("ts").collect()
    assert [r["metric"] for r in s] == ["node_load1"] * 2 and s[0]["labels"] == {"instance": "n1:9100"} and s[0]["value"] == 1.5


def test_kv_records_of_many_tokens_and_odd_values(spark):
    rows = [(None, {}), ("", {}), ("a= b==x =v c", {"a": "", "b": "=x", "": "v"}), (" ".join(f"k{i % 700}=v{i}" for i in range(2000)), {f"k{i % 700}": f"v{i}" for i in range(2000)})]
    got = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "k int, t string").select("k", Rd.parse_kv_records(F.col("t")).alias("m")).collect()
    assert {r["k"]: r["m"] for r in got} == {k: m for k, (_, m) in enumerate(rows)}


def test_log_lines_are_read_once(spark):
    d = _scratch()
    with open(os.path.join(d, "a.log"), "w") as f:
        f.write("\n".join(f"line {i}" for i in range(5000)) + "\n")
    for key, value in (("spark.sql.files.maxPartitionBytes", "4096"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        df = Rd.read_log_lines(spark, d)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan text") == 1


def test_metric_answers_in_splits(spark):
    import pytest

    d = _scratch()
    series = [{"metric": {"__name__": "m", "instance": f"n{k}"}, "values": [[1704164645.123456 + j, str(k + j)] for j in range(20)]} for k in range(300)]
    vector = {"status": "success", "data": {"resultType": "vector", "result": [{"metric": {"__name__": "v"}, "value": [1.5, "NaN"]}]}}
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write(json.dumps({"status": "success", "data": {"resultType": "matrix", "result": series}}, separators=(",", ":")) + "\n" + json.dumps(vector, indent=2) + "\n")
        f.write(json.dumps({"status": "success", "data": {"resultType": "matrix", "result": []}}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = Rd.read_metric_answers(spark, d)
        assert df.rdd.getNumPartitions() > 5
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 6001 and sum(r["value"] for r in rows if r["metric"] == "m") == sum(k + j for k in range(300) for j in range(20))
    assert {r["ts"].microsecond for r in rows if r["metric"] == "m"} == {123456}
    odd = _scratch()
    with open(os.path.join(odd, "a.json"), "w") as f:
        json.dump({"data": {"result": [{"metric": {"__name__": "m", "metric": "x"}, "value": [1, "2"]}]}}, f)
    with pytest.raises(Exception, match="whole=True"):
        Rd.read_metric_answers(spark, odd).collect()
    assert [(r["metric"], r["labels"], r["value"]) for r in Rd.read_metric_answers(spark, odd, whole=True).collect()] == [("m", {"metric": "x"}, 2.0)]
