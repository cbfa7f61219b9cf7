"""Literal cases of the reference tests plus edge rows, as Column expressions."""

from pyspark.sql import functions as F

from clusterlens.functions import parse as P
from clusterlens.functions import predicates as Q
from clusterlens.functions import render as R
from clusterlens.functions import scripts as S
from conftest import one


def vals(spark, fn, inputs, typ="string"):
    return one(spark, fn(F.col("x")), f"x {typ}", [(v,) for v in inputs])


def test_duration_seconds(spark):
    got = vals(spark, P.duration_seconds, ["01:00:00", "1-01:00:00", "00:00:30", "", None, "INVALID", "Unknown",
                                           "1-02:03", "03:04.5", "x:10", "a-01:00:00"])
    assert got == [3600.0, 90000.0, 30.0, None, None, None, None, 86400.0 + 123, 184.5, None, None]


def test_mem_bytes(spark):
    got = vals(spark, P.mem_bytes, ["4000Mc", "", "16G", "16Gn", "3971344K", "0", "INVALID", "512", "2t", "abcK", "c"])
    assert got[0]["mode"] == "c" and got[0]["bytes"] == 4000 * 1024**2
    assert got[1] is None
    assert (got[2]["bytes"], got[2]["mode"]) == (16 * 1024**3, "")
    assert (got[3]["bytes"], got[3]["mode"]) == (16 * 1024**3, "n")
    assert got[4]["bytes"] == 3971344 * 1024
    assert got[5] is None and got[6] is None
    assert got[7]["bytes"] == 512.0  # no unit = bytes
    assert got[8]["bytes"] == 2 * 1024**4
    assert got[9] is None and got[10] is None


def test_format_bytes(spark):
    got = vals(spark, R.format_bytes, [1024.0**3, 0.0, 1536.0, 1024.0**6 * 3], "double")
    assert "GiB" in got[0] and got[0] == "1.00 GiB"
    assert got[1] == "0.00 B" and got[2] == "1.50 KiB" and got[3].endswith("PiB")


def test_norm_job_name(spark):
    assert vals(spark, P.norm_job_name, ["VA259_02_mission_123", "", None, "x" * 60]) == [
        "VA#_#_mission_#", "?", "?", "x" * 48]


def test_valid_name(spark):
    assert vals(spark, Q.valid_name, ["node066", "l2p_dev1", "a;rm -rf", ""]) == [True, True, False, False]


def test_valid_pattern(spark):
    assert vals(spark, Q.valid_pattern, ["l2p_dev1", "node.*", 'a"b']) == [True, True, False]


def test_valid_index(spark):
    assert vals(spark, Q.valid_index, ["logs-*", "Bad Index", ""]) == [True, False, False]


def test_index_allowed(spark):
    allowed = ["logs-*", "app"]
    assert vals(spark, lambda c: Q.index_allowed(c, allowed), ["logs-2026.08", "app", "secrets"]) == [True, True, False]
    assert vals(spark, lambda c: Q.index_allowed(c, []), ["anything"]) == [True]
    # a requested comma list passes only when every part is allowed
    assert Q.request_allowed("logs-a,secret", allowed) is False
    assert Q.request_allowed("logs-a,app", allowed) is True


def test_script_modules(spark):
    script = "#!/bin/bash\nmodule load python/3.11 gcc\nsrun ./run.sh\n  module add -q cuda/12\n"
    got = vals(spark, S.script_modules, [script])[0]
    assert got == ["python/3.11", "gcc", "cuda/12"]


def test_script_paths(spark):
    script = "cat /work/a/in.txt, /work/a/in.txt\nx-/work/no /etc/passwd\n cp /work/b/out.dat. /workx/c\n"
    got = vals(spark, S.script_paths, [script])[0]
    assert got == ["/work/a/in.txt", "/work/b/out.dat"]


def test_array_task_count(spark):
    assert vals(spark, P.array_task_count, ["123_[1-100%4]", "123_[1,3,5]", "456", "7_[1-100:2]", "8_[5-7,9]", "9_[x]"]) == [
        100, 3, 1, 1, 4, 1]


def test_path_under_roots(spark):
    got = vals(spark, Q.path_under_roots, ["/work/sub/file.log", "/etc/passwd", "/work/../etc/passwd", "/work", "work/x", "/workx"])
    assert got == [True, False, False, True, False, False]


def test_first_state_and_reason(spark):
    assert vals(spark, P.first_state, ["CANCELLED by 12", "", "  ", None, "FAILED"]) == ["CANCELLED", "?", "?", "?", "FAILED"]
    assert vals(spark, P.reason_token, ["ReqNodeNotAvail, UnavailableNodes:n1", "", "Priority", None]) == [
        "ReqNodeNotAvail", "None", "Priority", "None"]


def test_bad_state_key(spark):
    assert vals(spark, Q.bad_state_key, ["FAILED", "TIMEOUT", "OUT_OF_MEMORY", "NODE_FAIL", "COMPLETED", "CANCELLED by 3"]) == [
        "FAILED", "TIMEOUT", "OUT_OF_MEMORY", "NODE_FAIL", None, None]


def test_tres(spark):
    t = ["cpu=16,mem=64G,node=1,gres/gpu=2", "cpu=4,mem=4000", "billing=3,cpu=2,mem=1T", "gres/gpu=x,cpu=1", "gres/gpu:a100=2"]
    assert vals(spark, P.tres_cpu, t) == [16, 4, 2, 1, None]
    assert vals(spark, P.tres_gpu, t) == [2, None, None, None, None]
    got = vals(spark, P.tres_mem_gb, t)
    assert got[0] == 64.0 and abs(got[1] - 4000 / 1024) < 1e-12 and got[2] == 1024.0 and got[3] is None


def test_host_list(spark):
    got = vals(spark, P.host_list, ["node[001-003,007]", "gpu5", "a[1-2],b[09-10]", ""])
    assert got == [["node001", "node002", "node003", "node007"], ["gpu5"], ["a1", "a2", "b09", "b10"], []]


def test_log_path(spark):
    df = spark.createDataFrame(
        [("/w/%x-%j.out", "123_4", "sim", "bob"), ("%%j_%a_%u.log", "55", "", "amy"), ("/l/%A.%a", "9_7", "n", "u")],
        "p string, j string, n string, u string")
    got = [r[0] for r in df.select(S.log_path(F.col("p"), F.col("j"), F.col("n"), F.col("u"))).collect()]
    assert got == ["/w/sim-123.out", "%j_0_amy.log", "/l/9.7"]


def test_parallel_mechanisms(spark):
    got = vals(spark, S.parallel_mechanisms, ["mpirun -np 4 ./a", "srun x\nexport OMP_NUM_THREADS=8", "python run.py", None])
    assert got == [["MPI (mpirun/mpiexec)"], ["MPI (srun)", "OpenMP"], [], []]


def test_parallel_note(spark):
    df = spark.createDataFrame([(["OpenMP"], 1, 2), (["MPI (srun)"], 1, 2), ([], 4, 1), ([], 1, 1)],
                               "m array<string>, c int, n int")
    got = [r[0] for r in df.select(S.parallel_note(F.col("m"), F.col("c"), F.col("n"))).collect()]
    assert got == ["detected_not_distributed", "detected", "maybe_sequential", None]
