"""Registered source queries: a given table is written in a raw format to the run's shared folder and read back.

These are the only queries that write anything, as reading the format is what they check. Each run has a folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import readers as Rd
from ..sources.fixtures import Tables
from .oracle_fixtures import with_fixtures as W
from .registry import query

#: Files of one language are dealt by document number into so many folders.
FOLDERS = 16


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("read_delimited", """
SELECT CAST(c_custkey AS VARCHAR) AS "JobID", c_name AS "User", nullif(CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END, '') AS "State", CAST(c_nationkey AS VARCHAR) AS "Account"
FROM customer""")
def q_read_delimited(spark, sf_dir):
    """Customers as pipe-separated rows under a header, read back as text columns; some cells are empty."""
    folder = _folder(spark, "delimited")
    rows = Tables(spark, sf_dir).raw("customer").select(
        F.col("c_custkey").alias("JobID"), F.col("c_name").alias("User"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("State"),
        F.col("c_nationkey").alias("Account"))
    rows.write.option("sep", "|").option("header", True).option("emptyValue", "").option("quote", "\u0000").csv(folder)
    return Rd.read_delimited(spark, folder)


def _written_logs(spark: SparkSession, sf_dir: str) -> str:
    """Documents as log files, one for each language and sixteenth of the documents, lines in order of document and place."""
    folder = _folder(spark, "logs")
    docs = Tables(spark, sf_dir).raw("documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), F.regexp_replace("text", "\r", " ").alias("text"))
    lines = docs.withColumn("folder", F.col("doc_id") % FOLDERS).select("lang", "folder", "doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    own = lines.repartition("lang", "folder").sortWithinPartitions("lang", "folder", "doc_id", "place")
    own.select("lang", "folder", F.col("line").alias("value")).write.partitionBy("lang", "folder").text(folder)
    return folder


def _where(path: str = "path") -> list:
    return [F.regexp_extract(path, "/lang=([^/]*)/", 1).alias("lang"), F.regexp_extract(path, "/folder=([0-9]+)/", 1).cast("bigint").alias("folder")]


_LINES_SQL = f"""
d AS (SELECT doc_id, coalesce(lang, 'none') AS lang, doc_id % {FOLDERS} AS folder, replace(text, chr(13), ' ') AS text FROM documents WHERE text IS NOT NULL),
l AS (SELECT lang, folder, doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS place, unnest(string_split(text, chr(10))) AS line FROM d)"""


@query("read_log_lines", f"""
WITH {_LINES_SQL}
SELECT lang, folder, row_number() OVER (PARTITION BY lang, folder ORDER BY doc_id, place) AS lineno, md5(line) AS line FROM l""")
def q_read_log_lines(spark, sf_dir):
    """All lines of the documents as log files: number of each line in its file, and the line's digest."""
    lines = Rd.read_log_lines(spark, _written_logs(spark, sf_dir))
    return lines.select(*_where(), F.col("lineno").cast("bigint").alias("lineno"), F.md5("line").alias("line"))


@query("read_file_inventory", f"""
WITH {_LINES_SQL}
SELECT lang, folder, count(DISTINCT 1) AS files, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes FROM l GROUP BY lang, folder""")
def q_read_file_inventory(spark, sf_dir):
    """Files and bytes of the written log folders, out of the inventory alone."""
    files = Rd.read_file_inventory(spark, _written_logs(spark, sf_dir), glob="*.txt")
    return files.select(*_where(), "size").groupBy("lang", "folder").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


@query("read_docs", W("""
SELECT CASE WHEN doc_id % 4 = 0 THEN 'unnamed' ELSE idx END AS idx, ts, doc_id, level, CASE WHEN doc_id % 3 = 0 THEN value END AS value, CASE WHEN doc_id % 3 = 0 THEN ltrim(message) END AS text
FROM docs""", "docs"))
def q_read_docs(spark, sf_dir):
    """Log documents as JSON lines; a fourth of them name no index, which then is the name of their file's folder."""
    folder = _folder(spark, "docs")
    docs = Tables(spark, sf_dir).docs
    rows = docs.select(F.when(F.col("doc_id") % 4 != 0, F.col("idx")).alias("_index"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("@timestamp"), "doc_id", "level",
                       F.when(F.col("doc_id") % 3 == 0, F.col("value")).alias("value"), F.when(F.col("doc_id") % 3 == 0, F.ltrim("message")).alias("text"))
    rows.write.json(folder)
    back = Rd.read_docs(spark, folder)
    return back.select(F.when(F.col("_index").isNull(), F.when(F.col("idx").startswith("part-"), "unnamed").otherwise("wrong")).otherwise(F.col("idx")).alias("idx"), "ts", "doc_id", "level", "value", "text")


@query("read_metric_answers", W("""
SELECT metric, instance, ts, value FROM samples WHERE metric IN ('node_load1', 'node_load5') AND value IS NOT NULL""", "samples"))
def q_read_metric_answers(spark, sf_dir):
    """Load samples as answers of a metrics API, one a day and metric, read back as samples."""
    folder = _folder(spark, "answers")
    loads = Tables(spark, sf_dir).samples.where(F.col("metric").isin("node_load1", "node_load5") & F.col("value").isNotNull())
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(20,6)").cast("string")
    points = loads.select("metric", F.col("labels")["instance"].alias("instance"), F.to_date("ts").alias("day"), F.array(seconds, F.col("value").cast("string")).alias("p"))
    series = points.groupBy("day", "metric", "instance").agg(F.array_sort(F.collect_list("p")).alias("values"))
    labels = F.map_from_arrays(F.array(F.lit("__name__"), F.lit("instance")), F.array("metric", "instance"))
    results = series.groupBy("day", "metric").agg(F.collect_list(F.struct(labels.alias("metric"), "values")).alias("result"))
    answer = F.struct(F.lit("success").alias("status"), F.struct(F.lit("matrix").alias("resultType"), "result").alias("data"))
    results.select(F.to_json(answer).alias("value")).write.text(folder)
    back = Rd.read_metric_answers(spark, folder)
    return back.select("metric", F.col("labels")["instance"].alias("instance"), "ts", "value")
