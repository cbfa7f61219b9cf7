"""Readers for the raw formats of cluster tools, each returning a canonical DataFrame.

* pipe-separated snapshots with a header line (accounting, queue, shares);
* ``key=value`` records (live job records);
* plain log files as numbered lines;
* a directory inventory (file name, size, mtime; contents never read);
* JSON log documents;
* metric samples (parquet, or the JSON matrix/vector answer of a metrics API).

All are plain Spark sources; none pulls data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions._util import col_or_lit


def read_delimited(spark: SparkSession, paths: str | Sequence[str], sep: str = "|", columns: Sequence[str] | None = None) -> DataFrame:
    """Header + ``sep``-separated rows, every column a string.

    Blank lines are skipped, a short row leaves the missing columns null,
    extra cells are dropped, and there is no quoting. Column names come
    from the header unless ``columns`` pins them (a fixed schema is cheaper:
    no header pass). A file whose header differs from these names fails the
    job: its cells would stand in the wrong columns.
    """
    reader = (spark.read.option("sep", sep).option("header", True).option("quote", "\u0000").option("escape", "\u0000")
              .option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("enforceSchema", False))
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def parse_kv_records(text) -> Column:
    """``key=value`` tokens of a record → MAP<STRING,STRING>.

    Tokens are split on whitespace; only tokens holding ``=`` count; the
    key is the text before the first ``=``; the last duplicate wins.
    """
    toks = F.filter(F.split(F.coalesce(col_or_lit(text), F.lit("")), r"\s+"), lambda t: F.instr(t, "=") > 0)
    # sorted by key and place once; an entry stays if the next one has another key
    pairs = F.array_sort(F.transform(toks, lambda t, i: F.struct(
        F.substring_index(t, "=", 1).alias("key"), i.alias("at"), F.substr(t, F.instr(t, "=") + 1).alias("value"))))
    last = F.zip_with(pairs, F.slice(pairs, 2, F.greatest(F.size(toks), F.lit(1))), lambda own, following: F.when(
        following["key"].isNull() | (own["key"] != following["key"]), F.struct(own["key"].alias("key"), own["value"].alias("value"))))
    return F.map_from_entries(F.filter(last, lambda e: e.isNotNull()))


def read_log_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text files → ``log_lines(path, lineno, line)`` with exact 1-based line numbers.

    Files may be split across tasks. Each split's rows keep their order and
    carry consecutive ids, so a line's number is (lines in the earlier
    splits of its file) + (position inside its split). The files are read
    once: rows are dealt by split, and both the lines and the splits' line
    counts come from that one exchange. Only the counts, a handful of rows
    per file, are ranked; no file is ever sorted whole or held by one task.
    """
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"), F.col("value").alias("line")).repartition("path", "block")
    # counting the lines themselves keeps all columns in the exchange, which is what lets both sides share it
    splits = raw.groupBy("path", "block").agg(F.count("line").alias("n"), F.min("mid").alias("base"))
    w = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("offset", F.coalesce(w, F.lit(0)))
    out = raw.join(splits.select("path", "block", "base", "offset"), ["path", "block"], "inner")
    return out.select(F.regexp_replace("path", "^file:(//)?", "").alias("path"),
                      (F.col("offset") + F.col("mid") - F.col("base") + 1).alias("lineno"), "line")


def read_file_inventory(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Directory inventory → ``files(path, parent, name, kind, size, mtime, owner)`` for regular files.

    ``binaryFile`` with only path/length/modificationTime selected: the
    content column is pruned from the scan, so no file body is read.
    Owners are not visible to this source (null).
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
          .load(root).select("path", "length", "modificationTime"))
    p = F.regexp_replace("path", "^file:", "")
    return df.select(
        p.alias("path"), F.regexp_extract(p, r"^(.*)/[^/]*$", 1).alias("parent"), F.regexp_extract(p, r"([^/]*)$", 1).alias("name"),
        F.lit("f").alias("kind"), F.col("length").alias("size"), F.col("modificationTime").cast("timestamp_ntz").alias("mtime"),
        F.lit(None).cast("string").alias("owner"))


def read_docs(spark: SparkSession, paths: str | Sequence[str], index_field: str = "_index", time_field: str = "@timestamp") -> DataFrame:
    """JSON-lines documents → columns of the documents plus ``idx`` and ``ts`` (TIMESTAMP_NTZ).

    Missing index names fall back to the file name without extension.
    """
    df = spark.read.json(paths if isinstance(paths, str) else list(paths))
    fname = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*?)(\.[^./]*)?$", 1)
    idx = F.coalesce(F.col(f"`{index_field}`"), fname) if index_field in df.columns else fname
    ts = F.col(f"`{time_field}`").try_cast("timestamp_ntz") if time_field in df.columns else F.lit(None).cast("timestamp_ntz")
    return df.select(idx.alias("idx"), ts.alias("ts"), *[F.col(f"`{c}`") for c in df.columns])


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Parquet samples ``(metric, labels MAP, ts, value)``, usually partitioned by date."""
    return spark.read.parquet(path).select("metric", "labels", "ts", "value")


_SERIES = StructType([
    StructField("metric", MapType(StringType(), StringType())),
    StructField("value", ArrayType(StringType())),
    StructField("values", ArrayType(ArrayType(StringType()))),
])
_ANSWER = StructType([StructField("data", StructType([StructField("result", ArrayType(_SERIES))]))])


def read_metric_answers(spark: SparkSession, paths: str | Sequence[str], whole: bool = False) -> DataFrame:
    """Saved metrics-API answers (vector ``value`` or matrix ``values``) → samples; a file may hold several answers.

    Answers are cut into series at the key ``"metric"``, with which every
    series begins, so a file of one huge answer is still split across tasks.
    What is cut elsewhere (a label named ``metric``, a series with other keys
    first) does not parse and fails the job; ``whole`` reads such files, one
    task and one answer a file. ``__name__`` becomes ``metric``; times keep
    microseconds; ``"NaN"`` parses to NaN (filtered by the operators that need it).
    """
    paths = paths if isinstance(paths, str) else list(paths)
    if whole:
        series = spark.read.schema(_ANSWER).option("multiLine", True).json(paths).select(F.explode("data.result").alias("r"))
    else:
        text = F.col("value")
        parts = spark.read.option("lineSep", '"metric"').text(paths).where(F.trim(text) != "").withColumn("starts", F.regexp_extract("value", r"^\s*(.)", 1))
        parsed = parts.select("starts", F.when(F.col("starts") == ":", F.from_json(F.concat(F.lit('{"metric"'), text), _SERIES)).alias("r"))
        broken = F.when(F.col("starts") == ":", F.col("r.metric").isNull() | (F.col("r.value").isNull() & F.col("r.values").isNull())).otherwise(~F.col("starts").isin("{", "["))
        wrong = F.raise_error(F.lit("an answer is not cut at its series (a label named metric, or other keys before it): read it with whole=True"))
        series = parsed.select(F.when(broken, wrong.cast(_SERIES)).otherwise(F.col("r")).alias("r")).where("r is not null")
    points = F.coalesce(F.col("r.values"), F.when(F.col("r.value").isNotNull(), F.array(F.col("r.value"))))
    pts = series.select("r.metric", F.explode(points).alias("p"))
    seconds = F.coalesce(F.col("p")[0].try_cast("decimal(24,6)"), F.col("p")[0].try_cast("double").try_cast("decimal(24,6)"))
    return pts.select(
        F.col("metric")["__name__"].alias("metric"),
        F.map_filter("metric", lambda k, v: k != "__name__").alias("labels"),
        F.timestamp_micros((seconds * 1_000_000).cast("bigint")).cast("timestamp_ntz").alias("ts"),
        F.col("p")[1].try_cast("double").alias("value"),
    )
