"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import io
import os
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import clusterlens.session
from clusterlens.session import discard, run_folder, shuffles_removed, stored  # noqa: F401

#: White space of the word contracts: space and U+0009..U+000D, nothing else.
#: ``bytes.split()`` without arguments splits on exactly these.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Up to so many rows of (id, small value) are broadcast by ``keep_ids``; more are joined by shuffle.
BROADCAST_ROWS = 2_000_000

_shipped: set[str] = set()
_libc = ctypes.CDLL(None)
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the Arrow batches that Python workers hold, unless the session sets them: texts can be long."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(rows))


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per application: a zip in the run's shared folder, added as a Python file."""
    if spark.sparkContext.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(clusterlens.session.__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(top, "clusterlens")):
            for name in sorted(n for n in names if n.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    jvm, place = spark.sparkContext._jvm, f"{run_folder(spark, 'library')}/clusterlens.zip"
    path = jvm.org.apache.hadoop.fs.Path(place)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(packed.getvalue())
    out.close()
    spark.sparkContext.addPyFile(files.makeQualified(path).toString())
    _shipped.add(spark.sparkContext.applicationId)


def held_out(doc_id: Column) -> Column:
    """The held-out fold: crc32 of the id as text, modulo 5, is 0 (a null id counts as the text 'null')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 5 == 0


def labelled_ids(labels: DataFrame, label: str, worse: str = "min") -> DataFrame:
    """All labelled ids outside the held-out fold: (doc_id, y). Of repeated ids the ``worse`` label counts; null labels and ids are left out."""
    agg = F.min if worse == "min" else F.max
    return (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(agg("y").alias("y"))
    )


def labelled_sample(labels: DataFrame, label: str, max_rows: int, worse: str = "min") -> DataFrame:
    """At most ``max_rows`` of ``labelled_ids``: those with the smallest hashes of the id, so reruns agree."""
    return labelled_ids(labels, label, worse).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def sample_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, y) of the sampled ids, one row each: of a repeated id the smallest text that is not null.

    The sample's size is a documented bound, so it is broadcast, and what the driver gets is bounded, however often an
    id is repeated: each task sends one text an id at most.
    """
    return labelled_texts(docs, F.broadcast(sample))


def labelled_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text, y) of ids of any number, one row each as in ``sample_texts``."""
    return docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))


def join_ids(df: DataFrame, ids: DataFrame, on: list[str], how: str, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Semi or anti join of ``df`` with ``ids`` of a known row count: broadcast up to ``limit`` rows, shuffled beyond."""
    return df.join(F.broadcast(ids) if rows <= limit else ids, on, how)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def chunks(items: list, size: int) -> Iterable[list]:
    for at in range(0, len(items), size):
        yield items[at : at + size]


@dataclass
class Words:
    """The words of some texts: ``codes`` of all words in order, the distinct words, and each text's first place."""

    codes: np.ndarray
    distinct: list[bytes]
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def of(self, k: int) -> np.ndarray:
        return self.codes[self.starts[k] : self.starts[k + 1]]

    @property
    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self)), np.diff(self.starts))


def words_of(texts: list[bytes]) -> Words:
    """Split UTF-8 texts at ``SPACE_RUN`` and number their distinct words, in Arrow rather than word by word."""
    if not texts:
        return Words(np.empty(0, np.int64), [], np.zeros(1, np.int64))
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, behind = edge[::2], edge[1::2]
    starts = np.concatenate(([0], np.searchsorted(begins, ends)))
    if not len(begins):
        return Words(np.empty(0, np.int64), [], starts)
    # The words alone, one after another, so that their ends are the next ones' begins.
    offsets = np.concatenate(([0], np.cumsum(behind - begins)))
    entries = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw.compress(inside))]).dictionary_encode()
    return Words(entries.indices.to_numpy().astype(np.int64), entries.dictionary.to_numpy(zero_copy_only=False).tolist(), starts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each of several runs, one after another."""
    total = int(lengths.sum())
    shift = starts - np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else starts
    return np.repeat(shift, lengths) + np.arange(total)


def give_back() -> None:
    """Return memory that a worker no longer uses to the system: workers live on, and else keep the most they ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc, "malloc_trim", None)
    if trim is not None:
        trim(0)


def gathered(batches: Iterator[pd.DataFrame], column: str, size: int) -> Iterator[pd.DataFrame]:
    """The same rows in frames of about ``size`` characters of the text column."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += int(batch[column].str.len().fillna(0).sum())
        if total >= size:
            yield pd.concat(held, ignore_index=True)
            held, total = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)
    held.clear()
    give_back()
