"""Corpus pipeline: quality filter, exact dedup, near dedup, source mixing, tokenisation.

``STAGES`` are applied in order to ``documents``; each stage's result is
written as Parquet to the run's shared folder and reread as the next one's
input, so a lost executor never repeats more than one stage. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm import byte_bpe, exact_dedup, jaccard_join, latent_vote, mixing
from clusterlens.llm.common import read, ship, small_batches, stored
from clusterlens.llm.queries import MIX_SHARE, QUALITY_CUT, SOURCE_WEIGHTS


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut. Null and empty texts score 0 and go."""
    voter = latent_vote.train(docs, read(spark, sf_dir, "labels"))
    return docs.where(latent_vote.score(F.col("text"), voter) >= QUALITY_CUT)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs, exact_dedup.duplicate_groups(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component, the row with the smallest doc_id."""
    return jaccard_join.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: rows repeat as often as it uses them, in the order of its shards."""
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixing.mixed_rows(docs, mixing.mix(docs, SOURCE_WEIGHTS, MIX_SHARE, n_shards=shards), shards)


def byte_bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix (packed little-endian unsigned 32-bit integers), checked by decoding them."""
    small_batches(spark)
    trip = byte_bpe.round_trip(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = docs.withColumn("__t", trip)
    whole = F.col("__t.decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    ids = F.when(whole, F.col("__t.ids")).otherwise(F.raise_error(F.lit("ids do not decode to their text")).cast("binary"))
    return rows.select("doc_id", "source", (F.octet_length("__t.ids") / 4).cast("long").alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe_tokens),
]

#: The classifier's votes, the mix's draws and the tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
