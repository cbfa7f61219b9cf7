"""Exact dedup by progressive refinement: length, prefix hash, full hash.

Every step reads less of less: lengths that occur once drop out, then
(length, prefix hash) pairs that occur once, and only the rows that survive
both have their whole text hashed. Counts are pre-aggregated in every task,
so a group holding a third of all rows shuffles one row per task. Texts are
never shuffled while the surviving keys fit a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterlens.llm.common import SPACE_RUN, join_ids, stored

#: Characters that the prefix hash covers.
PREFIX = 64


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


@dataclass
class Groups:
    """Groups of two rows or more: sha, keep_id, group_size, keep_rows (rows that carry keep_id)."""

    groups: DataFrame


def duplicate_groups(docs: DataFrame, prefix: int = PREFIX) -> Groups:
    """Groups of equal normalised texts among all rows of (doc_id, text).

    Empty and null texts are equal. Of a group the smallest doc_id stays (null
    ids come last). An empty table has no groups. Columns besides these two
    are not read.
    """
    text = normalised(F.col("text"))
    keys = stored(
        docs.select("doc_id", F.length(text).alias("len"), F.xxhash64(F.substring(text, 1, prefix)).alias("pre")),
        "dedup-keys",
    )
    lengths = keys.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len")
    # There are no more lengths than the longest text has characters; a length shared by a third of all rows stays where it is read.
    prefixes = join_ids(keys, lengths, ["len"], "left_semi", lengths.count()).groupBy("len", "pre").agg(F.count("*").alias("n")).where("n > 1").select("len", "pre")
    # Rows are found again by what their text gives, as ids can be null.
    survivors = stored(prefixes, "dedup-survivors")
    found_again = docs.select("doc_id", "text", F.length(text).alias("len"), F.xxhash64(F.substring(text, 1, prefix)).alias("pre"))
    full = join_ids(found_again, survivors, ["len", "pre"], "left_semi", survivors.count())
    by_id = full.select("doc_id", text_sha256(F.col("text")).alias("sha")).groupBy("sha", "doc_id").agg(F.count("*").alias("rows"))
    groups = by_id.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"), F.min_by("rows", F.coalesce(F.col("doc_id"), F.lit(2**63 - 1))).alias("keep_rows"))
    return Groups(stored(groups.where("group_size > 1"), "dedup-groups"))


def mark(docs: DataFrame, found: Groups) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    ``kept`` goes by id: all rows that carry the id that stays are kept, as are all rows of a group without any id, since
    no id tells them apart. ``drop_duplicates`` keeps one of them.
    """
    own = docs.select("doc_id", text_sha256(F.col("text")).alias("sha"))
    joined = own.join(found.groups, "sha", "left")
    return joined.select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keep_id").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, found: Groups) -> DataFrame:
    """The rows that stay, with all columns. Rows that repeat the id and the text of the row that stays go too."""
    key = "__text_sha256"
    keyed = docs.withColumn(key, text_sha256(F.col("text")))
    groups = found.groups.select(F.col("sha").alias(key), F.col("keep_id").alias("__keep"), F.col("keep_rows").alias("__rows"))
    joined = join_ids(keyed, groups, [key], "left", found.groups.count(), limit=1_000_000)
    stays = joined.where(F.col("__rows").isNull() | F.col("doc_id").eqNullSafe(F.col("__keep")))
    once = stays.where("__rows is null or __rows = 1").drop(key, "__keep", "__rows")
    again = stays.where("__rows > 1").dropDuplicates(["doc_id", key]).drop(key, "__keep", "__rows")
    return once.unionByName(again)

