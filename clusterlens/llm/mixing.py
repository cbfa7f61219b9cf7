"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents are dealt into blocks by a hash of the id, whose
order is the source's random permutation. The words that a source is to give
become exact block quotas: whole passes over all its blocks, then the first
blocks of the permutation up to the target, and of the block where the target
falls, single documents. Documents larger than what is left are set aside, and
the permutation goes on behind them until nothing fits. A binary tree over the output shards splits the
vector of quotas: at each node the left half's share of every source is drawn
from the multivariate hypergeometric distribution, so shards get equal
numbers of blocks and, in expectation, the mix of the whole. Shards then take
disjoint runs of each source's permuted blocks, and shuffle locally by a hash.

What passes through the driver are source totals and quotas (sources times
shards). Blocks, documents and texts stay in Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterlens.llm.common import WORD, join_ids, stored

#: Documents of one source in one block, on average, before the number of blocks reaches its bound.
BLOCK_DOCS = 64
#: Blocks of one source at most; beyond, blocks hold more documents and the last one is divided again.
MAX_BLOCKS = 4096
#: The weights are configuration: sources beyond this are refused, not cut.
MAX_SOURCES = 100_000
#: No document is used more often.
MAX_REPEATS = 2.0
#: Where nothing more fits and a source misses its target by more than this share, its smallest unused document may replace others.
CLOSE = 0.0001
SEED = 20


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))  # 't' sorts the null source last


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: float = MAX_REPEATS) -> np.ndarray:
    """Shares of ``total`` by weight; a share stops at ``most`` times its size, and the excess is shared again among
    the rest by weight until none is above. If all stop, the sum stays below ``total``."""
    out = np.zeros(len(sizes))
    limit = most * sizes.astype(float)
    free = np.ones(len(sizes), bool)
    rest = float(total)
    while free.any() and rest > 0:
        share = rest * weights[free] / weights[free].sum()
        above = share > limit[free]
        if not above.any():
            out[free] = share
            break
        stop = np.flatnonzero(free)[above]
        out[stop] = limit[stop]
        free[stop] = False
        rest = float(total) - out[~free].sum()
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): exact block counts of every shard. Rows differ in their sums by one block at most, columns sum to the quotas."""
    if shards == 1:
        return quotas[None, :].copy()
    left_shards = shards // 2
    total = int(quotas.sum())
    # the left half gets as many blocks as its shards would in an even deal
    left_total = total // shards * left_shards + min(total % shards, left_shards)
    left, rest, room = np.zeros_like(quotas), total, left_total
    for s, q in enumerate(quotas):  # the multivariate draw, one source after another
        others = rest - int(q)
        left[s] = rng.hypergeometric(int(q), others, room) if q and others and room else min(int(q), room)
        rest, room = others, room - int(left[s])
    return np.concatenate((split_quotas(left, left_shards, rng), split_quotas(quotas - left, shards - left_shards, rng)))


@dataclass
class Mix:
    """docs: doc_id, source, size, source_size, target, copies (times used), one row per row of the input.
    plan: source, block, copy, shard of every block of the mix."""

    docs: DataFrame
    shards: DataFrame


def mix(docs: DataFrame, weights: list[float], share: float, n_shards: int = 16, seed: int = SEED) -> Mix:
    """Plan a mix of (doc_id, text, source).

    Sources in the order of their code points, null last, get the weights in
    turn, repeating. The mix takes ``share`` times the words of all documents.
    Documents without words are counted among their source's blocks and have
    size 0; a source without words has target 0. Rows that repeat an id are
    dealt and used alike. An empty table gives an empty mix. Reruns agree: all
    draws derive from ids and ``seed``.
    """
    spark = docs.sparkSession
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sized = stored(docs.select("doc_id", source_key().alias("source_key"), "source", n_words(F.col("text")).alias("size"), hashed.alias("h")), "mix-sizes")
    totals = sized.groupBy("source_key").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: give them a coarser key")
    # Binary (UTF-8) order is code-point order.
    totals = sorted(totals, key=lambda r: r["source_key"].encode())
    sizes = np.array([r["size"] for r in totals], np.int64)
    rank = np.array([float(weights[k % len(weights)]) for k in range(len(totals))])
    goal = targets(sizes, rank, share * float(sizes.sum())) if len(totals) else np.zeros(0)
    blocks = [int(min(MAX_BLOCKS, max(1, -(-r["docs"] // BLOCK_DOCS)))) for r in totals]
    passes = [int(g // s) if s else 0 for g, s in zip(goal, sizes, strict=True)]
    schema = T.StructType([T.StructField("source_key", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()), T.StructField("blocks", T.IntegerType()), T.StructField("passes", T.IntegerType()), T.StructField("rest", T.DoubleType())])
    table = spark.createDataFrame(
        [(r["source_key"], int(s), float(g), b, p, float(g - p * s)) for r, s, g, b, p in zip(totals, sizes, goal, blocks, passes, strict=True)],
        schema,
    )
    placed = sized.join(F.broadcast(table), "source_key").withColumn("block", F.pmod(F.shiftright("h", 20), F.col("blocks")).cast("int"))

    # The permutation of a source's blocks is their number: ids are dealt to numbers by a hash. MAX_BLOCKS bounds the window.
    units = stored(placed.groupBy("source_key", "block", "h").agg(F.sum("size").alias("size")), "mix-units")
    rests = {r["source_key"]: float(g - p * s) for r, s, g, p in zip(totals, sizes, goal, passes, strict=True)}
    whole, extra = _extra_documents(units, rests, {r["source_key"]: float(g) for r, g in zip(totals, goal, strict=True)})
    run = placed.groupBy("source_key", "block").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    run = run.join(whole.withColumn("whole", F.lit(True)), ["source_key", "block"], "left")
    run = run.join(extra.select("source_key", "block").distinct().withColumn("some", F.lit(True)), ["source_key", "block"], "left")
    run = run.withColumn("extra", F.when(F.col("whole"), "all").when(F.col("some"), "part").otherwise("none"))
    run = stored(run.select("source_key", "block", "words", "docs", "extra"), "mix-blocks")
    n_blocks = run.count()
    marked = join_ids(placed, run.select("source_key", "block", "extra"), ["source_key", "block"], "inner", n_blocks)
    marked = join_ids(marked, extra, ["source_key", "block", "h"], "left", extra.count())
    copies = F.col("passes") + F.when(F.col("extra") == "all", 1).when(F.col("taken").isNotNull(), 1).otherwise(0)
    chosen = marked.select("doc_id", "source", "source_key", "block", "h", "size", "source_size", "target", copies.cast("int").alias("copies"))

    # Slots of each source: its blocks once a pass, then the extra ones; the tree deals them to shards.
    slots = run.groupBy("source_key").agg(F.count("*").alias("all"), F.sum(F.when(F.col("extra") != "none", 1).otherwise(0)).alias("more")).collect()
    counted = {r["source_key"]: (r["all"], r["more"]) for r in slots}
    quotas = np.array([counted.get(r["source_key"], (0, 0))[0] * p + counted.get(r["source_key"], (0, 0))[1] for r, p in zip(totals, passes, strict=True)], np.int64)
    ends = np.cumsum(split_quotas(quotas, n_shards, np.random.default_rng(seed)), axis=0)
    places = spark.createDataFrame(
        [(r["source_key"], p, counted.get(r["source_key"], (0, 0))[0], [int(x) for x in ends[:, k]]) for k, (r, p) in enumerate(zip(totals, passes, strict=True))],
        "source_key string, passes int, all long, ends array<long>",
    )
    position = F.row_number().over(Window.partitionBy("source_key").orderBy("block")) - 1
    dealt = (
        run.select("source_key", "block", "extra", position.alias("position"))
        .join(F.broadcast(places), "source_key")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("passes"))))
        .where("copy < passes or extra <> 'none'")
        .withColumn("slot", F.col("copy") * F.col("all") + F.col("position"))
        .select("source_key", "block", "copy", F.expr("size(filter(ends, e -> e <= slot))").alias("shard"))
    )
    return Mix(chosen, stored(dealt, "mix-shards"))


def fill(sizes: np.ndarray, room: float) -> np.ndarray:
    """Of documents in their order, take each that still fits."""
    taken = np.zeros(len(sizes), bool)
    for k, size in enumerate(sizes):
        if size <= room:
            taken[k] = True
            room -= size
    return taken


BLOCK, UNIT = ["source_key", "block"], ["source_key", "block", "h"]


def _extra_documents(units: DataFrame, rests: dict[str, float], goals: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """What each source gives beyond its whole passes: blocks of which all is taken (source_key, block), and the
    documents taken of other blocks (source_key, block, h, taken). ``units``: (source_key, block, h, size)."""
    whole, parts, left = _fill(units, rests)
    short = [(s, r) for s, r in left.items() if r > CLOSE * goals[s]]
    if short:
        # Nothing fits any more. If the smallest document left comes nearer, it is taken, and others are left out as far as it reaches beyond.
        own = units.join(F.broadcast(units.sparkSession.createDataFrame(short, "source_key string, room double")), "source_key").drop("room")
        own = join_ids(own, whole.withColumn("whole", F.lit(True)), BLOCK, "left", whole.count())
        own = join_ids(own, parts.select(UNIT).withColumn("part", F.lit(True)), UNIT, "left", parts.count())
        own = stored(own.select(*UNIT, "size", F.coalesce("whole", "part", F.lit(False)).alias("in")), "mix-short")
        least = {r["source_key"]: r["l"] for r in own.where("not in and size > 0").groupBy("source_key").agg(F.min(F.struct("size", "block", "h")).alias("l")).collect()}
        room = dict(short)
        out_blocks, out, still = _fill(own.where("in").drop("in"), {s: least[s]["size"] - room[s] for s in least}, largest=True)
        better = [(s, least[s]["block"], least[s]["h"], least[s]["size"]) for s in least if still[s] < room[s]]
        if better:
            added = units.sparkSession.createDataFrame(better, parts.schema)
            stays = join_ids(own.where("in").drop("in"), added.select("source_key"), ["source_key"], "left_semi", len(better))
            stays = join_ids(join_ids(stays, out_blocks, BLOCK, "left_anti", out_blocks.count()), out.select(UNIT), UNIT, "left_anti", out.count())
            whole = join_ids(whole, added.select("source_key"), ["source_key"], "left_anti", len(better))
            parts = join_ids(parts, added.select("source_key"), ["source_key"], "left_anti", len(better)).unionByName(stays).unionByName(added)
    return whole, stored(parts.select(UNIT).withColumn("taken", F.lit(True)), "mix-last")


def _fill(units: DataFrame, rooms: dict[str, float], largest: bool = False) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Fill each source's room with units (source_key, block, h, size) in the order of its permutation.

    Every round walks along the permutation with the units that fit the room:
    blocks in front of the place where it is full are taken whole; the block
    across it is divided twice by further bits of the hash, into pieces of
    about BLOCK_DOCS documents (1024 pieces each time at most), and of the
    piece across it, which is small, units are taken one by one as they fit
    (``largest``: the largest first). What is left then is less than a unit of
    that piece, and the next round goes on with the units that fit it, until
    none does. Returns blocks taken whole (source_key, block), the other
    units taken, and the room left of each source.
    """
    spark = units.sparkSession
    rooms = dict(rooms)
    blocks = spark.createDataFrame([], "source_key string, block int")
    taken = spark.createDataFrame([], units.select(*UNIT, "size").schema)
    n_blocks = n_taken = 0
    todo, first = {s: r for s, r in rooms.items() if r >= 1}, True

    def choose(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["size", "h"], ascending=[False, True]) if largest else batch.sort_values("h")
        return batch.loc[fill(batch["size"].to_numpy(), float(batch["room"].iloc[0])), [*UNIT, "size"]]

    while todo:
        fits = units.join(F.broadcast(spark.createDataFrame(list(todo.items()), "source_key string, room double")), "source_key").where("size <= room")
        if not first:  # documents without words are dealt in the first round
            fits = fits.where("size > 0")
            fits = join_ids(join_ids(fits, blocks, BLOCK, "left_anti", n_blocks), taken.select(UNIT), UNIT, "left_anti", n_taken)
        upto = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = fits.groupBy(BLOCK).agg(F.sum("size").alias("words"), F.count("*").alias("docs"), F.first("room").alias("room"))
        sums = sums.withColumn("left", F.col("room") - (F.sum("words").over(upto) - F.col("words"))).where("left > 0")
        if first:  # later rounds fill less than one document: few blocks, listed by document
            n_units = units.groupBy(BLOCK).agg(F.count("*").alias("units"))
            sums = sums.join(n_units, BLOCK).withColumn("all", (F.col("left") >= F.col("words")) & (F.col("docs") == F.col("units")))
        else:
            sums = sums.withColumn("all", F.lit(False))
        sums = stored(sums.select(*BLOCK, "words", "docs", "left", "all"), "mix-reached")
        rows = join_ids(fits.drop("room"), sums.where("not all").drop("all"), BLOCK, "inner", sums.count())
        found = [rows.where("left >= words").select(*UNIT, "size")]
        rows = rows.where("left < words").select(*UNIT, "size", F.col("left").alias("room"), "docs")
        for step in (40, 52):
            pieces = F.least(F.lit(1024), F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_DOCS)))
            rows = rows.withColumn("cut", F.pmod(F.shiftrightunsigned("h", step), pieces))
            cuts = rows.groupBy(*BLOCK, "cut").agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.first("room").alias("room"))
            upto = Window.partitionBy(BLOCK).orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            cuts = cuts.withColumn("left", F.col("room") - (F.sum("words").over(upto) - F.col("words"))).where("left > 0")
            cuts = stored(cuts.select(*BLOCK, "cut", "left", "words", "n"), "mix-pieces")
            rows = rows.drop("room", "docs").join(cuts, [*BLOCK, "cut"])
            found.append(rows.where("left >= words").select(*UNIT, "size"))
            rows = rows.where("left < words").select(*UNIT, "size", F.col("left").alias("room"), F.col("n").alias("docs"))
        found.append(rows.groupBy(BLOCK).applyInPandas(choose, taken.schema))
        if first:
            blocks = sums.where("all").select(BLOCK)
            n_blocks = blocks.count()
        got = stored(found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]), "mix-taken")
        words = got.groupBy("source_key").agg(F.sum("size").alias("words")).unionByName(sums.where("all").groupBy("source_key").agg(F.sum("words").alias("words")))
        gained = {r["source_key"]: r["words"] for r in words.groupBy("source_key").agg(F.sum("words").alias("words")).collect()}
        for s in todo:
            rooms[s] -= gained.get(s, 0)
        taken = taken.unionByName(got)
        n_taken += got.count()
        todo, first = {s: rooms[s] for s in todo if gained.get(s, 0) > 0 and rooms[s] >= 1}, False
    return blocks, taken, rooms


def mixed_rows(docs: DataFrame, found: Mix, n_shards: int, seed: int = SEED) -> DataFrame:
    """The mix itself: every chosen row of docs once for each use, dealt to its shards and shuffled within them."""
    names = docs.columns
    used = found.docs.where("copies > 0").select("h", "source_key", "block", "copies").distinct()
    uses = used.join(found.shards, ["source_key", "block"]).where("copy < copies").groupBy("source_key", "h").agg(F.collect_list(F.struct("copy", "shard")).alias("__uses"))
    keyed = docs.withColumn("__mix_h", F.xxhash64(F.lit(seed), F.col("doc_id"))).withColumn("__mix_source", source_key())
    uses = uses.withColumnsRenamed({"source_key": "__mix_source", "h": "__mix_h"})
    # Uses grow with the documents: no hint, so that the driver holds them only where Spark finds them small.
    rows = keyed.join(uses, ["__mix_source", "__mix_h"])
    rows = rows.withColumn("__use", F.explode("__uses")).withColumn("__shard", F.col("__use.shard")).withColumn("__order", F.xxhash64("__mix_h", "__use.copy", F.lit(seed + 1)))
    return rows.repartition(n_shards, "__shard").sortWithinPartitions("__shard", "__order").select(*names)
