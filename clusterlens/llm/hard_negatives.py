"""Hard negatives by exact inner products, with length buckets and coordinate pruning in the manner of LEMP.

All rows are dealt by falling vector length into buckets of bounded size.
A bucket is one stored row: the integer vectors, and for each coordinate the
list of its rows sorted by that coordinate of the normalised vector. Anchors
are packed in blocks of their own and meet every bucket that their score
bounds allow, two blocks at a time, so neither side is ever held whole.

Within a pair of blocks, an anchor q that asks for scores from s on needs a
cosine of at least t = s / (|q| x longest of the bucket). That bounds each
coordinate of a partner: the anchor's focus coordinates (the largest of its
normalised vector) give ranges in the sorted lists, whose rows are
intersected; what remains is verified by the exact integer product. Where a
bound excludes little, all rows of the bucket are candidates and are verified
by one blocked product. Nothing is capped or approximated.

Positives come first: the bucket of longest vectors of the anchor's label
gives a first score bound, with which the other buckets are searched. The
positives' scores then bound the search for negatives, in buckets over all
labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterlens.llm.common import ship, stored

#: A bucket holds at most so many rows, and so many vector components; a block of anchors so many rows.
BUCKET_ROWS, BUCKET_CELLS, ANCHOR_ROWS = 1 << 15, 1 << 22, 1 << 11
#: From so many rows on, a bucket ends where vectors get shorter than this share of its longest.
FULL_ENOUGH, LENGTH_SHARE = 256, 0.9
#: Coordinates whose ranges are intersected for an anchor.
FOCUS = 4
#: Ranges that keep more than this share of a bucket's rows are not worth intersecting.
WORTH = 0.25
#: Anchors of one blocked product.
PRODUCT_ROWS = 64
#: Room for rounding in bounds; candidates are verified exactly.
SLACK = 1e-9
#: Marks a missing score bound.
NONE = np.iinfo(np.int64).min

PACKED = "dim int, part long, block long, n int, top double, reach double, rids binary, ids binary, nulls binary, labels binary, bounds binary, targets array<array<long>>, kind string, vectors binary, lists binary"
FOUND = "a_rid long, target long, rid long, vec_id long, score long"


def whole_components(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, taken as double; null for a vector that is null or holds null or non-finite ones."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


# ---- blocks -------------------------------------------------------------------------------------


def _packed_row(rows: dict[str, np.ndarray], dim: int, part: int, block: int, lists: bool, targets: list[list[int]]) -> pa.RecordBatch:
    vectors, length = rows["vectors"], np.sqrt(rows["len2"].astype(np.float64))
    largest = int(np.abs(vectors).max(initial=0))
    kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
    order = b""
    if lists:
        unit = vectors / np.where(length > 0, length, 1)[:, None]
        order = np.argsort(unit, axis=0, kind="stable").T.astype("<u2").tobytes()
    bound = rows["bounds"]
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = np.where((bound > 0) & (length > 0), bound / length, np.where((bound > 0), np.inf, -np.inf))
    value = {
        "dim": dim, "part": part, "block": block, "n": len(vectors), "top": float(length.max(initial=0)), "reach": float(reach.min(initial=np.inf)),
        "rids": rows["rid"].tobytes(), "ids": rows["ids"].tobytes(), "nulls": rows["nulls"].tobytes(), "labels": rows["label"].tobytes(), "bounds": bound.tobytes(),
        "targets": targets, "kind": kind, "vectors": vectors.astype(kind).tobytes(), "lists": order,
    }
    kinds = {"dim": pa.int32(), "n": pa.int32(), "part": pa.int64(), "block": pa.int64(), "targets": pa.list_(pa.list_(pa.int64()))}
    return pa.RecordBatch.from_pydict({k: pa.array([v], kinds.get(k)) for k, v in value.items()})


def _pack(rows: DataFrame, most: int, lists: bool) -> DataFrame:
    """Stored blocks of ``rows`` (rid, vec_id, label, part, vector, bound, targets), by dimensions, part and falling length."""
    columns = ["dim", "part", "len2", "rid", "vec_id", "label", "bound", "targets", "vector"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        key, size, first = None, 0, 0.0
        number = TaskContext.get().partitionId() << 33

        def close() -> pa.RecordBatch:
            nonlocal held, size, number
            joined = {k: np.concatenate(v) for k, v in held.items() if k != "targets"}
            out = _packed_row(joined, *key, number, lists, sum(held["targets"], []))
            held, size, number = {}, 0, number + 1
            return out

        for batch in batches:
            dims, parts, len2 = (batch.column(c).to_numpy() for c in ("dim", "part", "len2"))
            ends = np.flatnonzero((np.diff(dims) != 0) | (np.diff(parts) != 0)) + 1
            for a, b in zip([0, *ends], [*ends, batch.num_rows], strict=True):
                if a == b:
                    continue
                now = (int(dims[a]), int(parts[a]))
                if size and now != key:
                    yield close()
                key = now
                dim, limit = key[0], max(1, min(most, BUCKET_CELLS // max(1, key[0])))
                vectors = batch.column("vector").slice(a, b - a).flatten().to_numpy().reshape(b - a, dim)
                ids = batch.column("vec_id").slice(a, b - a)
                cols = {
                    "vectors": vectors, "len2": len2[a:b], "rid": batch.column("rid").to_numpy()[a:b], "ids": ids.fill_null(0).to_numpy(), "nulls": ids.is_null().to_numpy(zero_copy_only=False),
                    "label": batch.column("label").to_numpy()[a:b], "bounds": batch.column("bound").slice(a, b - a).fill_null(NONE).to_numpy(),
                }
                targets = [t or [] for t in batch.column("targets").slice(a, b - a).to_pylist()]
                at = 0
                while at < b - a:
                    if not size:
                        first = float(cols["len2"][at])
                    end = min(b - a, at + limit - size)
                    short = int(np.searchsorted(-cols["len2"].astype(np.float64), -first * LENGTH_SHARE**2, "right"))  # lengths fall
                    end = min(end, max(short, at + FULL_ENOUGH - size, at))
                    if end == at:
                        yield close()
                        continue
                    for c, v in cols.items():
                        held.setdefault(c, []).append(v[at:end])
                    held.setdefault("targets", []).append(targets[at:end])
                    size, at = size + end - at, end
                    if size >= limit:
                        yield close()
        if size:
            yield close()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("dim"), F.col("part"), F.col("len2").desc(), F.col("vec_id"), F.col("rid")]
    dealt = rows.select(columns).repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(pack, PACKED), "length-buckets")


class Block:
    """A packed block, unpacked."""

    def __init__(self, row: dict):
        self.dim, self.n, self.top = row["dim"], row["n"], row["top"]
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(self.n, self.dim)
        self.rid, self.ids, self.label, self.bounds = (np.frombuffer(row[c], "<i8") for c in ("rids", "ids", "labels", "bounds"))
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.targets = row["targets"]
        self.lists = np.frombuffer(row["lists"], "<u2").reshape(self.dim, self.n) if row["lists"] else None
        self.length = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))
        self.unit = self.vectors / np.where(self.length > 0, self.length, 1)[:, None]

    def exact(self, other: "Block") -> type:
        """The number type in which products with the other block are exact."""
        return np.float64 if self.top * other.top < 1 << 52 else np.int64


def candidates(anchors: Block, rows: Block) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Of each anchor whose ranges exclude enough, the rows in all its ranges; and the anchors that need all rows.

    Anchors in neither reach no row of the bucket.
    """
    bound = anchors.bounds.astype(np.float64)
    bounded = (anchors.bounds > 0) & (anchors.length > 0)
    # A bound above 0 needs a longer vector than the zero vector; without one, all rows are candidates.
    needed = np.divide(bound, anchors.length * rows.top, out=np.full(anchors.n, np.inf), where=bounded & (rows.top > 0))
    everything = np.flatnonzero(anchors.bounds <= 0)
    some = np.flatnonzero(bounded & (needed <= 1 + SLACK))
    if not len(some) or not rows.dim or rows.lists is None:
        return {}, np.concatenate((everything, some))
    spread = np.arccos(np.clip(needed[some], -1, 1))
    focus = np.argsort(-np.abs(anchors.unit[some]), axis=1, kind="stable")[:, :FOCUS]
    angle = np.arccos(np.clip(np.take_along_axis(anchors.unit[some], focus, 1), -1, 1))
    low = np.cos(np.minimum(np.pi, angle + spread[:, None])) - SLACK
    high = np.cos(np.maximum(0, angle - spread[:, None])) + SLACK
    begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus):
        own = focus == f
        values = rows.unit[rows.lists[f], f]
        begin[own], end[own] = np.searchsorted(values, low[own], "left"), np.searchsorted(values, high[own], "right")
    least = np.argmin(end - begin, axis=1)
    count = np.take_along_axis(end - begin, least[:, None], 1)[:, 0]
    found = {}
    for k in np.flatnonzero(count <= WORTH * rows.n):
        f, c = focus[k], least[k]
        at = rows.lists[f[c], begin[k, c] : end[k, c]].astype(np.int64)
        for other in range(focus.shape[1]):
            if other != c and len(at):
                values = rows.unit[at, f[other]]
                at = at[(values >= low[k, other]) & (values <= high[k, other])]
        found[int(some[k])] = at
    return found, np.concatenate((everything, some[count > WORTH * rows.n]))


def _best(at: np.ndarray, scores: np.ndarray, rows: Block, k: int) -> np.ndarray:
    """Places of the k first: by falling score, then by smaller vec_id (null last), then by row."""
    if len(at) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        at, scores = at[keep], scores[keep]
    order = np.lexsort((rows.rid[at], rows.ids[at], rows.nulls[at], -scores))[:k]
    return at[order]


def partners(anchors: Block, rows: Block, k: int, same_label: bool) -> dict[str, np.ndarray]:
    """What the bucket has for each anchor: its k best rows (``same_label``), or the k best within each of its targets.

    Targets are triples: the positive's score, the least and the highest score of its negatives.
    """
    kind = anchors.exact(rows)
    left, right = anchors.vectors.astype(kind), rows.vectors.astype(kind)
    out: dict[str, list] = {c: [] for c in ("a", "target", "at", "score")}

    def take(a: int, at: np.ndarray, scores: np.ndarray) -> None:
        allowed = rows.rid[at] != anchors.rid[a] if same_label else rows.label[at] != anchors.label[a]
        if anchors.bounds[a] != NONE:
            allowed &= scores >= anchors.bounds[a]
        at, scores = at[allowed], scores[allowed].astype(np.int64)
        targets = anchors.targets[a]
        ranges = [(0, None, None)] if same_label else zip(targets[::3], targets[1::3], targets[2::3], strict=True)
        for target, low, high in ranges:
            inside = slice(None) if low is None else (scores >= low) & (scores <= high)
            mine, own = at[inside], scores[inside]
            if len(mine):
                best = _best(mine, own, rows, k)
                out["a"].append(np.full(len(best), a))
                out["target"].append(np.full(len(best), target))
                out["at"].append(best)
                out["score"].append((right[best] @ left[a]).astype(np.int64))

    few, everything = candidates(anchors, rows)
    for a, at in few.items():
        if len(at):
            take(a, at, right[at] @ left[a])
    whole = np.arange(rows.n)
    for start in range(0, len(everything), PRODUCT_ROWS):
        some = everything[start : start + PRODUCT_ROWS]
        for a, scores in zip(some.tolist(), left[some] @ right.T, strict=True):
            take(a, whole, scores)
    if not out["a"]:
        return {c: np.empty(0, np.int64) for c in out}
    return {c: np.concatenate(v) for c, v in out.items()}


# ---- the search ---------------------------------------------------------------------------------


def _search(anchors: DataFrame, buckets: DataFrame, k: int, same_label: bool, numbers: str) -> DataFrame:
    """Every anchor block against the buckets of its dimensions and part that its bounds reach.

    ``numbers`` picks buckets by their place in falling length: 'first', 'rest' or 'all'.
    """
    keys = ["dim", "part"]
    meta = buckets.select(*keys, "block", "top")
    # Only blocks are numbered here, not rows.
    numbered = meta.withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("top"), "block")))
    counts = meta.groupBy(*keys).agg(F.count("*").cast("int").alias("blocks"))
    last = F.lit(1) if numbers == "first" else F.col("blocks")
    first = F.lit(2) if numbers == "rest" else F.lit(1)
    own = anchors.select(*keys, F.col("block").alias("a_block"), "reach").join(counts, keys)
    pairs = (
        own.where(first <= last)
        .select(*keys, "a_block", "reach", F.explode(F.sequence(first, last)).alias("number"))
        .join(numbered, [*keys, "number"])
        .where(F.col("top") * (1 + SLACK) >= F.col("reach"))
        .select("a_block", "block")
    )

    def data(df: DataFrame, name: str, block: str) -> DataFrame:
        fields = [c for c in df.columns if c not in ("part", "block")]
        return df.select(F.col("block").alias(block), F.struct(*fields).alias(name))

    both = pairs.join(data(anchors, "anchors", "a_block"), "a_block").join(data(buckets, "rows", "block"), "block").select("anchors", "rows")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_row in range(batch.num_rows):
                left, right = (Block(batch.column(c)[k_row].as_py()) for c in ("anchors", "rows"))
                found = partners(left, right, k, same_label)
                at = found["at"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "a_rid": pa.array(left.rid[found["a"]]),
                        "target": pa.array(found["target"], pa.int64()),
                        "rid": pa.array(right.rid[at]),
                        "vec_id": pa.array(right.ids[at], mask=right.nulls[at]),
                        "score": pa.array(found["score"], pa.int64()),
                    }
                )

    return both.mapInArrow(verify, FOUND)


def _first_k(found: DataFrame, k: int) -> DataFrame:
    """The k first of every anchor and target, numbered from 1."""
    order = Window.partitionBy("a_rid", "target").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id long, label integer, vector array<long>) that ``is_anchor`` picks.

    A row's score is its inner product with the anchor; higher scores come
    first, ties by smaller vec_id (null last). An anchor's positives are its
    first ``n_positives`` other rows of the same label. For each positive the
    first ``n_negatives`` rows of other labels with low * positive_score <=
    100 * score <= high * positive_score are returned: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a null label, vector or component take no part. Rows are told
    apart by place, not by id: a repeated row is another row, so it can be
    the positive of its copy, and each copy of an anchor is an anchor. Only
    vectors with equally many components meet. An anchor without positives,
    a positive without rows in its range, and an empty table give no rows.
    Squared lengths must fit a long (else the job fails with an overflow).
    """
    ship(vectors.sparkSession)
    whole = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    rows = stored(
        vectors.select("vec_id", F.col("label").cast("long").alias("label"), "vector", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
        .where(whole)
        .select(
            F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "vector", "anchor", F.size("vector").alias("dim"),
            F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("len2"),
        ),
        "vectors",
    )
    unbound = [F.lit(None).cast("long").alias("bound"), F.lit(None).cast("array<long>").alias("targets")]
    plain = ["rid", "vec_id", "label", "vector", "dim", "len2"]
    anchors = rows.where("anchor").select(*plain, F.col("label").alias("part"))

    # Positives: the longest bucket of the label gives the bound for the others.
    own_label = _pack(rows.select(*plain, F.col("label").alias("part"), *unbound), BUCKET_ROWS, True)
    first = stored(_first_k(_search(_pack(anchors.select("*", *unbound), ANCHOR_ROWS, False), own_label, n_positives, True, "first"), n_positives), "first-positives")
    known = first.groupBy("a_rid").agg(F.min(F.when(F.col("rank") == n_positives, F.col("score"))).alias("bound"))
    bounded = anchors.join(known.withColumnRenamed("a_rid", "rid"), "rid", "left").withColumn("targets", F.lit(None).cast("array<long>"))
    rest = _search(_pack(bounded, ANCHOR_ROWS, False), own_label, n_positives, True, "rest")
    positives = stored(_first_k(first.drop("rank").unionByName(rest), n_positives), "positives")

    # Negatives: the whole-numbered range of each positive's score, rounded inwards; a range may be empty.
    positives = positives.select("a_rid", F.col("vec_id").alias("positive_id"), F.col("rid").alias("p_rid"), F.col("score").alias("positive_score"))
    # score * share / 100 by hundreds and rest, as the product itself may not fit a long
    hundreds, rest = F.expr("positive_score div 100"), F.col("positive_score") % 100
    up, down = hundreds * low + F.ceil(rest * low / 100), hundreds * high + F.floor(rest * high / 100)
    ranged = positives.select("*", up.alias("least"), down.alias("most")).where("least <= most")
    asked = (
        ranged.select("a_rid", "positive_score", "least", "most").distinct()
        .groupBy(F.col("a_rid").alias("rid"))
        .agg(F.min("least").alias("bound"), F.flatten(F.sort_array(F.collect_list(F.array("positive_score", "least", "most")))).alias("targets"))
    )
    asking = anchors.drop("part").join(asked, "rid").withColumn("part", F.lit(0).cast("long"))
    all_labels = _pack(rows.select(*plain, F.lit(0).cast("long").alias("part"), *unbound), BUCKET_ROWS, True)
    negatives = _first_k(_search(_pack(asking, ANCHOR_ROWS, False), all_labels, n_negatives, False, "all"), n_negatives)
    found = ranged.join(negatives.select("a_rid", F.col("target").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), ["a_rid", "positive_score"])
    names = rows.where("anchor").select(F.col("rid").alias("a_rid"), F.col("vec_id").alias("anchor_id"))
    return found.join(names, "a_rid").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
