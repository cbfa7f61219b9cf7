"""N-gram Jaccard join by token-combination prefixes.

Tokens are the 64-bit hashes of a document's distinct 5-word shingles. They
fall into two classes by document frequency: rare tokens are indexed alone,
frequent ones in pairs. All documents order their tokens alike (rare before
frequent, each class by hash). A document of n tokens may miss n // 4 of them
in a partner of similarity 3/4, so a prefix with n // 4 + 1 rare tokens shares
one of them with every partner. Where rare tokens run out, the prefix is
extended into the frequent ones: these are dealt into subclasses by hash, and
each token behind the first of its subclass counts once, so with enough of
them some subclass keeps two common tokens, and that pair is indexed. The
number of subclasses follows the size level (levels grow by 4/3, and partners
lie at most one level apart, so every document signs for its own level and
the one below).

Documents with equal token sets are one node. Of nodes that share a signature
and whose sizes allow the similarity, first every node is compared with one
centre of its signature. Of signatures that still hold different components,
crowded ones make families, of which the nodes outside the largest component
meet all others once, in blocks, however many signatures they share; of the
rest every pair across components is compared. Pairs inside one component can
change nothing, so most of a group of near copies costs one verification a
node, and no link is lost. Every node has a parity bitmap, a few bits a token: two
bitmaps differ in no more bits than their token sets do, so a pair whose
bitmaps differ too much is no link. The pairs that pass are verified, exactly,
on their texts, and only those texts are fetched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterlens.llm.common import gathered, give_back, join_ids, shuffles_removed, small_batches, stored, utf8, words_of

SHINGLE = 5
#: Similarity of linked documents: at least 75 hundredths.
PERCENT = 75
#: A token is frequent in so many documents, or in this share of all documents if that is more. The share bounds the
#: broadcast list of frequent tokens: mean tokens per document / share, whatever the corpus. It is that small because tokens
#: below it are indexed alone: what more than CROWDED documents share alone makes families, which are compared in blocks.
FREQUENT, FREQUENT_SHARE = 64, 1e-5
#: Frequencies are counted in 2^28 cells; the tokens of other cells add noise of 2^-28 of all tokens, below a fifth of the share.
CELL_BITS, BUCKET_BITS = 28, 8
#: Signatures keep 48 bits: colliding ones only add candidates.
SIGNATURE = np.uint64((1 << 48) - 1)
#: Documents of fewer tokens sign every token alone.
SMALL = 8
#: Texts analysed together up to about so many characters: what was made of 4 << 20 took some 190 MB of a worker.
BATCH_CHARS = 1 << 19
#: Cells counted together by one task before they are sent.
CHUNK_CELLS = 2_000_000
#: Open signatures of more nodes make families, whose nodes are compared once; of others every pair is.
CROWDED = 64
#: Partners that a node of a family tries first, in each block.
NEAREST = 3
#: Nodes of a family in one block, on average: what one comparing task holds.
FAMILY_BLOCK = 128

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def token_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct tokens of each text: 5-word shingles with A-Z lower-cased; of fewer words the whole sequence; none without words."""
    words = words_of([t.lower() for t in texts])  # bytes.lower() lowers A-Z alone
    named = np.fromiter(map(xxhash.xxh3_64_intdigest, words.distinct), np.uint64, len(words.distinct))
    hashes = named[words.codes] if len(words.codes) else np.empty(0, np.uint64)
    out = []
    with np.errstate(over="ignore"):
        run = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            run = _mix(run * _A + hashes[k : k + len(run)] + _B)
        for a, b in zip(words.starts[:-1], words.starts[1:], strict=True):
            if b - a >= SHINGLE:
                out.append(np.unique(run[a : b - SHINGLE + 1]))
            elif b > a:
                short = np.array([b - a], np.uint64) * _C
                for k in range(a, b):
                    short = _mix(short * _A + hashes[k : k + 1] + _C)
                out.append(short)
            else:
                out.append(np.empty(0, np.uint64))
    return out


def set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def parity(tokens: np.ndarray) -> bytes:
    """Bitmap of 2 to 4 bits a token (64 at least): each token flips the bit that its hash names."""
    bits = 1 << max(6, (2 * len(tokens) - 1).bit_length())
    with np.errstate(over="ignore"):
        at = (_mix(tokens * _B) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) as they were with fewer bits: places alike in their low bits fall together."""
    return np.bitwise_xor.reduce(bitmaps.reshape(len(bitmaps), -1, words), axis=1)


def _near(differ: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets of so many tokens together that differ in so many at least can be similar enough."""
    return differ * (100 + PERCENT) <= sizes * (100 - PERCENT)


def _levels() -> np.ndarray:
    """The least size of each level: each more than 4/3 of the one before."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 4 // 3 + 1)
    return np.array(out, np.int64)


LEVELS = _levels()


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, bool]:
    """The signatures of one document, and whether they are single rare tokens alone; ``frequent`` holds the frequent cells, sorted."""
    n = len(tokens)
    if not n:
        return tokens, False
    need = n // 4 + 1
    often = np.zeros(n, bool)
    if len(frequent):
        cells = (tokens >> np.uint64(64 - CELL_BITS)).astype(np.uint32)
        often = frequent[np.minimum(np.searchsorted(frequent, cells), len(frequent) - 1)] == cells
    rare = tokens[~often][:need]
    out = [rare]
    need -= len(rare)
    if need:
        common = tokens[often]
        level = int(np.searchsorted(LEVELS, n, "right")) - 1
        with np.errstate(over="ignore"):
            spread = _mix(common * _C)
            for at in {level, max(0, level - 1)}:
                least = int(LEVELS[at])
                if least < SMALL:
                    out.append(common[:need])
                    continue
                own = (spread % np.uint64(max(1, least // 8))).astype(np.int64)
                _, first = np.unique(own, return_index=True)
                counted = np.ones(len(common), np.int64)
                counted[first] = 0
                upto = int(np.searchsorted(np.cumsum(counted), need)) + 1
                order = np.argsort(own[:upto], kind="stable")
                part, token = own[:upto][order], common[:upto][order]
                for gap in range(1, upto):  # pairs of one subclass lie side by side
                    same = part[gap:] == part[:-gap]
                    if not same.any():
                        break
                    out.append(_mix(token[:-gap][same] * _A + token[gap:][same] * _B + np.uint64(at + 1)))
    return np.unique(np.concatenate(out) & SIGNATURE), not need


def frequent_cells(docs: DataFrame, least: int) -> np.ndarray:
    """Sorted cells of the tokens that ``least`` documents or more hold.

    Tasks send sorted, packed cell numbers; a counting task holds one bucket's
    dense counters (4 MB) and streams through what it gets, so its memory does
    not grow. Only frequent cells reach the driver, of which there are at most
    (tokens of all documents) / least.
    """
    shift, width = np.uint64(64 - CELL_BITS), CELL_BITS - BUCKET_BITS

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total = [], 0
        pack = zstandard.ZstdCompressor(level=1).compress

        def packed() -> pd.DataFrame:
            cells = np.sort(np.concatenate(held))
            cuts = np.searchsorted(cells, np.arange((1 << BUCKET_BITS) + 1, dtype=np.uint64) << np.uint64(width))
            rows = [(k, pack(np.diff(cells[a:b].astype(np.uint32), prepend=np.uint32(k << width)).tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            return pd.DataFrame(rows, columns=["bucket", "cells"])

        for batch in gathered(batches, "text", BATCH_CHARS):
            for tokens in token_sets([utf8(t) for t in batch["text"]]):
                held.append(tokens >> shift)
                total += len(tokens)
            if total >= CHUNK_CELLS:
                yield packed()
                held, total = [], 0
        if total:
            yield packed()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        bucket, counts = -1, np.zeros(1 << width, np.uint32)

        def often() -> pd.DataFrame:
            return pd.DataFrame({"cell": np.flatnonzero(counts >= least) + (bucket << width)})

        for batch in batches:
            for k, blob in zip(batch["bucket"], batch["cells"], strict=True):
                if k != bucket:
                    if bucket >= 0:
                        yield often()
                    bucket = int(k)
                    counts[:] = 0
                cells = np.cumsum(np.frombuffer(unpack(blob), np.uint32), dtype=np.int64)
                np.add.at(counts, cells, 1)
        if bucket >= 0:
            yield often()

    sent = docs.select("text").mapInPandas(send, "bucket int, cells binary")
    found = sent.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(count, "cell long")
    with shuffles_removed(docs.sparkSession):
        cells = found.toPandas()["cell"].to_numpy(np.int64)
    return np.sort(cells).astype(np.uint32)


def least_frequency(n_docs: int) -> int:
    """In how many of so many documents a token is frequent."""
    return max(FREQUENT, int(np.ceil(FREQUENT_SHARE * n_docs)))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node of each node's component, for the nodes of (a, b) edges. Large-star and small-star rounds."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        now = stored(now, "components")
        # Done when all are stars: every node has one lesser node, which has none itself.
        ends = now.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(now.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _sizes_fit(a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})"


def _with(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b) pairs with columns of both nodes: <column>_a and <column>_b."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
    return pairs


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The (a, b) pairs that the bitmaps of ``nodes`` (node, n, parity) do not rule out."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for k, (x, y) in enumerate(zip(batch["parity_a"], batch["parity_b"], strict=True)):
                words = min(len(x), len(y)) // 8
                x, y = (folded(np.frombuffer(z, np.uint64)[None, :], words) for z in (x, y))
                keep[k] = _near(np.bitwise_count(x ^ y).sum(dtype=np.int64), batch["n_a"].iloc[k] + batch["n_b"].iloc[k])
            yield batch.loc[keep, ["a", "b"]]

    return _with(pairs, nodes, ["n", "parity"]).mapInPandas(check, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) pairs whose token sets are similar enough, computed from ``texts`` (node, packed)."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        centre: tuple[int | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            texts = dict(zip(batch["a"], batch["packed_a"], strict=True)) | dict(zip(batch["b"], batch["packed_b"], strict=True))
            if centre[0] in texts:
                texts.pop(centre[0])
            own = dict(zip(texts, token_sets([unpack(bytes(t)) for t in texts.values()]), strict=True)) | {centre[0]: centre[1]}
            linked = []
            for a, b in zip(batch["a"], batch["b"], strict=True):
                x, y = own[a], own[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
            if len(batch):
                last = batch["b"].iloc[-1]
                centre = (last, own[last])
            yield batch.loc[linked, ["a", "b"]]
        give_back()

    return _with(pairs, texts, ["packed"]).mapInPandas(check, "a long, b long")


def packed_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, packed): one compressed text of each of ``nodes`` (node, first), which is stored."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=3).compress
        for batch in gathered(batches, "text", BATCH_CHARS):
            texts = [utf8(t) for t in batch["text"]]
            rows = [(set_id(s), packer(t)) for t, s in zip(texts, token_sets(texts), strict=True) if len(s)]
            yield pd.DataFrame(rows, columns=["node", "packed"])

    n = nodes.count()
    ids = nodes.select(F.col("first").alias("doc_id")).where("doc_id is not null").distinct()
    own = join_ids(docs, ids, ["doc_id"], "left_semi", n)
    if n > nodes.where("first is not null").count():
        own = own.unionByName(docs.where("doc_id is null"))
    return join_ids(own.select("text").mapInPandas(pack, "node long, packed binary"), nodes.select("node"), ["node"], "left_semi", n).dropDuplicates(["node"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_shingles, component_id, node, component, text_key.

    component_id is the smallest doc_id reachable by links. Texts that are
    null, empty or white space have no shingles and no links; their
    component_id is their own doc_id. Rows of equal shingle sets (copies,
    repeated rows) link with each other. Null doc_ids are never the smallest
    while a component has another. ``component`` is alike for linked rows, ``text_key`` is a hash of the text. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    n_docs = docs.count()
    frequent = frequent_cells(docs, least_frequency(n_docs))
    shared = spark.sparkContext.broadcast(frequent)

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in gathered(batches, "text", BATCH_CHARS):
            sets = token_sets([utf8(t) for t in batch["text"]])
            node = pd.array([set_id(t) if len(t) else None for t in sets], dtype="Int64")
            yield pd.DataFrame({"doc_key": batch["doc_key"], "text_key": batch["text_key"], "n_shingles": [len(t) for t in sets], "node": node, "parity": [parity(t) if len(t) else None for t in sets]})

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # of this task's documents: a group of copies sends its signatures once a task
        for batch in gathered(batches, "text", BATCH_CHARS):
            sigs, nodes, sizes, counts = [], [], [], []
            for tokens in token_sets([utf8(t) for t in batch["text"]]):
                if len(tokens) and (node := set_id(tokens)) not in seen:
                    seen.add(node)
                    own, _ = signatures(tokens, shared.value)
                    sigs.append(own.astype(np.int64))
                    nodes.append(node)
                    sizes.append(len(own))
                    counts.append(len(tokens))
            if sigs:
                yield pd.DataFrame({"sig": np.concatenate(sigs), "node": np.repeat(np.array(nodes, np.int64), sizes), "n": np.repeat(np.array(counts, np.int32), sizes)})

    # ids pass pandas as text: beside a null, a batch of integers would become floats, which round those from 2^53 on
    id_type = docs.schema["doc_id"].dataType
    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_key"), F.xxhash64("text").alias("text_key"), "text")
    named = keyed.mapInPandas(name, "doc_key string, text_key long, n_shingles long, node long, parity binary")
    members = stored(named.select(F.col("doc_key").cast(id_type).alias("doc_id"), "text_key", "n_shingles", "node", "parity"), "members")

    # A posting is live if a neighbour by size is another node of fitting size.
    by_size = Window.partitionBy("sig").orderBy("n", "node")
    index = docs.select("text").mapInPandas(sign, "sig long, node long, n int")
    for side, step in (("before", F.lag), ("behind", F.lead)):
        index = index.withColumn(side, step(F.struct("node", "n")).over(by_size))
    fits = " or ".join(f"({x}.node <> node and {_sizes_fit('n', x + '.n')})" for x in ("before", "behind"))
    live = stored(index.where(fits).select("sig", "node", "n").distinct(), "live-signatures")
    worded = members.where("n_shingles > 0")
    by_node = worded.groupBy("node").agg(F.min("doc_id").alias("first"))
    maps = worded.join(live.select("node").distinct(), "node", "left_semi").select("node", F.col("n_shingles").alias("n"), "parity").dropDuplicates(["node"])
    chosen = stored(maps.join(by_node, "node"), "live-nodes")
    labels = _link(live, chosen, docs)
    least = chosen.join(labels, "node").groupBy("comp").agg(F.min("first").alias("least"))
    placed = labels.join(least, "comp").select("node", "least", "comp")
    node_ids = by_node.select("node", "first").join(placed, "node", "left")
    node_ids = node_ids.select("node", F.coalesce("least", "first").alias("component_id"), F.coalesce("comp", "node").alias("component"))
    shown = ["doc_id", "n_shingles", "component_id", "node", "component", "text_key"]
    no_words = members.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).withColumn("component", F.col("node"))
    return worded.join(node_ids, "node").select(shown).unionByName(no_words.select(shown))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the one with the smallest doc_id stays.

    Rows go by id and text, not by id alone: of two rows of one id whose texts link, one stays (that of the smaller text
    hash), and a row whose id is also that of a duplicate, with a text of its own, stays, too. A row without an id goes
    if its component has a row with one; of a component without any, one row stays. Rows equal in id and text stay or
    go together. Texts without words are no duplicates.
    """
    found = near_duplicates(docs).where("n_shingles > 0")
    # Candidates to stay are few: one row of each component, but for repeated ids and components without any id.
    first = found.where("doc_id <=> component_id")
    stays = first.groupBy("component").agg(F.min("text_key").alias("stay_key"))
    others = first.join(stays, "component").where("text_key <> stay_key").select("doc_id", "text_key")
    gone = found.where("not (doc_id <=> component_id)").select("doc_id", "text_key").unionByName(others)
    gone = stored(gone.distinct().withColumnsRenamed({"doc_id": "__id", "text_key": "__key"}), "near-duplicates")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__key"]), "left_anti")


def _link(live: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, comp) of all linked nodes, out of the signatures (sig, node, n) that several nodes share; ``nodes``: (node, n, parity, first)."""

    def links(pairs: DataFrame, name: str) -> DataFrame:
        tried = stored(pairs, f"{name}-pairs")
        ends = tried.select(F.col("a").alias("node")).unionByName(tried.select(F.col("b").alias("node"))).distinct()
        fetched = stored(nodes.join(ends, "node", "left_semi").select("node", "first"), f"{name}-nodes")
        return stored(verified(tried, packed_texts(docs, fetched)), f"{name}-links")

    # Every node against its signature's centre. The centre is the least node, so most signatures of a group share it.
    centre = live.groupBy("sig").agg(F.min(F.struct("node", "n")).alias("c"))
    pairs = live.join(centre, "sig").where("node <> c.node").where(_sizes_fit("n", "c.n")).select(F.col("node").alias("a"), F.col("c.node").alias("b"))
    edges = links(plausible(pairs.distinct(), nodes), "centre")
    labels = components(edges)

    # What is left open: signatures of three nodes or more in different components (two nodes have just been compared).
    now = _with_component(live, labels)
    spans = now.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo < hi and m > 2").select("sig", "m")
    now = stored(now.join(spans, "sig"), "open-signatures")
    if now.isEmpty():
        return labels

    # Families: nodes that crowded open signatures connect. A family is compared once, however many signatures it shares.
    crowded = now.where(F.col("m") > CROWDED)
    first = crowded.groupBy("sig").agg(F.min("node").alias("b"))
    families = components(crowded.join(first, "sig").select(F.col("node").alias("a"), "b")).select("node", F.col("comp").alias("family"))
    sized = crowded.select("node", "n").distinct().join(families, "node").join(nodes.select("node", "parity"), "node")
    sized = stored(sized, "family-nodes")
    # Each node outside a family's largest component first meets its nearest ones in every block: as a rule one of them
    # is a link, and then the node's other pairs can change nothing. What still is outside meets all others.
    if not sized.isEmpty():
        edges = stored(edges.unionByName(links(_family_pairs(sized, labels, NEAREST), "nearest")), "links")
        labels = components(edges)
    more = _family_pairs(sized, labels, None)

    # All other open signatures hold CROWDED nodes at most, so pairs of a signature stay in proportion to its nodes.
    rest = _with_component(now.where(F.col("m") <= CROWDED).select("sig", "node", "n"), labels).join(families, "node", "left")
    other = rest.select("sig", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("comp").alias("cy"), F.col("family").alias("fy"))
    met = rest.join(other, "sig").where("comp < cy and not coalesce(family = fy, false)").where(_sizes_fit("n", "ny"))
    pairs = met.select(F.greatest("node", "y").alias("a"), F.least("node", "y").alias("b")).distinct()
    return components(edges.unionByName(links(plausible(pairs, nodes).unionByName(more), "rest")))


def _with_component(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``nodes`` with their component: by ``labels`` (node, comp), else their own."""
    return nodes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _family_pairs(sized: DataFrame, labels: DataFrame, nearest: int | None) -> DataFrame:
    """(a, b) pairs across components of each family of ``sized`` (node, n, family, parity) that the bitmaps allow.

    Of each node at most the ``nearest`` ones in every block, if given. Most of a family is one component by now. Its
    nodes need not meet each other, only the family's other nodes do, so they are dealt in blocks of their own.
    """
    members = _with_component(sized, labels)
    sizes = members.groupBy("family", "comp").agg(F.count("*").alias("s"))
    main = sizes.groupBy("family").agg(F.max(F.struct("s", "comp")).alias("main"), F.sum("s").alias("s"))
    blocks = lambda s: F.ceil(s / FAMILY_BLOCK).cast("int")
    own_blocks = main.select("family", F.col("main.comp").alias("main"), blocks(F.col("main.s")).alias("g"), blocks(F.col("s") - F.col("main.s")).alias("o")).where("o > 0")
    dealt = members.join(own_blocks, "family")
    block = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    cols = ["family", "among", "lo", "hi", "left", "node", "n", "comp", "parity"]
    outer, inner = dealt.where("comp <> main").withColumn("block", block("o")), dealt.where("comp = main").withColumn("hi", block("g"))
    yes, no = F.lit(True), F.lit(False)
    met = inner.withColumn("lo", each("o")).withColumns({"among": no, "left": no}).select(cols)
    met = met.unionByName(outer.withColumn("lo", F.col("block")).withColumn("hi", each("g")).withColumns({"among": no, "left": yes}).select(cols))
    others = outer.withColumn("other", each("o")).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other"), "among": yes})
    met = met.unionByName(others.withColumn("left", F.col("block") == F.col("lo")).select(cols))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return _compare_blocks(rows, nearest)

    return met.groupBy("family", "among", "lo", "hi").applyInPandas(compare, "a long, b long")


def _compare_blocks(rows: pd.DataFrame, nearest: int | None) -> pd.DataFrame:
    """Pairs of two blocks of a family (or inside one) that lie in different components and that the bitmaps do not rule out;
    of each left node the ``nearest`` alone, if given."""
    rows = rows.sort_values("n", ignore_index=True)
    node, comp, n = (rows[c].to_numpy() for c in ("node", "comp", "n"))
    own = rows["left"].to_numpy(bool)
    inside = rows["among"].iloc[0] and rows["lo"].iloc[0] == rows["hi"].iloc[0]
    left, right = (np.arange(len(rows)),) * 2 if inside else (np.flatnonzero(own), np.flatnonzero(~own))
    maps = [np.frombuffer(x, np.uint64) for x in rows["parity"]]
    found = []
    for words in np.unique([len(maps[k]) for k in right]):  # those of one length together
        those = np.array([k for k in right if len(maps[k]) == words])
        theirs = np.stack([maps[k] for k in those])
        for k in left:
            fits = those[(100 * np.minimum(n[those], n[k]) >= PERCENT * np.maximum(n[those], n[k])) & (comp[those] != comp[k])]
            if not len(fits):
                continue
            small = min(words, len(maps[k]))
            other = folded(theirs[np.searchsorted(those, fits)], small)
            differ = np.bitwise_count(other ^ folded(maps[k][None, :], small)).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero(_near(differ, n[fits] + n[k]))
            if nearest is not None and len(near) > nearest:
                near = near[np.argsort(differ[near] / (n[fits[near]] + n[k]), kind="stable")[:nearest]]
            found += [(max(node[k], node[j]), min(node[k], node[j])) for j in fits[near]]
    return pd.DataFrame(found, columns=["a", "b"]).drop_duplicates().astype("int64")
