"""Quality rules: an isolation forest on rule statistics.

Each document's statistics (words, symbols, repeated lines and 8-word
windows, case, punctuation) are exact counts over its whole text. Random
splits isolate unusual documents in few steps; the mean path length over all
trees gives an anomaly score, and the cut between kept and dropped is set on
all labelled rows, so that at most ``GOOD_LOSS`` of the good ones fall. As the
method has it, each tree is grown over a draw of ``SUBSAMPLE`` of all good rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import gathered, give_back, labelled_ids, labelled_texts, ragged, small_batches, stored, utf8, words_of
from clusterlens.operators.guards import top_per_group

TREES, SUBSAMPLE, DEPTH = 128, 256, 12
#: Share of the good labelled rows that the cut may lose.
GOOD_LOSS = 0.002
#: Scores are counted in so many steps to set the cut.
SCORE_STEPS = 1 << 18
WINDOW = 8
BATCH_CHARS = 4 << 20

#: The symbols that the rule counts.
SYMBOLS = b"[#*$%&|<>]"[1:-1]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_table = lambda chars: np.isin(np.arange(256), np.frombuffer(chars, np.uint8))
_SYMBOL, _SPACE = _table(SYMBOLS), _table(b" \t\n\x0b\x0c\r")
_UPPER, _LETTER = _table(bytes(range(65, 91))), _table(bytes(range(65, 91)) + bytes(range(97, 123)))
_MARK = _table(b"!?.,;:'\"()-")
_WORDLIKE = re.compile(rb"[0-9A-Za-z\x80-\xff]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(codes: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each text the number of its words inside a window of ``window`` words that the text holds twice or more.

    Windows are compared by a 64-bit hash first; those with equal hashes then word by word.
    """
    n = len(starts) - 1
    lengths = np.diff(starts)
    if not len(codes) or lengths.max() <= window:
        return np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
        mixed ^= mixed >> np.uint64(29)
        total = np.zeros(len(codes) - window + 1, np.uint64)
        for k in range(window):
            total = total * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + len(total)]
        count = np.maximum(lengths - window + 1, 0)
        at = ragged(starts[:-1], count)
        text = np.repeat(np.arange(n), count)
        key = total[at] ^ ((text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(at), bool)
    left, right = order[:-1][same], order[1:][same]
    spans = np.arange(window)
    true = (text[left] == text[right]) & (codes[at[left][:, None] + spans] == codes[at[right][:, None] + spans]).all(axis=1)
    again[left[true]] = True
    again[right[true]] = True
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + window, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return inside[starts[1:]] - inside[starts[:-1]]


def statistics(texts: list[bytes]) -> pd.DataFrame:
    """The rule counts and the forest's further shares; one row per text."""
    words = words_of(texts)
    n_words = np.diff(words.starts)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[ends[1:]] - sums[ends[:-1]]

    dup_lines, lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        if b"\n" in t:
            own = [x for x in t.split(b"\n") if x.strip()]
            lines[k], dup_lines[k] = len(own), len(own) - len(set(own))
        else:
            lines[k] = n_words[k] > 0
    out = pd.DataFrame(
        {
            "n_words": n_words,
            "word_chars": per_text(((raw & 0xC0) != 0x80) & ~_SPACE[raw]),
            "n_symbols": per_text(_SYMBOL[raw]),
            "n_dup_lines": dup_lines,
            "n_repeat_words": repeated_words(words.codes, words.starts),
        }
    )
    w, chars = np.maximum(n_words, 1), np.maximum(out["word_chars"], 1)
    text = words.text_of
    pairs = np.unique(text * max(1, len(words.distinct)) + words.codes) if len(text) else np.empty(0, np.int64)
    distinct = np.bincount(pairs // max(1, len(words.distinct)), minlength=len(texts)) if len(pairs) else np.zeros(len(texts))
    same_next = np.zeros(len(texts))
    if len(text) > 1:
        twice = (words.codes[1:] == words.codes[:-1]) & (text[1:] == text[:-1])
        same_next = np.bincount(text[1:][twice], minlength=len(texts))
    bare = np.array([not _WORDLIKE.search(x) for x in words.distinct], float)  # words without a letter or digit
    # Square roots spread the small shares.
    shares = {
        "word_length": np.minimum(out["word_chars"] / w, 40) / 40,
        "symbols": out["n_symbols"] / chars,
        "dup_lines": out["n_dup_lines"] / np.maximum(lines, 1),
        "repeats": out["n_repeat_words"] / w,
        "upper": per_text(_UPPER[raw]) / np.maximum(per_text(_LETTER[raw]), 1),
        "marks": per_text(_MARK[raw]) / chars,
        "distinct": distinct / w**0.85,
        "same_next": same_next / w,
        "bare": np.bincount(text, weights=bare[words.codes], minlength=len(texts)) / w if len(text) else np.zeros(len(texts)),
    }
    return out.assign(**{f: np.sqrt(shares[f]) for f in FEATURES})


#: What the forest splits on.
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "upper", "marks", "distinct", "same_next", "bare"]


def base_failed(found: pd.DataFrame) -> np.ndarray:
    return ((found["n_words"] < 20) | (100 * found["n_repeat_words"] > 30 * found["n_words"])).to_numpy()


def _steps(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as arrays (tree, node): feature (-1: leaf), cut, left child (right is the next), path length at leaves; the cut score."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    length: np.ndarray
    scale: float
    limit: float = np.inf

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score, 0 to 1: short mean paths give high scores."""
        total = np.zeros(len(rows))
        at_row = np.arange(len(rows))
        for feature, cut, left, length in zip(self.feature, self.cut, self.left, self.length, strict=True):
            node = np.zeros(len(rows), np.int64)
            while (feature[node] >= 0).any():
                f = feature[node]
                inner = f >= 0
                node = np.where(inner, left[node] + (rows[at_row, np.maximum(f, 0)] >= cut[node]), node)
            total += length[node]
        return 2.0 ** (-total / max(1, len(self.feature)) / max(self.scale, 1e-9)) if len(self.feature) else np.zeros(len(rows))

    def keeps(self, found: pd.DataFrame) -> np.ndarray:
        """False for rows that fail the base rules or whose score lies above the limit."""
        failed = base_failed(found)
        out = np.zeros(len(found), bool)
        if (~failed).any():
            out[~failed] = self.score(found.loc[~failed, FEATURES].to_numpy(float)) <= self.limit
        return out


def grow(draws: Iterable[np.ndarray], size: int, low: np.ndarray, high: np.ndarray, depth: int = DEPTH, seed: int = 11) -> Forest:
    """One tree over each draw of ``size`` usual rows. Cuts are drawn from the range ``low`` .. ``high`` that each feature has in
    all labelled rows, so a feature that never varies among usual rows still isolates rows that depart in it."""
    rng = np.random.default_rng(seed)
    grown = []
    for drawn in draws if size > 1 and (high > low).any() else ():
        nodes: list[list[float]] = [[-1, 0.0, 0, 0.0]]
        todo = [(0, drawn, 0, low, high)]
        while todo:
            k, own, level, lo, hi = todo.pop()
            if level >= depth or len(own) <= 1:
                nodes[k][3] = level + _steps(len(own))
                continue
            f = int(rng.choice(np.flatnonzero(hi > lo)))
            cut = float(rng.uniform(lo[f], hi[f]))
            nodes[k][:3] = [f, cut, len(nodes)]
            right = own[:, f] >= cut
            below, above = hi.copy(), lo.copy()
            below[f] = above[f] = cut
            todo += [(len(nodes), own[~right], level + 1, lo, below), (len(nodes) + 1, own[right], level + 1, above, hi)]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
        grown.append(nodes)
    width = max(map(len, grown), default=1)
    flat = np.zeros((len(grown), width, 4))
    flat[:, :, 0] = -1
    for k, nodes in enumerate(grown):
        flat[k, : len(nodes)] = nodes
    return Forest(flat[:, :, 0].astype(np.int64), flat[:, :, 1], flat[:, :, 2].astype(np.int64), flat[:, :, 3], _steps(size))


def cut_of(scores: np.ndarray, good: np.ndarray, bad: np.ndarray, loss: float = GOOD_LOSS) -> float:
    """The cut for distinct ascending ``scores``, of which so many good and bad rows have each.

    It is the score with the best difference of dropped bad and dropped good shares, among those that lose at most
    ``loss`` of the good rows; the middle of several equal ones if no good row lies between. Without any good row nothing is dropped.
    """
    n_good, n_bad = int(good.sum()), int(bad.sum())
    if not n_good:
        return np.inf
    kept = np.cumsum(good)
    first = int(np.searchsorted(kept, max(1, int(np.ceil(n_good * (1 - loss))))))
    gain = (n_bad - np.cumsum(bad)) / max(1, n_bad) - (n_good - kept) / n_good
    best = first + np.flatnonzero(gain[first:] >= gain[first:].max() - 1e-12)
    best = best[good[best] + bad[best] > 0]
    alone = good[best[0] + 1 : best[-1] + 1].sum() == 0
    return float(scores[best].mean()) if len(best) > 1 and alone else float(scores[best[0]])


def fit(found: pd.DataFrame, labels: np.ndarray, loss: float = GOOD_LOSS, seed: int = 11) -> Forest:
    """The forest over good rows that pass the base rules, and the cut calibrated on all labelled rows, of rows in memory."""
    passed = ~base_failed(found)
    rows, y = found.loc[passed, FEATURES].to_numpy(float), labels[passed]
    usual, rng = rows[y == 1], np.random.default_rng(seed)
    size = min(SUBSAMPLE, len(usual))
    low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
    forest = grow((usual[rng.choice(len(usual), size, replace=False)] for _ in range(TREES)), size, low, high)
    scores, at = np.unique(forest.score(rows), return_inverse=True)
    forest.limit = cut_of(scores, np.bincount(at, y == 1, len(scores)), np.bincount(at, y != 1, len(scores)), loss)
    return forest


def draws(good: DataFrame, n_good: int) -> list[np.ndarray]:
    """For each tree ``SUBSAMPLE`` of all ``good`` rows (all, if fewer), taken by the smallest hashes of id and tree, so reruns agree.

    A row is dealt to as many trees as it takes to give each some two subsamples to choose from: to all of them
    where rows are few, to one where they are many. The driver gets the chosen rows alone.
    """
    times = min(TREES, -(-2 * TREES * SUBSAMPLE // max(1, n_good)))
    tree = F.explode(F.transform(F.sequence(F.lit(0), F.lit(times - 1)), lambda k: F.pmod(F.xxhash64("doc_id") + k, F.lit(TREES))))
    dealt = good.select("doc_id", *FEATURES, tree.alias("tree")).withColumn("h", F.xxhash64("doc_id", "tree"))
    rows = top_per_group(dealt, ["tree"], [F.asc("h"), F.asc("doc_id")], SUBSAMPLE).toPandas().sort_values(["tree", "rank"])
    return [own[FEATURES].to_numpy(float) for _, own in rows.groupby("tree")]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Forest:
    """Fit on all labelled rows outside the held-out fold.

    Their statistics are stored in the shared folder; the driver gets the features' ranges, the rows drawn for the trees and the number
    of good and bad rows at each step of the score, none of which grows with the table.
    """
    spark = docs.sparkSession
    small_batches(spark)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in gathered(batches, "text", BATCH_CHARS):
            out = statistics([utf8(t) for t in batch["text"]])[["n_words", "n_repeat_words", *FEATURES]]
            yield out.assign(doc_id=batch["doc_id"].to_numpy(), y=batch["y"].to_numpy())

    schema = "n_words long, n_repeat_words long, " + ", ".join(f"{f} double" for f in FEATURES) + ", doc_id long, y int"
    measured = stored(labelled_texts(docs, labelled_ids(labels, label)).mapInPandas(measure, schema), "rule-statistics")
    rows = measured.where((F.col("n_words") >= 20) & (100 * F.col("n_repeat_words") <= 30 * F.col("n_words")))
    good = rows.where("y = 1")
    reach = rows.agg(F.count_if(F.col("y") == 1).alias("n_good"), *[g(f).alias(f"{g.__name__}_{f}") for g in (F.min, F.max) for f in FEATURES]).first()
    if not reach["n_good"]:
        return grow((), 0, np.zeros(0), np.zeros(0))
    low, high = (np.array([reach[f"{g}_{f}"] for f in FEATURES]) for g in ("min", "max"))
    forest = grow(draws(good, reach["n_good"]), min(SUBSAMPLE, reach["n_good"]), low, high)
    shared = spark.sparkContext.broadcast(forest)

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = shared.value.score(batch[FEATURES].to_numpy(float))
            yield pd.DataFrame({"step": np.ceil(scores * SCORE_STEPS).astype(np.int64), "good": batch["y"].to_numpy() == 1})
        give_back()

    counts = rows.select("y", *FEATURES).mapInPandas(steps, "step long, good boolean").groupBy("step").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).toPandas().sort_values("step")
    # rounded up: a row's score is at most its step
    forest.limit = cut_of(counts["step"].to_numpy() / SCORE_STEPS, counts["good"].to_numpy(), counts["bad"].to_numpy())
    return forest


def judge(text: Column, forest: Forest) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, anomaly, kept) of a text column.

    Null counts as empty: no words, base_failed. Equal texts get equal answers.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(forest)

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, anomaly double, kept boolean")
    def rules(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = statistics([utf8(t) for t in texts])
            out = found[COUNTS].copy()
            out["base_failed"] = base_failed(found)
            out["anomaly"] = shared.value.score(found[FEATURES].to_numpy(float))
            out["kept"] = ~out["base_failed"] & (out["anomaly"] <= shared.value.limit)
            yield out

    return rules(text)
