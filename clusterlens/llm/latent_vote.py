"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes three blocks of terms, each scaled to length one: its words
(hashed, tf-idf), the shapes of its words (letters' case, digits, symbols),
and coarse measures of the whole text (distinct words, word lengths, equal
lines, length). A truncated SVD of the labelled sample gives the latent
space. The labelled vectors and the projection are broadcast; both are
bounded by ``MAX_LABELLED`` and ``DIMS`` and do not grow with the corpus.
Every document's cosine products with all labelled vectors are computed in
blocks, exactly, and its nearest neighbours' labels are averaged with weights
that rise with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterlens.llm.common import gathered, give_back, labelled_sample, sample_texts, small_batches, utf8, words_of
from clusterlens.llm.features import Sparse, bucket, counted, plain, shape, spread, summed

#: The classifier is fitted on at most so many labelled rows (smallest hashes of the id).
MAX_LABELLED = 4000
WORD_DIMS, SHAPE_DIMS, TEXT_DIMS = 3072, 960, 64
DIMS = WORD_DIMS + SHAPE_DIMS + TEXT_DIMS
RANK = 64
NEIGHBOURS = 31
#: A neighbour's weight is its cosine to this power.
SHARPNESS = 8
BATCH_CHARS = 4 << 20
BLOCK = 512
#: Rows of the sample that are weighted at a time.
FIT_BLOCK = 64


def terms(texts: list[bytes]) -> Sparse:
    """Counts of hashed terms of each text; no terms for a text without words."""
    words = words_of(texts)

    def of_word(word: bytes) -> tuple[int, ...]:
        w = word.decode("utf-8", "replace")
        return bucket(plain(w), WORD_DIMS), WORD_DIMS + bucket(shape(w), SHAPE_DIMS)

    text, feature, count, distinct = spread(words, of_word)
    n = np.diff(words.starts)
    code_len = np.fromiter(map(len, words.distinct), np.int64, len(words.distinct))
    own_text, own_code, own_count = counted(words)
    chars = np.bincount(own_text, weights=code_len[own_code] * own_count, minlength=len(texts)) if len(own_text) else np.zeros(len(texts))
    top = np.zeros(len(texts))
    np.maximum.at(top, own_text, own_count)
    coarse_text, coarse = [], []
    for k in np.flatnonzero(n):
        lines = [x for x in texts[k].split(b"\n") if x.strip()]
        for at, value in enumerate(
            (
                int(8 * min(1.0, distinct[k] / n[k] ** 0.85)),
                min(7, int(chars[k] / n[k] / 2)),
                int(7.99 * (1 - len(set(lines)) / len(lines))),
                int(7.99 * min(1.0, 4 * top[k] / n[k])),
                min(7, int(np.log2(n[k] + 1) / 2)),
            )
        ):
            coarse_text.append(k)
            coarse.append(WORD_DIMS + SHAPE_DIMS + 9 * at + value)
    return summed(
        len(texts),
        np.concatenate((text, np.array(coarse_text, np.int64))),
        np.concatenate((feature, np.array(coarse, np.int64))),
        np.concatenate((count.astype(float), np.ones(len(coarse)))),
        DIMS,
    )


@dataclass
class Voter:
    """The fitted classifier: idf of the terms, projection, unit vectors and labels of the sample, share of label 1."""

    idf: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def weighted(self, rows: np.ndarray) -> np.ndarray:
        return _blocks(np.log1p(rows) * self.idf)

    def latent(self, rows: np.ndarray) -> np.ndarray:
        return _unit(self.weighted(rows) @ self.project)

    def score(self, found: Sparse) -> np.ndarray:
        """Share of label 1 among the neighbours of each row; 0 for rows without terms."""
        out = np.zeros(len(found))
        if not len(self.labels):
            return np.where(np.diff(found.starts) > 0, self.prior, 0.0)
        k = min(NEIGHBOURS, len(self.labels))
        for lo in range(0, len(found), BLOCK):
            hi = min(lo + BLOCK, len(found))
            near = self.latent(found.dense(lo, hi, DIMS)) @ self.vectors.T
            best = np.argpartition(near, len(self.labels) - k, axis=1)[:, -k:]
            weight = np.clip(np.take_along_axis(near, best, axis=1), 0, 1).astype(float) ** SHARPNESS
            # ten thousandths of a vote for the prior settle rows without any near neighbour
            votes = (weight * self.labels[best]).sum(axis=1) + 1e-4 * self.prior
            out[lo:hi] = votes / (weight.sum(axis=1) + 1e-4)
        out[np.diff(found.starts) == 0] = 0.0
        return np.clip(out, 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _blocks(rows: np.ndarray) -> np.ndarray:
    """Each of the three blocks scaled to length one."""
    a, b = WORD_DIMS, WORD_DIMS + SHAPE_DIMS
    return np.concatenate((0.6 * _unit(rows[:, :a]), _unit(rows[:, a:b]), _unit(rows[:, b:])), axis=1, dtype=np.float32)


def fit(found: Sparse, labels: np.ndarray, rank: int = RANK) -> Voter:
    """Latent space and labelled vectors. Without labelled rows every text scores one half; a single label is the answer for all."""
    keep = np.diff(found.starts) > 0
    prior = float(labels.mean()) if len(labels) else 0.5
    labels = labels[keep].astype(float)
    idf = np.log((1 + len(labels)) / (1 + np.bincount(found.columns[found.values > 0], minlength=DIMS))).astype(np.float32) + 1
    voter = Voter(idf, np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), prior)
    if not len(labels):
        return voter
    # The one dense matrix of the driver, filled a few rows at a time: its counts and its parts never stand beside it whole.
    weighted, at = np.empty((len(labels), DIMS), np.float32), 0
    for lo in range(0, len(found), FIT_BLOCK):
        hi = min(lo + FIT_BLOCK, len(found))
        rows = found.dense(lo, hi, DIMS)[keep[lo:hi]]
        weighted[at : at + len(rows)] = voter.weighted(rows)
        at += len(rows)
    basis = np.random.default_rng(7).standard_normal((DIMS, min(rank + 16, len(labels)))).astype(np.float32)
    for _ in range(4):  # subspace iteration for the leading right singular vectors
        basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
    _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
    voter.project = np.ascontiguousarray((basis @ right.T)[:, :rank].astype(np.float32))
    voter.vectors = np.ascontiguousarray(_unit(weighted @ voter.project))
    voter.labels = labels
    return voter


def collect_terms(texts: DataFrame) -> tuple[Sparse, np.ndarray]:
    """Terms and labels of a bounded sample (doc_id, text, y): found on the executors, the term counts gathered."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in gathered(batches, "text", BATCH_CHARS):
            own = terms([utf8(t) for t in batch["text"]])
            spans = list(zip(own.starts[:-1], own.starts[1:], strict=True))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "columns": [own.columns[a:b].astype("int32") for a, b in spans], "counts": [own.values[a:b] for a, b in spans]})

    rows = texts.mapInPandas(found, "doc_id long, y int, columns array<int>, counts array<float>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    lengths = rows["columns"].map(len).to_numpy(np.int64) if len(rows) else np.empty(0, np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    joined = lambda c, t: np.concatenate([np.asarray(x, t) for x in rows[c]]) if len(rows) else np.empty(0, t)
    return Sparse(starts, joined("columns", np.int64), joined("counts", np.float32)), rows["y"].to_numpy(float)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> Voter:
    """Fit on labelled rows outside the held-out fold. Repeated ids count with their lower label."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(labels, label, max_labelled)
    voter = fit(*collect_terms(sample_texts(docs, sample)))
    give_back()
    return voter


def score(text: Column, voter: Voter) -> Column:
    """Score in 0..1 of a text column, from the text alone. Null, empty and white-space texts score 0; equal texts score alike."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(voter)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.round(shared.value.score(terms([utf8(t) for t in texts])), 9))
        give_back()

    return vote(text)
