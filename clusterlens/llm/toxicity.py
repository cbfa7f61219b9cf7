"""Toxicity: a linear classifier with a counterfactual regulariser.

Logistic regression over a text's distinct words and their beginnings
(hashed). In every labelled text that names a group, the identity terms are
swapped for others of their kind, and training penalises the squared change
of the score, so a neutral mention of a group moves no text towards toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import gathered, labelled_sample, sample_texts, small_batches, utf8, words_of
from clusterlens.llm.features import Sparse, bucket, plain, spread, summed

#: The classifier is fitted on at most so many labelled rows (smallest hashes of the id).
MAX_LABELLED = 6000
DIMS = 1 << 18
PREFIXES = (4, 5, 6)
BATCH_CHARS = 4 << 20
#: Weights of the absolute weights and of the squared score change under a swap.
L1, COUNTERFACTUAL = 1e-3, 1.0
ROUNDS = 150
#: A feature counts if so many sampled rows have it.
MIN_ROWS = 3

#: Identity terms by kind; a term is swapped for the next of its kind.
IDENTITY_TERMS = {
    "gender": ["women", "men", "girls", "boys", "transgender", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"],
    "person": ["woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"],
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "chrétien", "musulman", "juif", "cristiano", "musulmán", "judío"],
    "believers": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "christen", "muslime", "juden"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"],
    "origin": ["black", "white", "asian", "latino", "african", "european", "american", "arab", "immigrant", "immigrants", "refugees"],
    "age": ["old", "young", "elderly", "teenagers"],
    "ability": ["disabled", "deaf", "blind", "autistic"],
}


def swaps(groups: dict[str, list[str]]) -> dict[str, str]:
    return {a: b for terms in groups.values() for a, b in zip(terms, terms[1:] + terms[:1], strict=True)}


def swap_terms(text: str, change: dict[str, str]) -> str | None:
    """The text with its identity terms swapped; None when it names none.

    Ignoring case, a pattern also matches letters that no lower-casing maps to the term's (a long s, a dotless i); what
    has no term of its own stays as it is.
    """
    pattern = re.compile(r"\b(%s)\b" % "|".join(sorted(map(re.escape, change), key=len, reverse=True)), re.I)
    out = pattern.sub(lambda m: change.get(m.group().lower(), m.group()), text)
    return out if out != text else None


def of_word(word: bytes) -> tuple[int, ...]:
    w = plain(word.decode("utf-8", "replace"))
    return (bucket("w " + w, DIMS), *(bucket("p " + w[:n], DIMS) for n in PREFIXES if len(w) >= n)) if w else ()


def terms(texts: list[bytes]) -> Sparse:
    """The features that each text has, each with value 1."""
    words = words_of(texts)
    text, feature, _, _ = spread(words, of_word)
    found = summed(len(texts), text, feature, np.ones(len(text)), DIMS)
    found.values = np.ones(len(found.columns))
    return found


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def margin(self, found: Sparse) -> np.ndarray:
        return np.bincount(found.row_of, weights=self.weights[found.columns] * found.values, minlength=len(found)) + self.bias

    def score(self, found: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(found), -40, 40)))


def fit(found: Sparse, labels: np.ndarray, change: Sparse, l1: float = L1, counterfactual: float = COUNTERFACTUAL, rounds: int = ROUNDS) -> Linear:
    """Minimise log loss + l1 |w| + counterfactual * mean (w . change)^2 over all rows, by proximal steps.

    ``change`` holds each counterfactual's features minus its original's.
    Without rows, or with one label only, all texts score the labels' share.
    """
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        return Linear(np.zeros(DIMS), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    # Features of fewer than three rows would learn a single document by heart.
    df = np.bincount(found.columns, minlength=DIMS)
    keep, keep_change = df[found.columns] >= MIN_ROWS, df[change.columns] >= MIN_ROWS
    used = np.flatnonzero(df >= MIN_ROWS)
    place = np.cumsum(df >= MIN_ROWS) - 1
    own, rows, values = place[found.columns[keep]], found.row_of[keep], found.values[keep]
    swapped, swapped_rows, swapped_values = place[change.columns[keep_change]], change.row_of[keep_change], change.values[keep_change]
    share = labels.mean()
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)) / len(labels)  # both labels count alike, whatever their shares
    n, size = len(labels), len(used)
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    bias, mb, vb = 0.0, 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(rows, weights=w[own] * values, minlength=n) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * weight
        grad = np.bincount(own, weights=g[rows] * values, minlength=size) 
        if len(change):
            d = np.bincount(swapped_rows, weights=w[swapped] * swapped_values, minlength=len(change))
            grad += 2 * counterfactual / len(change) * np.bincount(swapped, weights=d[swapped_rows] * swapped_values, minlength=size)
        gb = float(g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        rate = 0.1 * min(1.0, 4 * (1 - t / (rounds + 1)))
        # per-feature step, then soft thresholding by the same step: most weights stay exactly 0
        step = rate / (np.sqrt(v / (1 - 0.99**t)) + 1e-3)
        w -= step * m / (1 - 0.9**t)
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0.0)
        bias -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(DIMS)
    weights[used] = w
    return Linear(weights, bias)


def difference(found: Sparse, swapped: Sparse, of: np.ndarray) -> Sparse:
    """Row r: swapped row r minus found row of[r]."""
    parts_c, parts_v, lengths = [], [], []
    for r, k in enumerate(of):
        a, b, c, d = found.starts[k], found.starts[k + 1], swapped.starts[r], swapped.starts[r + 1]
        cols, where = np.unique(np.concatenate((found.columns[a:b], swapped.columns[c:d])), return_inverse=True)
        vals = np.bincount(where, weights=np.concatenate((-found.values[a:b], swapped.values[c:d])), minlength=len(cols))
        parts_c.append(cols[vals != 0])
        parts_v.append(vals[vals != 0])
        lengths.append(int((vals != 0).sum()))
    if not lengths:
        return Sparse(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0))
    return Sparse(np.concatenate(([0], np.cumsum(lengths))), np.concatenate(parts_c), np.concatenate(parts_v))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_labelled: int = MAX_LABELLED, groups: dict[str, list[str]] | None = None) -> Linear:
    """Fit on labelled rows outside the held-out fold. Repeated ids count once, with their higher label.

    Features are found on the executors; the driver gets the bounded sample's
    feature numbers only.
    """
    small_batches(docs.sparkSession)
    change = swaps(IDENTITY_TERMS if groups is None else groups)

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in gathered(batches, "text", BATCH_CHARS):
            texts = [utf8(t) for t in batch["text"]]
            other = [(k, s) for k, t in enumerate(texts) if change and (s := swap_terms(t.decode("utf-8", "replace"), change)) is not None]
            for kind, at, own in ((0, range(len(texts)), terms(texts)), (1, [k for k, _ in other], terms([s.encode() for _, s in other]))):
                spans = list(zip(own.starts[:-1], own.starts[1:], strict=True))
                if spans:
                    yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[list(at)], "kind": kind, "y": batch["y"].to_numpy()[list(at)], "columns": [own.columns[a:b].astype("int32") for a, b in spans], "counts": [own.values[a:b] for a, b in spans]})

    rows = sample_texts(docs, labelled_sample(labels, label, max_labelled, worse="max")).mapInPandas(found, "doc_id long, kind int, y int, columns array<int>, counts array<float>").toPandas()
    rows = rows.sort_values(["kind", "doc_id"], kind="stable").reset_index(drop=True)

    def sparse(part: pd.DataFrame) -> Sparse:
        if not len(part):
            return Sparse(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0))
        return Sparse(np.concatenate(([0], np.cumsum(part["columns"].map(len)))), np.concatenate([np.asarray(x, np.int64) for x in part["columns"]]), np.concatenate([np.asarray(x, float) for x in part["counts"]]))

    plain_rows, swapped = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
    place = {d: k for k, d in enumerate(plain_rows["doc_id"])}
    own = sparse(plain_rows)
    return fit(own, plain_rows["y"].to_numpy(float), difference(own, sparse(swapped), np.array([place[d] for d in swapped["doc_id"]], np.int64)))


def score(text: Column, model: Linear) -> Column:
    """Score in 0..1 of a text column, from the text alone. Null and empty texts score as a text without words: the bias alone."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(Linear(model.weights.astype(np.float32), model.bias))

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.round(shared.value.score(terms([utf8(t) for t in texts])), 9))

    return toxic(text)
