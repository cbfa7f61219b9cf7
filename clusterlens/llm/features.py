"""Hashed word features of whole texts, shared by the classifiers and rules.

Words are split at ASCII white space; each distinct word is analysed once a
batch. A word's features do not depend on the batch, so scores repeat exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash

from clusterlens.llm.common import Words, ragged, words_of

_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
_RUNS = re.compile(r"(?P<X>[^\W\d_]+)|(?P<d>\d+)|(?P<p>[.,;:!?'\"()\-]+)|(?P<s>.)", re.S)


def shape(word: str) -> str:
    """Letters as a (lower case), A (upper case) or Aa (capitalised), digits as d, punctuation and symbols as they are, runs once."""
    out = []
    for m in _RUNS.finditer(word):
        kind, run = m.lastgroup, m.group()
        if kind == "X":
            out.append("a" if run.islower() else "A" if run.isupper() and len(run) > 1 else "Aa" if run[0].isupper() else "aA")
        elif kind == "d":
            out.append("d")
        elif not out or out[-1] != run[0]:
            out.append(run[0])
    return "".join(out[:8])


def plain(word: str) -> str:
    """Lower case, without punctuation at the edges."""
    return _EDGE.sub("", word.lower())


def bucket(name: str, dims: int) -> int:
    return xxhash.xxh32_intdigest(name.encode("utf-8", "replace")) % dims


@dataclass
class Sparse:
    """Rows of (column, value): row r holds places starts[r] to starts[r + 1]."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def dense(self, lo: int, hi: int, dims: int) -> np.ndarray:
        out = np.zeros((hi - lo, dims), np.float32)
        a, b = self.starts[lo], self.starts[hi]
        np.add.at(out, (self.row_of[a:b] - lo, self.columns[a:b]), self.values[a:b])
        return out


def counted(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of a text and one of its distinct words: text, code, count; by text."""
    if not len(words.codes):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    pairs, counts = np.unique(words.text_of * len(words.distinct) + words.codes, return_counts=True)
    return pairs // len(words.distinct), pairs % len(words.distinct), counts


def spread(words: Words, of_word) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count, number of the text's distinct words) for the features of every distinct word of every text."""
    text, code, count = counted(words)
    own = [of_word(w) for w in words.distinct]
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    flat = np.fromiter((f for fs in own for f in fs), np.int64, int(lengths.sum()))
    first = np.cumsum(lengths) - lengths
    at = ragged(first[code], lengths[code]) if len(code) else np.empty(0, np.int64)
    repeat = lengths[code] if len(code) else np.empty(0, np.int64)
    return np.repeat(text, repeat), flat[at], np.repeat(count, repeat), np.bincount(text, minlength=len(words))


def summed(n: int, text: np.ndarray, feature: np.ndarray, value: np.ndarray, dims: int) -> Sparse:
    """Equal (text, feature) pairs added up."""
    pairs, where = np.unique(text * dims + feature, return_inverse=True)
    values = np.bincount(where, weights=value, minlength=len(pairs)) if len(pairs) else np.empty(0)
    return Sparse(np.searchsorted(pairs, np.arange(n + 1) * dims), pairs % dims, values.astype(np.float32))


def split_words(texts: list[bytes]) -> Words:
    return words_of(texts)
