"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Long texts are cut before encoding, only where every match of the pattern
ends: before a space or line feed that follows a character which is not white
space. White space occurs in a match only as its first character or in a run
of white space, so a match never spans such a place, and the pattern's
look-ahead sees the same characters on either side. Decoding joins raw bytes,
so ids of half characters decode exactly.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

from clusterlens.llm.common import give_back, utf8

#: Texts above so many characters are encoded in chunks of about this many.
CHUNK = 1 << 16
#: tiktoken's regex engine overflows its stack on very long white-space runs; matches in chunks with a longer run are found here.
LONG_RUN = 2000

_SAFE = re.compile(r"(?<=\S)[ \n]")
_RUN = re.compile(r"\s{%d,}" % LONG_RUN)
_coders: dict[tuple[str, str], "Coder"] = {}


class Coder:
    """Encoder and decoder of one rank file, kept by each Python worker."""

    def __init__(self, rank_file: str, pattern: str, chunk: int = CHUNK):
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # the same pattern with white space spelled out, for matches found outside tiktoken
        self.matches = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.chunk = chunk

    def parts(self, text: str) -> Iterator[str]:
        """The text in chunks that end at safe places; a stretch without any stays whole."""
        at = 0
        while len(text) - at > self.chunk:
            cut = _SAFE.search(text, at + self.chunk)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str) -> np.ndarray:
        found = []
        for part in self.parts(text):
            if _RUN.search(part):
                for m in self.matches.finditer(part):
                    found.append(np.array(self.encoding._encode_single_piece(m.group().encode("utf-8")), dtype="<u4"))
            else:
                found.append(np.array(self.encoding.encode_ordinary(part), dtype="<u4"))
        return np.concatenate(found) if found else np.empty(0, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.encoding.decode_bytes(ids[at : at + self.chunk].tolist()) for at in range(0, len(ids), self.chunk))


def coder(rank_file: str, pattern: str) -> Coder:
    key = (rank_file, pattern)
    if key not in _coders:
        _coders[key] = Coder(rank_file, pattern)
    return _coders[key]


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """Ids of a text column, packed as little-endian unsigned 32-bit integers (binary).

    No special tokens: their strings are ordinary text. Null counts as empty,
    and an empty text has no ids (empty binary). The rank file's path must
    exist on every executor.
    """

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = coder(rank_file, pattern)
        for texts in batches:
            yield pd.Series([own.encode(utf8(t).decode("utf-8", "replace")).tobytes() for t in texts], dtype=object)

    return ids(text)


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """Raw bytes of packed ids; null ids give null. Ids outside the ranks raise."""

    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = coder(rank_file, pattern)
        for packed in batches:
            yield pd.Series([None if x is None else own.decode(np.frombuffer(x, "<u4")) for x in packed], dtype=object)

    return raw(ids)


def round_trip(text: Column, rank_file: str, pattern: str) -> Column:
    """struct(ids binary, decoded binary): encoding and its decoding in one pass over the text."""

    @F.pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = coder(rank_file, pattern)
        for texts in batches:
            ids = [own.encode(utf8(t).decode("utf-8", "replace")) for t in texts]
            yield pd.DataFrame({"ids": [x.tobytes() for x in ids], "decoded": [own.decode(x) for x in ids]}, dtype=object)
        give_back()

    return both(text)
