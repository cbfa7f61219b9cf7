"""URL filter over a sorted digest array.

The rule strings (host + path prefix) are hashed to 64-bit xxhash keys. A
file holds the sorted keys, the offsets and the rule strings themselves; the
driver hands it to every executor with ``SparkContext.addFile`` and tasks
memory-map it, so all workers of a machine share one copy of its pages. A
batch of urls is expanded to its candidate strings (host suffixes x path
prefixes of the lengths that rules have), hashed, probed by one vectorised
binary search, and each hit is confirmed against the stored full string, so
colliding keys never decide.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MAGIC = b"URLDIG01"
#: Rules are configuration: a list whose file would pass this is refused, not cut.
MAX_BYTES = 2 << 30

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_maps: dict[str, "DigestArray"] = {}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path). Host: after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased.
    Path: from there up to '?', '#' or the end. Null, or no '://': both empty."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    for stop in "?#":
        cut = rest.find(stop)
        if cut >= 0:
            rest = rest[:cut]
    cut = rest.find("/")
    host, path = (rest, "") if cut < 0 else (rest[:cut], rest[cut:])
    return host.translate(_LOWER), path


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def write_digests(path: str, rules: Iterable[tuple[str, str, str]], hash_of: Callable[[str], int] = digest) -> None:
    """Write (host, path prefix, 'allow' | 'block') rules. Of a rule listed both ways, block holds.

    Layout: magic, counts, sorted uint64 keys, uint64 offsets, uint8 blocks, uint32 path lengths, rule strings.
    """
    verdicts: dict[str, bool] = {}
    lengths, labels = set(), 0
    for host, prefix, verdict in rules:
        if verdict not in ("allow", "block") or (prefix and not prefix.startswith("/")) or "/" in host or not host:
            raise ValueError(f"bad rule: {host!r}, {prefix!r}, {verdict!r}")
        host = host.translate(_LOWER)
        key = host + prefix
        verdicts[key] = verdicts.get(key, False) or verdict == "block"
        lengths.add(len(prefix))
        labels = max(labels, host.count(".") + 1)
    order = sorted(verdicts, key=lambda k: (hash_of(k), k))
    blob = [k.encode("utf-8", "surrogatepass") for k in order]
    size = sum(map(len, blob)) + 17 * len(blob)
    if size > MAX_BYTES:
        raise ValueError(f"the rules take {size} bytes; at most {MAX_BYTES} are handed to every executor")
    with open(path, "wb") as out:
        out.write(MAGIC + struct.pack("<4Q", len(order), sum(map(len, blob)), len(lengths), labels))
        out.write(np.array([hash_of(k) for k in order], dtype="<u8").tobytes())
        out.write(np.cumsum([0, *map(len, blob)], dtype="<u8").tobytes())
        out.write(np.array(sorted(lengths), dtype="<u8").tobytes())
        out.write(np.array([verdicts[k] for k in order], dtype="u1").tobytes())
        out.write(b"".join(blob))


class DigestArray:
    """The memory-mapped file."""

    def __init__(self, path: str, hash_of: Callable[[str], int] = digest):
        with open(path, "rb") as f:
            if f.read(8) != MAGIC:
                raise ValueError(f"not a digest file: {path}")
            n, size, n_lengths, self.labels = struct.unpack("<4Q", f.read(32))
        at = 40

        def part(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.memmap(path, dtype=dtype, mode="r", offset=at, shape=(count,)) if count else np.empty(0, dtype)
            at += out.nbytes
            return out

        self.keys, self.offsets, self.lengths = part("<u8", n), part("<u8", n + 1), part("<u8", n_lengths)
        self.blocks, self.blob = part("u1", n), part("u1", size)
        self.hash_of = hash_of

    def text(self, k: int) -> str:
        return bytes(self.blob[int(self.offsets[k]) : int(self.offsets[k + 1])]).decode("utf-8", "surrogatepass")

    def find(self, candidates: list[str]) -> np.ndarray:
        """For each string the index of the rule equal to it, or -1."""
        found = np.full(len(candidates), -1, dtype=np.int64)
        if not len(self.keys) or not candidates:
            return found
        wanted = np.fromiter(map(self.hash_of, candidates), dtype=np.uint64, count=len(candidates))
        at = np.searchsorted(self.keys, wanted)
        hits = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted))
        for i in hits:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == wanted[i]:  # colliding keys lie side by side
                if self.text(k) == candidates[i]:
                    found[i] = k
                    break
                k += 1
        return found

    def judge(self, urls: Iterable[str | None], default: str = "allow") -> pd.DataFrame:
        parts = [split_url(u) for u in urls]
        candidates: dict[str, int] = {}
        sizes = [int(x) for x in self.lengths]
        own: list[list[tuple[int, int, int]]] = []
        for host, path in parts:
            mine = []
            names = host.split(".")
            for depth in range(1, min(len(names), int(self.labels)) + 1) if host else ():
                suffix = ".".join(names[-depth:])
                if not suffix:
                    continue
                for size in sizes:
                    if size <= len(path):
                        key = suffix + path[:size]
                        mine.append((len(key), len(suffix), candidates.setdefault(key, len(candidates))))
            own.append(mine)
        found = self.find(list(candidates))
        rules, verdicts = [], []
        for mine in own:
            best = max((c for c in mine if found[c[2]] >= 0), default=None)
            k = -1 if best is None else int(found[best[2]])
            rules.append(None if k < 0 else self.text(k))
            verdicts.append(default if k < 0 else "block" if self.blocks[k] else "allow")
        return pd.DataFrame({"host": [p[0] for p in parts], "path": [p[1] for p in parts], "rule": rules, "verdict": verdicts})


def publish(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Write the digest file and hand it to the executors; returns its name there."""
    rules = list(rules)
    name = f"url-digests-{hashlib.sha256(repr(sorted(rules)).encode()).hexdigest()[:24]}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="url-digests-"), name)
    write_digests(path, rules)
    if not any(str(f).endswith(name) for f in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)
    return name


def judge_urls(spark: SparkSession, url: Column, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> Column:
    """struct(host, path, rule, verdict) of a url column.

    A rule fits its host and every subdomain of it, when the path starts with
    the rule's; the longest fitting rule holds (of two equally long ones, the
    one with the longer host). A url without ``://`` and a null url have an
    empty host and path and fit no rule; urls without a rule get ``default``,
    since they are not in the list. Repeated urls get equal answers.
    """
    name = publish(spark, rules)

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        path = SparkFiles.get(name)
        if path not in _maps:
            _maps[path] = DigestArray(path)
        for urls in batches:
            yield _maps[path].judge(urls, default)

    return judge(url)
