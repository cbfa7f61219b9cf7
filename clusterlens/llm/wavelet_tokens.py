"""Token-id output: one wavelet-matrix file per shard.

Documents are dealt by ranges of doc_id and sorted, so the files in order
hold all documents in ascending doc_id order. A task encodes its documents
and starts a new file whenever the current one holds enough ids, so memory is
bounded by one file. Files go to the run's folder under a temporary name and
are renamed when whole: a repeated task replaces its own files.

File format (little endian): magic, length of a JSON header, header, then
zstd frames: doc ids, null marks, document starts, and each bit-plane of the
wavelet matrix in frames of FRAME_BITS bits with the number of ones before
each frame. ``WaveletFile`` reads ids by position, counts a token in a range
and finds its occurrences from the planes, decompressing only frames it needs.
"""

from __future__ import annotations

import array
import itertools
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterlens.llm.common import chunks, gathered, ragged, run_folder, small_batches, utf8, words_of

MAGIC = b"WAVMAT01"
FRAME_BITS = 1 << 18
#: A file is closed once it holds so many ids (a single longer document still goes into one file).
SHARD_IDS = 1 << 21
#: Words, and pieces of words, whose ids a worker remembers.
CACHE_WORDS = 800_000
#: Texts are encoded together up to about so many characters.
BATCH_CHARS = 6 << 20

_tokenizers: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Encodes many texts with a ``tokenizers`` file, each distinct word once.

    Exact for a tokenizer that drops white space and whose normaliser and
    pre-tokenizer never look across ASCII white space, as
    ``word_bpe_49k.json``: NFC cannot compose across it, lower-casing goes by
    character, and the split pattern holds no white space. Words of ASCII and
    plain Latin letters, which NFC leaves alone, are split here and only their
    pieces go to the library's model; all other words, and those with a
    special token's string, go through the whole library.
    """

    #: The contractions that the vocabulary's split pattern names, then letters, one digit, and the rest.
    #: A line feed, which no word holds, stands between words that are split together.
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ɏß]+|[0-9]|[^a-zà-öø-ɏß0-9\n]+|\n")
    PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
    #: The characters between U+00C0 and U+017F that it leaves out: signs, and a letter that two lower-case ones replace.
    NOT_PLAIN = [c.encode() for c in "\u00d7\u00f7\u0130"]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spelled = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spelled(chr(c))[0][0] for c in range(0x80, 0x180)}
        self.words: dict[bytes, tuple[int, ...]] = {}
        # Numbers of the pieces; the ids of piece k are flat[first[k] : first[k + 1]].
        self.pieces: dict[str, int] = {}
        self.flat, self.first = np.empty(0, np.uint32), np.zeros(1, np.int64)
        # Bytes of no plain word. A line feed stands behind each.
        self.odd = np.array([not (b == 0x0A or 0x21 <= b <= 0x7E or 0x80 <= b < 0xC0 or 0xC3 <= b <= 0xC5) for b in range(256)])

    def plain(self, distinct: list[bytes]) -> np.ndarray:
        """Which words are split here: those that ``PLAIN`` fits. They hold ASCII, and whole pairs of bytes from C3 80 on."""
        joined, size = b"\n".join(distinct) + b"\n", np.fromiter(map(len, distinct), np.int64, len(distinct)) + 1
        raw = np.frombuffer(joined, np.uint8)
        first, second = raw[:-1], raw[1:]
        odd = self.odd[raw]
        leads, follows = (first >= 0xC3) & (first <= 0xC5), (second >= 0x80) & (second < 0xC0)
        odd[:-1] |= leads & ~follows
        odd[1:] |= follows & ~leads
        for pair in self.NOT_PLAIN:
            odd[:-1] |= (first == pair[0]) & (second == pair[1])
        worst = np.logical_or.reduceat(odd, np.cumsum(size) - size)
        if any(s.encode() in joined for s in self.special):
            worst[[any(s.encode() in w for s in self.special) for w in distinct]] = True
        return ~worst

    def pieces_of(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where ``flat`` holds the ids of distinct pieces, and how many each has; a new one goes to the library's model once. A line feed has none."""
        if len(self.pieces) + len(names) > CACHE_WORDS:
            self.pieces.clear()
            self.flat, self.first = np.empty(0, np.uint32), np.zeros(1, np.int64)
        known, tokenize = self.pieces, self.tokenizer.model.tokenize
        own = np.fromiter(map(known.get, names, itertools.repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(own < 0)
        ids, ends = array.array("I"), []
        for k in new.tolist():
            n = names[k]  # plain ASCII is spelled as it is
            if n != "\n":
                ids.extend([t.id for t in tokenize(n if n.isascii() else n.translate(self.spelling))])
            known[n] = len(known)
            ends.append(len(ids))
        own[new] = np.arange(len(known) - len(new), len(known))
        self.first = np.concatenate((self.first, self.first[-1] + np.array(ends, np.int64)))
        self.flat = np.concatenate((self.flat, np.array(ids, np.uint32)))
        return self.first[own], self.first[own + 1] - self.first[own]

    def plain_words(self, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after another, and how many each has."""
        found = pa.array(self.PIECE.findall(b"\n".join(distinct).decode().lower()), pa.large_string()).dictionary_encode()
        codes, names = found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False).tolist()
        between = codes == (names.index("\n") if "\n" in names else -1)
        first, size = self.pieces_of(names)
        ids = self.flat[ragged(first[codes], size[codes])]
        return ids, np.bincount(np.cumsum(between), size[codes], len(distinct)).astype(np.int64)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        words = words_of(texts)
        if not words.distinct:
            return [np.empty(0, np.uint32)] * len(texts)
        plain = self.plain(words.distinct)
        flat, own = self.plain_words([w for w, p in zip(words.distinct, plain.tolist(), strict=True) if p]) if plain.any() else (np.empty(0, np.uint32), np.empty(0, np.int64))
        rest = []
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        for k in np.flatnonzero(~plain).tolist():
            w = words.distinct[k]
            ids = self.words.get(w)
            if ids is None:
                ids = self.words[w] = tuple(self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids)
            rest.append(ids)
        lengths, first = np.empty(len(plain), np.int64), np.empty(len(plain), np.int64)
        lengths[plain], lengths[~plain] = own, [len(x) for x in rest]
        first[plain] = np.cumsum(own) - own
        first[~plain] = len(flat) + np.cumsum(lengths[~plain]) - lengths[~plain]
        flat = np.concatenate((flat, np.fromiter(itertools.chain.from_iterable(rest), np.uint32)))
        ids = flat[ragged(first[words.codes], lengths[words.codes])]
        ends = np.concatenate(([0], np.cumsum(lengths[words.codes])))[words.starts]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def word_encoder(path: str) -> WordEncoder:
    if path not in _tokenizers:
        _tokenizers[path] = WordEncoder(path)
    return _tokenizers[path]


def build_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """The file's bytes: documents of the given lengths, their ids in one array."""
    pack = zstandard.ZstdCompressor(level=1).compress
    body, header = [], {"n": len(ids), "docs": len(doc_ids), "sections": {}, "planes": []}
    at = 0

    def put(data: bytes) -> list[int]:
        nonlocal at
        body.append(packed := pack(data))
        at += len(packed)
        return [at - len(packed), len(packed)]

    header["sections"]["doc_ids"] = put(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    header["sections"]["nulls"] = put(np.array([d is None for d in doc_ids], "u1").tobytes())
    header["sections"]["starts"] = put(np.cumsum([0, *lengths], dtype="<u8").tobytes())
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    level = ids.astype(np.uint16 if top <= 16 else np.uint32)
    for bit in range(top - 1, -1, -1):
        ones = level & level.dtype.type(1 << bit) != 0
        packed = np.packbits(ones, bitorder="little")
        frames = [put(packed[k : k + FRAME_BITS // 8].tobytes()) for k in range(0, len(packed), FRAME_BITS // 8)]
        counts = np.cumsum([0, *(int(np.bitwise_count(packed[k : k + FRAME_BITS // 8]).sum()) for k in range(0, len(packed), FRAME_BITS // 8))])
        header["planes"].append({"bit": bit, "zeros": int(len(level) - counts[-1]), "frames": frames, "before": counts[:-1].tolist()})
        level = np.concatenate((level.compress(~ones), level.compress(ones)))
    head = json.dumps(header, separators=(",", ":")).encode()
    return b"".join((MAGIC, struct.pack("<Q", len(head)), head, *body))


class WaveletFile:
    """Reads one file's bytes."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        size = struct.unpack_from("<Q", data, 8)[0]
        self.header = json.loads(data[16 : 16 + size])
        self.data, self.base, self.n = data, 16 + size, self.header["n"]
        self.planes = self.header["planes"]
        self._frames: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        nulls = self._section("nulls", "u1")
        self.doc_ids = [None if z else int(d) for d, z in zip(self._section("doc_ids", "<i8"), nulls, strict=True)]
        self.starts = self._section("starts", "<u8").astype(np.int64)

    def _raw(self, place: list[int]) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.data[self.base + place[0] : self.base + place[0] + place[1]])

    def _section(self, name: str, dtype: str) -> np.ndarray:
        return np.frombuffer(self._raw(self.header["sections"][name]), dtype)

    def _frame(self, plane: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The frame's bytes, and the ones of the plane before each of its bytes."""
        if (plane, k) not in self._frames:
            packed = np.frombuffer(self._raw(self.planes[plane]["frames"][k]), np.uint8)
            before = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=before[1:])
            self._frames[plane, k] = packed, before + self.planes[plane]["before"][k]
        return self._frames[plane, k]

    def _bits(self, plane: int) -> np.ndarray:
        packed = b"".join(self._raw(x) for x in self.planes[plane]["frames"])
        return np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").astype(bool)

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of the plane."""
        if i <= 0 or not self.n:
            return 0
        k, rest = divmod(i - 1, FRAME_BITS)
        packed, before = self._frame(plane, k)
        whole, odd = divmod(rest + 1, 8)
        return int(before[whole]) + (int(packed[whole] & ((1 << odd) - 1)).bit_count() if odd else 0)

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p, plane in enumerate(self.planes):
            packed, _ = self._frame(p, i // FRAME_BITS)
            bit = int(packed[i % FRAME_BITS // 8]) >> (i % 8) & 1
            ones = self._rank1(p, i)
            i = plane["zeros"] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """The token's places below the last plane, for positions lo..hi."""
        lo, hi = max(0, lo), min(self.n, hi)
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for p, plane in enumerate(self.planes):
            a, b = self._rank1(p, lo), self._rank1(p, hi)
            lo, hi = (plane["zeros"] + a, plane["zeros"] + b) if token >> plane["bit"] & 1 else (lo - a, hi - b)
        return lo, max(lo, hi)

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often the token stands at positions lo..hi (hi excluded)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of the token, ascending: places at the bottom, selected upwards plane by plane."""
        a, b = self._range(token, 0, self.n)
        at = np.arange(a, b)
        for p in range(len(self.planes) - 1, -1, -1):
            bits = self._bits(p)
            one = token >> self.planes[p]["bit"] & 1
            at = np.flatnonzero(bits if one else ~bits)[at - (self.planes[p]["zeros"] if one else 0)]
        return at

    def ids(self) -> np.ndarray:
        """All ids in order, rebuilt from the last plane upwards."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for p in range(len(self.planes) - 1, -1, -1):
            bits, zeros = self._bits(p), self.planes[p]["zeros"]
            up = np.empty_like(out)
            # by place: a mask of mixed bits is slow to assign through
            up[np.flatnonzero(~bits)] = out[:zeros]
            up[np.flatnonzero(bits)] = out[zeros:] | out.dtype.type(1 << self.planes[p]["bit"])
            out = up
        return out


def _save(folder: str, name: str, data: bytes) -> None:
    files, base = arrow_fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    context = TaskContext.get()
    temporary = f"{base}/_{name}.{context.taskAttemptId() if context else 0}"
    with files.open_output_stream(temporary) as out:
        out.write(data)
    files.move(temporary, f"{base}/{name}")


def write_shards(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int | None, n_parts: int | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode (doc_id, text) and write wavelet files to ``folder``, a shared one.

    Returns the manifest, itself written there: part, seq, file, docs, ids.
    ``end_id`` closes every document (None: nothing added). Null texts count
    as empty; a null doc_id comes first; rows of one doc_id follow each other
    by a hash of their texts. An empty table writes no file. ``folder`` may be a path or
    a URI of a file system that pyarrow opens (file, hdfs, s3, gs).
    """
    spark = docs.sparkSession
    small_batches(spark)
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part, seq = word_encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        doc_ids, arrays, total = [], [], 0

        def close() -> pd.DataFrame:
            nonlocal doc_ids, arrays, total, seq
            name = f"shard-{part:06d}-{seq:06d}.wav"
            _save(folder, name, build_file(doc_ids, [len(a) for a in arrays], np.concatenate(arrays)))
            row = pd.DataFrame({"part": [part], "seq": [seq], "file": [name], "docs": [len(doc_ids)], "ids": [total]})
            doc_ids, arrays, total, seq = [], [], 0, seq + 1
            return row

        for batch in gathered(batches, "text", BATCH_CHARS):
            for doc_id, own in zip(batch["doc_key"], encoder.encode([utf8(t) for t in batch["text"]]), strict=True):
                ids = np.concatenate((own, end))
                if total and total + len(ids) > shard_ids:
                    yield close()
                doc_ids.append(None if doc_id is None else int(doc_id))
                arrays.append(ids)
                total += len(ids)
        if doc_ids:
            yield close()

    dealt = (
        docs.select(F.col("doc_id").cast("string").alias("doc_key"), F.col("doc_id").alias("doc_order"), "text")
        # the text's hash splits an id, or the null id, that holds many rows
        .withColumn("text_hash", F.xxhash64("text"))
        .repartitionByRange(n_parts, "doc_order", "text_hash")
        .sortWithinPartitions("doc_order", "text_hash", "text")
        .select("doc_key", "text")
    )
    manifest = dealt.mapInPandas(encode, "part int, seq int, file string, docs long, ids long")
    manifest.write.parquet(f"{folder}/manifest.parquet")
    return spark.read.schema("part int, seq int, file string, docs long, ids long").parquet(f"{folder}/manifest.parquet")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document out of the files, in the order of (part, seq, ordinal): doc_id, start (ids of all
    documents before it), ids (packed little-endian unsigned 32-bit integers)."""
    spark = manifest.sparkSession

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                shard = WaveletFile(bytes(content))
                ids = shard.ids().astype("<u4")
                name = path.rsplit("/", 1)[-1]
                for some in chunks(list(range(len(shard.doc_ids))), 2048):
                    spans = [(int(shard.starts[k]), int(shard.starts[k + 1])) for k in some]
                    yield pd.DataFrame(
                        {
                            "file": name,
                            "doc_id": pd.array([shard.doc_ids[k] for k in some], dtype="Int64"),
                            "local_start": [a for a, _ in spans],
                            "ids": [ids[a:b].tobytes() for a, b in spans],
                        }
                    )

    # Places of the files: sums within a part, then over the few parts.
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    before = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("seq")
    files = manifest.select("part", "file", (F.sum("ids").over(in_part) - F.col("ids")).alias("file_start")).join(before, "part")
    files = files.select("file", (F.col("part_start") + F.col("file_start")).alias("file_start"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    read = content.select("path", "content").mapInPandas(decode, "file string, doc_id long, local_start long, ids binary")
    return read.join(files, "file").select("doc_id", (F.col("file_start") + F.col("local_start")).alias("start"), "ids")


def token_shards(docs: DataFrame, tokenizer_file: str, end_id: int | None) -> DataFrame:
    """Write all documents to wavelet files of this run, and read them back."""
    folder = run_folder(docs.sparkSession, "token-shards")
    return read_documents(write_shards(docs, folder, tokenizer_file, end_id), folder)

