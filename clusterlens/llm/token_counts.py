"""Token counts without token ids: pieces are counted once per distinct pre-token.

Pre-tokens are what the library's byte-level split yields. One pass over the
texts sums how often each distinct pre-token occurs in the corpus; the model
then counts the pieces of each distinct pre-token once, and that table is
stored. A second pass finds every document's pre-token frequencies and joins
them with the table:

* the most frequent pre-tokens (``HOT_TOKENS`` at most, each key of at most
  ``KEY_CHARS`` characters, so the list has a fixed bound) meet a broadcast
  list inside the task that reads the text;
* all others are joined by shuffle. Of these none holds more than
  1 / HOT_TOKENS of all occurrences, so no join key is hot at any size.

No step materialises ids, and nothing but the bounded list passes the driver.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterlens.llm.common import ragged, ship, stored

#: Entries of the broadcast list of frequent pre-tokens.
HOT_TOKENS = 1 << 17
#: Longer pre-tokens are joined by their SHA-256, so a key is never longer than this.
KEY_CHARS = 72
#: Texts are worked on together up to about so many bytes.
BATCH_BYTES = 4 << 20
#: Stretches beyond plain ASCII that a worker remembers.
HELD = 100_000

#: Fixed value: the byte-level split pattern for plain characters, which are ASCII and U+00C0..U+017F.
PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ſ0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: UTF-8 bytes of no plain character.
NOT_PLAIN = np.array([b == 0xC2 or b > 0xC5 for b in range(256)])

_splitters: dict[str, "Splitter"] = {}


class Splitter:
    """Pre-tokens and piece counts of one ``tokenizers`` file with a byte-level split and no normaliser.

    ``add_prefix_space`` must be off and added tokens must not strip or hold
    white space: then a stretch that starts at white space behind another
    character splits like the same stretch inside its text. Stretches with an
    added token's string are counted by the whole library, as it does by
    default.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        split = self.tokenizer.pre_tokenizer
        added = self.tokenizer.get_added_tokens_decoder().values()
        plain = not any(t.lstrip or t.rstrip or t.single_word or t.content != "".join(t.content.split()) for t in added)
        if type(split).__name__ != "ByteLevel" or split.add_prefix_space or not split.use_regex or isinstance(self.tokenizer.normalizer, Sequence) or self.tokenizer.normalizer is not None or not plain:
            raise ValueError(f"{path}: a byte-level split without prefix space, without normaliser and with plain added tokens is needed")
        self.special = [t.content.encode() for t in added]
        self.split = split.pre_tokenize_str
        self.spelling = {c: split.pre_tokenize_str(chr(c))[0][0] for c in (*range(0x80), *range(0xC0, 0x180))}
        self.width = np.array([len(self.spelling.get(c, "").encode()) for c in range(0x180)])
        self.known: dict[bytes, tuple[tuple[str, ...], int]] = {}

    def stretch(self, stretch: bytes) -> tuple[tuple[str, ...], int]:
        """Pre-tokens of the stretch, and tokens counted outside them (those of stretches with added tokens)."""
        text = stretch.decode("utf-8", "replace")
        if any(s in stretch for s in self.special):
            return (), len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return tuple(piece for piece, _ in self.split(text)), 0

    def pre_tokens(self, distinct: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
        """Pre-tokens of all stretches one after another, how many each stretch has, and the tokens outside them."""
        size = np.fromiter(map(len, distinct), np.int64, len(distinct))
        joined = b"".join(distinct)
        starts, raw = np.cumsum(size) - size, np.frombuffer(joined, np.uint8)
        # Stretches of plain characters, from white space to a visible one, are split together: no match spans two of them.
        plain = ~np.maximum.reduceat(NOT_PLAIN[raw], starts) & ((raw[starts] == 32) | ((raw[starts] >= 9) & (raw[starts] <= 13))) & (raw[starts + size - 1] > 32)
        if any(s in joined for s in self.special):
            plain &= ~np.array([any(s in d for s in self.special) for d in distinct])
        text = raw[np.repeat(plain, size)].tobytes().decode()
        own_size = np.fromiter(map(len, PLAIN_SPLIT.findall(text)), np.int64)
        ends = np.cumsum(own_size)
        lengths, outside = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        characters = np.add.reduceat((raw & 0xC0) != 0x80, starts)[plain]
        lengths[plain] = np.diff(np.append(np.searchsorted(ends - own_size, np.cumsum(characters) - characters), len(ends)))
        # the library's spelling of these characters, and where each pre-token ends in its bytes
        width = self.width[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        spelled = np.concatenate(([0], np.cumsum(width)))[np.concatenate(([0], ends)).astype(np.int64)]
        found = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(spelled.astype(np.int64)), pa.py_buffer(text.translate(self.spelling).encode()))
        odd = np.flatnonzero(~plain)
        if len(self.known) + len(odd) > HELD:
            self.known.clear()
        rest: list[str] = []
        for k in odd.tolist():
            s = distinct[k]
            own = self.known.get(s) or self.stretch(s)
            if len(s) <= 256:
                self.known[s] = own
            rest += own[0]
            lengths[k], outside[k] = len(own[0]), own[1]
        place = np.empty(len(found) + len(rest), np.int64)
        offsets = np.cumsum(lengths) - lengths
        place[ragged(offsets[plain], lengths[plain])] = np.arange(len(found))
        place[ragged(offsets[odd], lengths[odd])] = len(found) + np.arange(len(rest))
        return pa.concat_arrays([found, pa.array(rest, pa.large_string())]).take(pa.array(place)).dictionary_encode(), lengths, outside

    def pieces(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize(pre_token))


def splitter(path: str) -> Splitter:
    if path not in _splitters:
        _splitters[path] = Splitter(path)
    return _splitters[path]


def join_keys(pre_tokens: pa.Array) -> pa.Array:
    """The pre-tokens themselves; of those from KEY_CHARS bytes on, the SHA-256 behind a mark that makes it longer than any other key."""
    long = np.flatnonzero(pc.binary_length(pre_tokens).to_numpy(zero_copy_only=False) >= KEY_CHARS)
    if not len(long):
        return pre_tokens
    short = [f"sha256:{hashlib.sha256(t.encode()).hexdigest()}~" for t in pre_tokens.take(pa.array(long)).to_pylist()]
    place = np.arange(len(pre_tokens))
    place[long] = len(pre_tokens) + np.arange(len(long))
    return pa.concat_arrays([pre_tokens, pa.array(short, pre_tokens.type)]).take(pa.array(place))


def cut(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Stretches of joined texts that end at ``ends``: codes of all stretches, the distinct ones, and the first of each text.

    A stretch begins at ASCII white space behind a character that is none, so
    no match of the split spans two stretches. Behind last bytes that white
    space beyond ASCII can have, no cut is made: a longer stretch is right, too.
    """
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    # Last bytes of U+0085, U+00A0, U+1680, U+2000..200A, U+2028, U+2029, U+202F, U+205F, U+3000.
    maybe = np.zeros(256, bool)
    maybe[[*range(0x00, 0x21), *range(0x7F, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
    first = np.zeros(len(raw), bool)
    first[1:] = space[1:] & ~maybe[raw[:-1]]
    starts_of_texts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    first[starts_of_texts[starts_of_texts < ends]] = True
    begins = np.flatnonzero(first)
    first_of = np.searchsorted(begins, np.concatenate((starts_of_texts, ends[-1:])))
    if not len(begins):
        return np.empty(0, np.int64), [], first_of
    offsets = pa.py_buffer(np.append(begins, len(raw)).astype(np.int64))
    entries = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
    return entries.indices.to_numpy().astype(np.int64), entries.dictionary.to_pylist(), first_of


class Counted:
    """Pre-tokens of some texts: ``codes`` of all occurrences, ``distinct`` ones, ``text_of`` each occurrence, and tokens
    that were counted outside pre-tokens for each text."""

    def __init__(self, texts: pa.Array, own: Splitter):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        self.n_bytes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        codes, stretches, first_of = cut(b"".join(texts.to_pylist()), np.cumsum(self.n_bytes))
        if not stretches:
            self.codes = self.text_of = np.empty(0, np.int64)
            self.distinct, self.outside = pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
            return
        split, lengths, outside = own.pre_tokens(stretches)
        flat = split.indices.to_numpy().astype(np.int64)
        of = np.repeat(np.arange(len(texts)), np.diff(first_of))
        self.codes = flat[ragged((np.cumsum(lengths) - lengths)[codes], lengths[codes])]
        self.text_of = np.repeat(of, lengths[codes])
        self.distinct = split.dictionary
        self.outside = np.bincount(of, outside[codes], len(texts)).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about BATCH_BYTES of text; a longer text comes alone."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text").cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, "right")))
            yield batch.slice(at, end - at)
            at = end


def piece_counts(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Each distinct pre-token of the texts, by its key: key, occurrences, n_tokens (its pieces, counted once). Stored.

    The file's path must exist on every executor. Null and empty texts have no pre-tokens.
    """

    ship(docs.sparkSession)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(tokenizer_file)
        for batch in _slices(batches):
            found = Counted(batch.column("text"), own)
            yield pa.RecordBatch.from_pydict({"piece": found.distinct.cast(pa.string()), "occurrences": pa.array(np.bincount(found.codes, minlength=len(found.distinct)))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(tokenizer_file)
        for batch in batches:
            pieces = batch.column("piece")
            yield pa.RecordBatch.from_pydict({"key": join_keys(pieces), "occurrences": batch.column("occurrences"), "n_tokens": pa.array(map(own.pieces, pieces.to_pylist()), pa.int64())})

    distinct = docs.select("text").mapInArrow(occurrences, "piece string, occurrences long").groupBy("piece").agg(F.sum("occurrences").alias("occurrences"))
    return stored(distinct.mapInArrow(count, "key string, occurrences long, n_tokens long"), "piece-counts")


def _hot_from(table: DataFrame, most: int) -> int:
    """From how many occurrences on a pre-token is listed: the smallest such number that lists at most ``most`` of them."""
    # Counted by rounded occurrences (four bits of the number are kept): a few hundred rows for any table.
    rounded = F.expr("shiftleft(shiftright(occurrences, greatest(length(bin(occurrences)) - 4, 0)), greatest(length(bin(occurrences)) - 4, 0))")
    sizes = table.groupBy(rounded.alias("least")).agg(F.count("*").alias("n")).collect()
    listed, least = 0, 1 << 62
    for r in sorted(sizes, key=lambda r: -r["least"]):
        listed += r["n"]
        if listed > most:
            break
        least = r["least"]
    return least


def count_tokens(docs: DataFrame, tokenizer_file: str, hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens.

    As the library's ``encode(text, add_special_tokens=False)`` without
    truncation and padding; strings of added tokens inside texts count as
    those tokens. Null texts count as empty, with no bytes and no tokens.
    Null and repeated ids keep a row each. Other columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    table = piece_counts(docs, tokenizer_file)
    is_hot = F.col("occurrences") >= _hot_from(table, hot_tokens)
    listed = table.where(is_hot).select("key", "n_tokens").toArrow()
    hot = spark.sparkContext.broadcast((listed.column("key").to_pylist(), listed.column("n_tokens").to_numpy()))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (hot_keys, hot_tokens_of) = splitter(tokenizer_file), hot.value
        known, tokens_of = pa.array(hot_keys, pa.large_string()), np.append(hot_tokens_of, -1)
        row = TaskContext.get().partitionId() << 33
        for batch in _slices(batches):
            found = Counted(batch.column("text"), own)
            n = batch.num_rows
            keys = join_keys(found.distinct)
            each = tokens_of[pc.fill_null(pc.index_in(keys, value_set=known), len(known)).to_numpy()][found.codes]
            sums = found.outside + np.bincount(found.text_of, np.where(each > 0, each, 0), n).astype(np.int64)
            rare = each < 0
            width = max(1, len(keys))
            pairs, freq = np.unique(found.text_of[rare] * width + found.codes[rare], return_counts=True)
            names = keys.take(pa.array(pairs % width)).cast(pa.string())
            offsets = np.searchsorted(pairs, np.arange(n + 1) * width)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([names, pa.array(freq, pa.int64())], ["key", "freq"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(n)), batch.column("doc_id"), pa.array(found.n_bytes), pa.array(sums), lists],
                ["row", "doc_id", "n_bytes", "known", "rare"],
            )
            row += n

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.mapInArrow(frequencies, f"row long, doc_id {id_type}, n_bytes long, known long, rare array<struct<key: string, freq: long>>")
    # One more entry per row carries its id and what is known. Its key holds a blank, which no byte-level pre-token does.
    own_entry = F.struct(F.concat(F.lit("row "), F.col("row").cast("string")).alias("key"), F.col("known").alias("freq"), F.lit(True).alias("own"))
    entries = F.concat(F.array(own_entry), F.transform("rare", lambda x: F.struct(x["key"], x["freq"], F.lit(False).alias("own"))))
    flat = rows.select("row", "doc_id", "n_bytes", F.explode(entries).alias("e")).select("row", "e.*", *[F.when(F.col("e.own"), F.col(c)).alias(c) for c in ("doc_id", "n_bytes")])
    rest = table.where(~is_hot).select("key", "n_tokens")
    missing = F.raise_error(F.lit("a pre-token of the second pass was not met in the first")).cast("long")
    pieces = F.when(F.col("own"), 1).when(F.col("n_tokens").isNotNull(), F.col("n_tokens")).otherwise(missing)
    return (
        flat.join(rest, "key", "left")
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(F.col("freq") * pieces).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens")
    )
