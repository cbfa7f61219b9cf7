"""Token files: an id that holds most rows is dealt over tasks, and ids stay exact."""

import time

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clusterlens.llm import wavelet_tokens
from clusterlens.llm.common import run_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["İstanbul ×÷ ſ ÿ Ÿ ŉ", "<|startoftext|> a<|endoftext|>b", "it's we'LL 's", "\x7f a\x00b", "é́ é", "", "  \n", "ẞ ß", "'sab n'T", ":-) ...x9y", "日本 語", "a" * 3000]


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(VOCABULARY), wavelet_tokens.WordEncoder(VOCABULARY)
    for texts in (ODD, ODD[::-1], [""], ["plain words only"], ["日本"], []):
        got = own.encode([t.encode() for t in texts])
        assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_plain_words_are_those_of_the_pattern():
    own = wavelet_tokens.WordEncoder(VOCABULARY)
    words = [chr(c) for c in range(0x21, 0x600)] + ["a" + chr(c) + "z" for c in range(0x7F, 0x200)] + ["\u0300e", "日本", "<|endoftext|>", "x<|endoftext|>", "\ud800"]
    raw = [w.encode("utf-8", "surrogatepass") for w in words] + [b"\xc3", b"\x80", b"a\xc3b", b"\xc3\xa9\xa9", b"\xc3\xc3\xa9"]
    raw = [w for w in raw if w.split() == [w]]
    want = [bool(own.PLAIN.fullmatch(w.decode("utf-8", "replace"))) and b"<|endoftext|>" not in w for w in raw]
    assert own.plain(raw).tolist() == want and own.plain(raw[::-1]).tolist() == want[::-1]


def test_pieces_are_known_by_number_and_forgotten_together(monkeypatch):
    library, own = Tokenizer.from_file(VOCABULARY), wavelet_tokens.WordEncoder(VOCABULARY)
    monkeypatch.setattr(wavelet_tokens, "CACHE_WORDS", 40)
    for k in range(12):
        texts = [f"word{k % 5} stone{chr(97 + j)}x é{chr(97 + j + k % 7)} it's {j}" for j in range(9)] + ODD
        got = own.encode([t.encode() for t in texts])
        assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert len(own.first) == len(own.pieces) + 1 and own.first[-1] == len(own.flat)
        assert all(isinstance(x, int) for x in own.pieces.values())


def test_planes_take_a_few_passes_over_the_ids():
    """Through masks of mixed bits, writing and reading took some thirty times a stable sort of the ids; by place it is about eight."""
    ids = np.random.default_rng(5).integers(0, 49_000, 1 << 20).astype(np.uint32)

    def least(work) -> float:
        took = []
        for _ in range(3):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    shard = wavelet_tokens.WaveletFile(wavelet_tokens.build_file([1], [len(ids)], ids))
    assert (shard.ids() == ids).all()
    both = least(lambda: wavelet_tokens.build_file([1], [len(ids)], ids)) + least(shard.ids)
    assert both < 18 * least(lambda: np.argsort(ids.astype(np.uint16), kind="stable"))


def test_a_hot_id_is_dealt_over_tasks(spark):
    rows = [(None if k % 3 else k, f"text {k % 1500} of words") for k in range(3000)] + [(None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = run_folder(spark, "test-shards")
    manifest = wavelet_tokens.write_shards(docs, folder, VOCABULARY, 2, n_parts=8)
    per = [r["n"] for r in manifest.groupBy("part").agg(F.sum("docs").alias("n")).collect()]
    assert sum(per) == 3002 and max(per) < 0.3 * 3002
    back = wavelet_tokens.read_documents(manifest, folder).orderBy("start").collect()
    ids = [r["doc_id"] for r in back]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    lengths = [len(r["ids"]) // 4 for r in back]
    assert [r["start"] for r in back] == np.concatenate(([0], np.cumsum(lengths)[:-1])).tolist()
    library = Tokenizer.from_file(VOCABULARY)
    assert sorted(bytes(r["ids"]) for r in back) == sorted(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in rows)
