"""Token counts against the library itself."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clusterlens.llm import token_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", "   \n\t ", "one", "a  b\tc", " nbsp em É ß İ Σας", "<|endoftext|> it's 'S", "  <|endoftext|>  x <|endoftext|>y<|endoftext", "\n" * 5 + "x" + " " * 5000 + "y",
    "q" * 3000, "é" * 700, "привет мир, как дела", "你好 世界 。 x", "a  b", "x\x85 y", "\x1c \x1c a", " ", "a ", "''s 're n't I'LL", "x  y　 z", "🙂 🙂🙂", "\x00 \x00\x7f a\x7f b", "1 22 333a4", "...\n\n  - x\r\n\ty",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_stretches_split_like_whole_texts(library):
    rng, own = random.Random(4), token_counts.Splitter(VOCABULARY)
    signs = ["a", "B", "7", " ", "  ", "\n", "\t", "'s", "'", ".", "é", "ß", "×", "÷", "ſ", "ƀ", "ª", "½", "я", " ", " ", "　", "\x85", "中", "<|endoftext|>", "<|end"]
    for _ in range(300):
        texts = ["".join(rng.choices(signs, k=rng.randrange(0, 25))) for _ in range(rng.randrange(1, 5))]
        found = token_counts.Counted(pa.array(texts), own)
        sums = found.outside.copy()
        for code, text in zip(found.codes, found.text_of, strict=True):
            sums[text] += own.pieces(found.distinct[code].as_py())
        assert sums.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts], texts


@pytest.mark.parametrize("hot", [0, 5, 1000])
def test_counts_equal_the_library(spark, library, hot):
    rng = random.Random(hot)
    prose = [" ".join(rng.choice(["the", "of", "river,", "stone's", "mnblx"]) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 200))) for _ in range(40)]
    long = " ".join(prose) * 20
    # null ids, repeated ids and repeated rows; the other columns have the operator's own names
    rows = [(k % 7 if k % 5 else None, t, "e", 1, True) for k, t in enumerate([*ODD, *ODD, *prose, long])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string, n_tokens int, own boolean").repartition(3)
    got = sorted(map(tuple, token_counts.count_tokens(docs, VOCABULARY, hot).collect()), key=str)
    assert got == sorted(((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in rows), key=str)


def test_empty_and_one_sided_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, token_counts.count_tokens(docs, VOCABULARY).collect())) == [(1, 0, 0), (2, 0, 0)]
    assert token_counts.count_tokens(docs.limit(0), VOCABULARY).count() == 0
    text_ids = spark.createDataFrame([("x", "hello world")], "doc_id string, text string")
    assert [tuple(r) for r in token_counts.count_tokens(text_ids, VOCABULARY).collect()] == [("x", 11, 2)]


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Splitter(public_tokenizers.path("word_bpe_49k.json"))


def test_rare_pre_tokens_join_by_shuffle_on_the_token(spark):
    docs = spark.createDataFrame([(k, f"word{k} the") for k in range(50)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = token_counts.count_tokens(docs, VOCABULARY, 1)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" in plan
        # the entries that carry a row's id have keys of their own, none that all rows share
        assert counted.agg(F.count("*")).first()[0] == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
