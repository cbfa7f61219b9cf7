"""What classifiers learn from: bounded samples, one row an id, and swaps of odd letters."""

import tracemalloc
import zlib

import numpy as np
import pytest

from clusterlens.llm import latent_vote, mixing, rule_forest, toxicity
from clusterlens.llm.common import labelled_sample, sample_texts


def test_one_row_an_id_however_often_it_is_repeated(spark):
    docs = spark.createDataFrame([(k % 7, None if k % 3 == 0 else f"text {k % 5}") for k in range(700)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, 1) for k in range(7)] * 2, "doc_id long, quality int")
    got = sample_texts(docs, labelled_sample(labels, "quality", 100)).collect()
    ids = {r["doc_id"] for r in got}
    assert len(got) == len(ids) and all(r["text"] == "text 0" and r["y"] == 1 for r in got) and ids < set(range(7))


@pytest.mark.parametrize("text", ["ein muſlim und ein chrıstian", "MUſLIMS", "ATHEİST", "the ſ and K signs"])
def test_letters_without_a_term_of_their_own_stay(text):
    change = toxicity.swaps(toxicity.IDENTITY_TERMS)
    assert toxicity.swap_terms(text, change) is None
    assert toxicity.swap_terms(text + " women", change) == text + " men"


@pytest.mark.parametrize("train, label", [(latent_vote.train, "quality"), (toxicity.train, "toxic"), (rule_forest.train, "quality")])
def test_training_takes_repeated_ids_and_odd_letters(spark, train, label):
    words = ["muſlim", "women", "river", "stone", "men", "paper"]
    rows = [(k % 40, " ".join(words[(k % 40 + j) % 6] + "x" * (k % 3) for j in range(30))) for k in range(400)] + [(None, "women"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], f"doc_id long, {label} int")
    assert train(docs, labels, label) is not None


def test_the_rule_forest_learns_from_every_labelled_row(spark, monkeypatch):
    """Odd good rows are 1 in 1,000 (kept: at most 2 in 1,000 may fall) and bad rows have marks of their own; cut and ranges are those of all rows."""
    usual = " ".join(f"word{k}" for k in range(30))
    rows = [(k, usual + f" tail{k % 50}" + (" ! ? !" if k % 500 == 7 else "") if k % 10 else usual + " ###" * (k % 7 + 1)) for k in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k % 10 > 0)) for k in range(12_000)], "doc_id long, quality int")
    counted = []
    cut_of = rule_forest.cut_of
    monkeypatch.setattr(rule_forest, "cut_of", lambda s, good, bad, *a: counted.append((good.sum(), bad.sum())) or cut_of(s, good, bad, *a))
    forest = rule_forest.train(docs, labels)
    taught = [k for k in range(12_000) if zlib.crc32(str(k).encode()) % 5]
    assert len(taught) > 9000 and counted == [(sum(k % 10 > 0 for k in taught), sum(k % 10 == 0 for k in taught))]
    assert len(forest.feature) == rule_forest.TREES and 0 < forest.limit < 1
    again = rule_forest.train(docs.repartition(3), labels)
    assert again.limit == forest.limit and (again.cut == forest.cut).all()


def test_the_cut_is_that_of_single_scores():
    """Counts at distinct scores give the cut that every candidate tried by itself gives."""
    rng = np.random.default_rng(4)
    for n_good, n_bad, loss in ((500, 40, 0.002), (500, 40, 0.05), (30, 0, 0.1), (1, 5, 0.002), (400, 400, 0.2)):
        good, bad = np.round(rng.normal(0.45, 0.05, n_good), 2), np.round(rng.normal(0.6, 0.08, n_bad), 2)
        least = np.sort(good)[max(0, int(np.ceil(n_good * (1 - loss))) - 1)]
        options = np.unique(np.concatenate(([least], good[good >= least], bad[bad >= least])))
        gain = np.array([((bad > c).mean() if n_bad else 0) - (good > c).mean() for c in options])
        best = options[gain >= gain.max() - 1e-12]
        want = best.mean() if not ((good > best[0]) & (good <= best[-1])).any() else best[0]
        scores = np.unique(np.concatenate((good, bad)))
        got = rule_forest.cut_of(scores, (good == scores[:, None]).sum(axis=1), (bad == scores[:, None]).sum(axis=1), loss)
        assert abs(got - want) < 1e-12
    assert rule_forest.cut_of(np.array([0.5]), np.array([0]), np.array([3])) == np.inf


def test_the_fit_holds_one_dense_matrix():
    """What the driver needs beside the weighted rows of the sample is small, and the fit is that of the whole matrices."""
    rng = np.random.default_rng(9)
    found = latent_vote.terms([" ".join(f"word{w}" for w in rng.zipf(1.4, 60) % 5000).encode() for _ in range(1500)] + [b"", b" "])
    labels = rng.integers(0, 2, len(found)).astype(float)
    tracemalloc.start()
    voter = latent_vote.fit(found, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * 1500 * latent_vote.DIMS * 4
    rows = found.dense(0, len(found), latent_vote.DIMS)[:1500]
    assert (voter.idf == np.log(1501 / (1 + (rows > 0).sum(axis=0))).astype(np.float32) + 1).all()
    assert np.allclose(voter.vectors, voter.latent(rows), atol=1e-5) and (voter.labels == labels[:1500]).all() and voter.prior == labels.mean()


def test_the_uses_of_a_mix_are_not_sent_to_the_driver(spark):
    """Uses are as many as documents: only Spark's own measure of their size may have them broadcast."""
    docs = spark.createDataFrame([(k, f"some words {k}", "ab"[k % 2]) for k in range(400)], "doc_id long, text string, source string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = mixing.mix(docs, [3.0, 1.0], 1.5, n_shards=4)
        rows = mixing.mixed_rows(docs, found, 4)
        joins = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x and "__mix_h" in x]
        assert joins and not any("broadcast" in x for x in joins)
        used = {r["doc_id"]: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert used == {r["doc_id"]: r["copies"] for r in found.docs.where("copies > 0").collect()}
