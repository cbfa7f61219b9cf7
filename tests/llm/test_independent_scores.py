"""Scores of the fitted models, computed again by plain loops."""

import math
import random

import numpy as np
import pytest

from clusterlens.llm import latent_vote, rule_forest, toxicity


def prose(rng, n, bad):
    words = ["the", "of", "river", "stone", "light", "garden", "paper", "music"]
    return " ".join(rng.choice(words) + (rng.choice(["%%%", "###", "!!"]) if bad and rng.random() < 0.5 else "") + str(rng.randrange(20)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    return [(prose(rng, rng.randrange(25, 90), k % 4 == 0).encode(), int(k % 4 != 0)) for k in range(200)]


def test_votes_of_exact_neighbours(texts):
    """Cosine with every labelled vector, one by one; the 31 nearest vote with cosine^8, a ten thousandth for the prior."""
    train, held = texts[:150], texts[150:]
    voter = latent_vote.fit(latent_vote.terms([t for t, _ in train]), np.array([y for _, y in train], float))
    found = latent_vote.terms([t for t, _ in held] + [b""])
    got = voter.score(found)
    own = voter.latent(found.dense(0, len(found), latent_vote.DIMS)).astype(np.float64)
    for k in range(len(held)):
        near = sorted(((sum(float(a) * float(b) for a, b in zip(own[k], v, strict=True)), float(y)) for v, y in zip(voter.vectors, voter.labels, strict=True)), reverse=True)
        if near[30][0] - near[31][0] < 1e-5:
            continue  # a tie at the last place
        weights = [(min(1.0, max(0.0, c)) ** 8, y) for c, y in near[:31]]
        want = (sum(w * y for w, y in weights) + 1e-4 * voter.prior) / (sum(w for w, _ in weights) + 1e-4)
        assert got[k] == pytest.approx(want, abs=1e-4)
    assert got[-1] == 0
    assert sum((g >= 0.5) == bool(y) for g, (_, y) in zip(got, held, strict=False)) >= 48


def test_paths_of_the_forest(texts):
    """Every text walked down every tree by itself: 2^(-mean path length / usual path length)."""
    found = rule_forest.statistics([t for t, _ in texts])
    forest = rule_forest.fit(found, np.array([y for _, y in texts]))
    rows = found[rule_forest.FEATURES].to_numpy(float)
    got = forest.score(rows)
    for k in range(0, len(rows), 7):
        lengths = []
        for t in range(len(forest.feature)):
            node = 0
            while (f := int(forest.feature[t][node])) >= 0:
                node = int(forest.left[t][node]) + (1 if rows[k][f] >= forest.cut[t][node] else 0)
            lengths.append(float(forest.length[t][node]))
        assert got[k] == pytest.approx(2 ** (-(sum(lengths) / len(lengths)) / forest.scale), abs=1e-12)
        failed = bool(found["n_words"][k] < 20 or 100 * found["n_repeat_words"][k] > 30 * found["n_words"][k])
        assert forest.keeps(found.iloc[[k]])[0] == (not failed and got[k] <= forest.limit)
    assert math.isclose(forest.scale, 2 * (math.log(min(rule_forest.SUBSAMPLE, 150) - 1) + 0.5772156649) - 2 * (min(rule_forest.SUBSAMPLE, 150) - 1) / min(rule_forest.SUBSAMPLE, 150), rel_tol=0.1)


def test_margins_of_the_toxicity_model(texts):
    """The logistic function of the bias and the weight of each distinct feature of the text's words."""
    marked = [(t + (b" idiot scum" if k % 3 == 0 else b""), float(k % 3 == 0)) for k, (t, _) in enumerate(texts)]
    own = toxicity.terms([t for t, _ in marked])
    empty = toxicity.difference(own, toxicity.terms([]), np.empty(0, np.int64))
    model = toxicity.fit(own, np.array([y for _, y in marked]), empty)
    got = model.score(own)
    for k in range(0, len(marked), 9):
        features = {f for w in marked[k][0].split() for f in toxicity.of_word(w)}
        margin = model.bias + sum(model.weights[f] for f in features)
        assert got[k] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)
    assert np.mean((got >= 0.5) == np.array([y for _, y in marked])) > 0.95
