"""Scores of the learned operators, spelt out in plain Python from the models' tables."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tidal.llm import language, quality, toxicity

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, now = [], ""
    for ch in text.translate(LOWER):
        if ch in SPACE:
            out, now = out + [now] * bool(now), ""
        else:
            now += ch
    return [w.encode() for w in out + [now] * bool(now)]


def bucket(gram, bits):
    x = 0x811C9DC5 ^ (len(gram) * 0x01000193 & 0xFFFFFFFF)
    for b in gram:
        x = (x ^ b) * 0x01000193 & 0xFFFFFFFF
    x ^= x >> 15
    return (x * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits)


def grams(word, orders, bits):
    padded = b" " + word + b" "
    return [bucket(padded[i:i + n], bits) for n in orders for i in range(len(padded) - n + 1)]


def some_texts():
    rng = random.Random(6)
    letters = "abcdefgh XYZ.,!éß"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(60)]
    return texts + ["", " \n", "a", "one", "Two words", "x" * 3000, "same same same", "ÀÉ  tab\tbed"]


def column(texts):
    return pa.array(texts, pa.large_string())


@pytest.mark.parametrize("window", [1, 2, 3])
def test_toxicity_is_the_largest_window(window):
    rng = np.random.default_rng(1)
    model = toxicity.ToxicityModel(rng.normal(size=1 << toxicity.BITS).astype(np.float32), 0.3, 1.7, -0.4, window)
    texts = some_texts()
    got = toxicity.max_logits(column(texts), model)
    for text, z in zip(texts, got, strict=True):
        words = [grams(w, toxicity.ORDERS, toxicity.BITS) for w in words_of(text)]
        windows = [words[i:i + window] for i in range(max(1, len(words) - window + 1))] if words else []
        want = max((sum(float(model.table[b]) for w in part for b in w) / max(1, sum(map(len, part))) + model.bias for part in windows),
                   default=-math.inf)
        assert z == pytest.approx(want, abs=1e-4)
        score = float(model.score(np.array([z]))[0])
        assert score == pytest.approx(0.0 if not words else 1 / (1 + math.exp(-(1.7 * want - 0.4))), abs=1e-4)


def test_language_scores_are_softmaxes_of_means():
    rng = np.random.default_rng(2)
    model = language.LanguageModel(("de", "en", "fr"), rng.normal(size=(1 << language.BITS, 3)).astype(np.float32),
                                   np.array([0.1, -0.2, 0.0]), 0.7, 0.4)
    texts = some_texts()
    got = model.scores(language.mean_rows(column(texts), model.table))
    for text, p in zip(texts, got, strict=True):
        found = [b for w in words_of(text) for b in grams(w, language.ORDERS, language.BITS)]
        mean = [sum(float(model.table[b, k]) for b in found) / max(1, len(found)) for k in range(3)]
        z = [math.exp((m + b) / 0.7) for m, b in zip(mean, model.bias, strict=True)]
        assert p == pytest.approx([x / sum(z) for x in z], abs=1e-4)


def test_quality_scores_are_means_of_grams_and_repeats():
    rng = np.random.default_rng(3)
    weak = quality.WeakModel(0.8, np.full((2, len(quality.LABELLERS)), 0.1))
    model = quality.QualityModel(weak, rng.normal(size=1 << quality.BITS).astype(np.float32), -2.0, 0.25)
    texts = some_texts()
    for text, got in zip(texts, model.scores(column(texts)), strict=True):
        words = words_of(text)
        if not words:
            assert got == quality.EMPTY_SCORE
            continue
        found = [b for w in words for b in grams(w, quality.ORDERS, quality.BITS)]
        plain = text.split()
        again = sum(a == b for a, b in zip(plain, plain[1:])) / len(plain)
        z = sum(float(model.weights[b]) for b in found) / max(1, len(found)) - 2.0 * again + 0.25
        assert got == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def test_posterior_is_bayes_rule():
    rng = np.random.default_rng(4)
    weak = quality.WeakModel(0.7, rng.uniform(0.05, 0.95, (2, len(quality.LABELLERS))))
    votes = rng.integers(-1, 2, (200, len(quality.LABELLERS)))
    for v, got in zip(votes, weak.posterior(votes), strict=True):
        good, bad = 0.7, 0.3
        for k, x in enumerate(v):
            if x:
                good *= weak.bad_vote[1, k] if x == -1 else 1 - weak.bad_vote[1, k]
                bad *= weak.bad_vote[0, k] if x == -1 else 1 - weak.bad_vote[0, k]
        assert got == pytest.approx(good / (good + bad), rel=1e-9)


def test_em_finds_planted_accuracies_under_a_weak_prior():
    """Votes drawn from a known model: shares and accuracies come back, and no step lowers the likelihood."""
    rng = np.random.default_rng(5)
    n, k = 40_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    truth = np.stack([np.linspace(0.4, 0.9, k), np.linspace(0.02, 0.1, k)])
    votes = np.where(rng.random((n, k)) < truth[good.astype(int)], -1, 1) * (rng.random((n, k)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)

    def likelihood(m):
        against, for_ = patterns == -1, patterns == 1
        per_class = [np.prod(np.where(against, m.bad_vote[c], np.where(for_, 1 - m.bad_vote[c], 1.0)), axis=1) for c in (0, 1)]
        return float(counts @ np.log((1 - m.share_good) * per_class[0] + m.share_good * per_class[1]))
    steps = [quality.expectation_maximisation(patterns, counts, steps=s, worth=0.0, most=0.999) for s in (1, 2, 4, 8, 16, 200)]
    found = [likelihood(m) for m in steps]
    assert all(b >= a - 1e-3 * abs(a) for a, b in zip(found, found[1:]))
    assert steps[-1].share_good == pytest.approx(0.8, abs=0.02)
    assert np.abs(steps[-1].bad_vote - truth).max() < 0.03
