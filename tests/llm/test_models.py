"""Scores of the learned models against slow versions that follow their definitions."""

import math
import random

import numpy as np
import pytest

from guidepost.llm import language, quality_model
from guidepost.llm.textops import grams, words_of


def slow_code(model, profile):
    """The nearest codeword by weighted logistic loss, its probability, and whether it is close."""
    losses = []
    for word in model.code:
        loss = 0.0
        for bit in range(len(word)):
            margin = sum(float(x) * w for x, w in zip(profile, model.weights[:-1, bit]))
            margin += model.weights[-1, bit]
            loss += model.trust[bit] * math.log1p(math.exp(-margin * word[bit]))
        losses.append(loss)
    best = losses.index(min(losses))
    share = 1 / sum(math.exp(losses[best] - loss) for loss in losses)
    second = sorted(losses)[1]
    return best, share, second - losses[best] < language.CLOSE * second


@pytest.mark.parametrize("classes", [3, 9])
def test_decoding_equals_a_slow_decoder(classes):
    rng = np.random.default_rng(classes)
    code = language.codewords(classes)
    few = 12
    weights = np.zeros((language.FEATURES + 1, code.shape[1]))
    weights[:few] = rng.normal(size=(few, code.shape[1]))
    weights[-1] = rng.normal(size=code.shape[1])
    names = [f"l{i}" for i in range(classes)]
    model = language.Model(names, code, weights, rng.uniform(0.1, 1, code.shape[1]))
    found = np.zeros((25, language.FEATURES), np.float32)
    found[:, :few] = rng.normal(size=(25, few))
    best, share, close = model.decoded(found)
    for i, profile in enumerate(found):
        cut = language.Model(names, code, weights[[*range(few), -1]], model.trust)
        expected = slow_code(cut, profile[:few])
        assert (best[i], bool(close[i])) == (expected[0], expected[2])
        assert share[i] == pytest.approx(expected[1], rel=1e-6)


def slow_score(model, text):
    """The mean of what all words, pairs of words and byte n-grams add to the log-odds."""
    top = 64 - quality_model.BITS
    words = words_of([text])
    numbers = [int(h) >> top for h in words.hash]
    for i in range(len(words.hash) - 1):
        pair = int(grams(words.hash[i : i + 2], np.zeros(2, int), 2)[0][0])
        if words.hash[i] == words.hash[i + 1]:
            pair = int(quality_model.SAME)
        numbers.append(pair >> top)
    for size in quality_model.SIZES:
        for i in range(len(text) - size + 1):
            code = size
            for byte in text[i : i + size]:
                code = (code * 257 + byte) % 2**32
            number = code * 2654435761 % 2**32 >> (32 - quality_model.BITS)
            numbers.append(number + (1 << quality_model.BITS))
    if not numbers:
        return model.prior
    mean = sum(float(model.odds[n]) for n in numbers) / len(numbers)
    return 1 / (1 + math.exp(-(mean + model.offset)))


def test_quality_equals_a_slow_mean():
    rng = random.Random(2)
    odds = np.random.default_rng(2).normal(size=2 << quality_model.BITS).astype(np.float32)
    model = quality_model.Model(odds, 0.3, 0.6)
    texts = [" ".join(rng.choices(["a", "the", "word", "größe", "word"], k=rng.randint(0, 40))).encode() for _ in range(40)]
    texts += [b"", b" ", b"x", "漢字".encode()]
    found = model.scores(texts)
    assert found.tolist() == pytest.approx([slow_score(model, t) for t in texts], rel=1e-4)


def test_learning_equals_slow_gradient_steps(monkeypatch):
    """Softmax regression on averaged vectors, one row at a time, against plain loops."""
    monkeypatch.setattr(quality_model, "BITS", 4)
    monkeypatch.setattr(quality_model, "EPOCHS", 2)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(12):
        numbers = np.unique(rng.integers(0, 32, 6)).astype(np.int32)
        rows.append((i % 2, numbers, rng.integers(1, 4, len(numbers)).astype(np.int32)))
    model = quality_model.descend(rows)

    prior = (6 + 1) / (12 + 2)
    random_ = np.random.default_rng(7)
    vectors = random_.uniform(-1, 1, (32, quality_model.DIMENSIONS)) / quality_model.DIMENSIONS
    outputs, offsets = np.zeros((2, quality_model.DIMENSIONS)), [math.log(1 - prior), math.log(prior)]
    done = 0
    for _ in range(2):
        for i in random_.permutation(12):
            label, numbers, counts = rows[i]
            rate = quality_model.RATE * (1 - done / 24)
            done += 1
            share = [c / counts.sum() for c in counts]
            mean = sum(s * vectors[n] for s, n in zip(share, numbers))
            logits = [float(outputs[c] @ mean) + offsets[c] for c in (0, 1)]
            total = sum(map(math.exp, logits))
            wrong = [math.exp(logits[c]) / total - (c == label) for c in (0, 1)]
            change = wrong[0] * outputs[0] + wrong[1] * outputs[1]
            for c in (0, 1):
                outputs[c] = outputs[c] - rate * wrong[c] * mean
                offsets[c] -= rate * 0.1 * wrong[c]
            for s, n in zip(share, numbers):
                vectors[n] = vectors[n] - rate * 10 * s * change
    assert model.odds == pytest.approx(vectors @ (outputs[1] - outputs[0]), rel=1e-3, abs=1e-4)
    assert model.offset == pytest.approx(offsets[1] - offsets[0], rel=1e-4)
