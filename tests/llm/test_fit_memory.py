"""Fitting a field block by block: its memory, and that blocks do not change what is learned."""

import tracemalloc

import numpy as np

from tidemark.llm import crf


def examples(n, features, seed=1):
    rnd = np.random.default_rng(seed)
    gold = rnd.integers(0, 3, n)
    feature = rnd.integers(0, 1 << 12, (n, features)).astype(np.uint16)
    feature[:, 0] = gold + 3 * rnd.integers(0, 2, n)
    first = np.unique(np.concatenate([[0, n], rnd.integers(0, n, n // 40)]))
    return feature.reshape(-1), np.arange(n + 1) * features, np.arange(n), first, gold


def fitted(given, rounds):
    model = crf.Model(1 << 12, 3)
    model.fit(*given, rounds)
    return model


def test_fitting_holds_little_beside_its_input():
    given = examples(200_000, 16)
    tracemalloc.start()
    fitted(given, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # 3.2 million features; before, weights of all of them at once


def test_blocks_do_not_change_what_is_learned(monkeypatch):
    given = examples(5_000, 8)
    whole = fitted(given, 5)
    monkeypatch.setattr(crf, "BLOCK", 64)
    parts = fitted(given, 5)
    assert np.allclose(whole.weights, parts.weights, atol=1e-4) and np.allclose(whole.transition, parts.transition)
