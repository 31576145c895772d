"""Whitening against numpy's dense eigenvalues and exact whole-number sums."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import op12_embedding_whitening


def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0], [3.0, 3.0], list(range(1, 65)), [1.0] * 20, [1e6, 1.0, 1.0, 1.0, 1e-3, 1e-9], [10.0] * 9 + [1.0] * 30, [0.0] * 5 + [2.0],
    [7.0 + 1e-9 * i for i in range(12)] + [0.5] * 12, list(np.geomspace(1, 1e-6, 40))])
def test_leading_pairs(values):
    v = symmetric(np.array(values, dtype=float), len(values))
    v = (v + v.T) / 2
    found, vectors = whitening.leading(v, 8)
    want = np.sort(values)[::-1][:8]
    scale = max(values)
    assert np.abs(found - want).max() <= 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() <= 1e-12
    assert np.abs(v @ vectors - vectors * found).max() <= 1e-11 * scale


def test_inertia_counts_signs():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 30):
        for _ in range(20):
            values = rng.choice([-3.0, -1e-3, 2.0, 50.0], d)
            assert whitening.inertia(symmetric(values, int(rng.integers(1 << 30)))) == ((values < 0).sum(), 0)
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0)
    assert whitening.inertia(np.zeros((3, 3))) == (0, 3)


def test_an_interval_gives_all_of_its_own_and_no_others():
    values = np.array([0.1, 0.9, 1.0, 1.1, 1.2, 2.0, 5.0] + [8.0] * 20)
    found, _ = whitening.feast(symmetric(values, 1), 0.95, 1.5, 3)
    assert np.allclose(np.sort(found), [1.0, 1.1, 1.2], atol=1e-12)


def test_products_are_exact():
    rng = random.Random(5)
    for bound in (100, 1 << 20, 1 << 41):
        y = np.array([[rng.randrange(-bound, bound) for _ in range(3)] for _ in range(700)], dtype=np.int64)
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.products(y).tolist() == want


def rows_of(vectors):
    """Brute force: {(id, component): (deviation, |whitened|, explained)} and n."""
    fit = {k: [math.floor(1024 * c) + 100000 for c in v] for k, v in vectors.items()}
    n, d = len(fit), len(next(iter(fit.values())))
    s = [sum(x[i] for x in fit.values()) for i in range(d)]
    x = np.array(list(fit.values()), dtype=float)
    x -= x.mean(axis=0)
    e, u = np.linalg.eigh(x.T @ x / n)
    e, u = e[::-1], u[:, ::-1]
    w = np.abs(x @ u[:, :8]) / np.sqrt(e[:8])
    dev = {k: sum((n * a - b) ** 2 for a, b in zip(v, s)) for k, v in fit.items()}
    return {(k, j + 1): (dev[k], w[r, j], e[j] / e.sum()) for r, k in enumerate(fit) for j in range(min(8, d))}, n


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    spread = [3.0 / (i + 1) for i in range(12)]
    vectors = {i: [float(np.float32(rng.gauss(0.3, s))) for s in spread] for i in range(300)}
    bad = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [1.0, 2.0]), (905, [])]
    spark.createDataFrame(list(vectors.items()) + bad, "vec_id long, embedding array<float>").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, n = rows_of(vectors)
    rows = op12_embedding_whitening(spark, str(tmp_path)).collect()
    assert len(rows) == len(want)
    for r in rows:
        dev, w, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, dev)
        assert abs(abs(r.whitened) - w) < 1e-9 and abs(r.explained - share) < 1e-12 and r.identity_error < 1e-9
    signs = {}
    for r in rows:
        signs.setdefault(r.component, []).append(r.whitened)
    assert all(abs(sum(v)) < 1e-6 for v in signs.values())  # one sign for all rows, so they still add up to nothing


def test_null_ids_repeats_flat_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>, deviation string"
    rows = [(None, [0.0, 1.0], "a"), (1, [1.0, 0.0], "b"), (1, [1.0, 0.0], "b"), (2, [5.0, 5.0], "c")]
    docs = spark.createDataFrame(rows, schema)
    model = whitening.fit(docs)
    found = whitening.whiten(docs, model, ["vec_id", "deviation"], prefix="_").collect()
    assert model.n == 4 and len(found) == 4 and sum(r.vec_id == 1 for r in found) == 2 and {r.deviation for r in found} == {"a", "b", "c"}
    assert all(len(r._whitened) == 2 for r in found)
    flat = spark.createDataFrame([(i, [2.0, 2.0], "") for i in range(5)], schema)
    for each in (flat, flat.limit(1), flat.limit(0)):
        model = whitening.fit(each)
        assert len(model.values) == 0 and whitening.whiten(each, model, ["vec_id"]).collect() == []


def test_a_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(10 ** 10, [10 ** 15, 10 ** 15], 1.0, np.ones(1), np.ones((2, 1)))
    assert whitening.deviations(np.array([[100000, 100000], [100001, 100000], [200000, 0]]), model).to_pylist() == [0, None, None]
    model.n, model.sums = 1 << 31, [100000 << 31, 100000 << 31]
    assert whitening.deviations(np.array([[100001, 100000]]), model).to_pylist() == [1 << 62]
