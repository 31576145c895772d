"""Periodic runs against a search of every period and place."""

import hashlib
import random
import zlib

from tidemark.llm.periodic_runs import periodic_runs, z_function
from tidemark.llm.queries import op13_periodic_runs


def brute(words):
    """(start, length, period) of every run of a list of words, by trying every period."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def some_words(rng):
    n = rng.randrange(0, rng.choice([12, 80, 400]))
    w = [str(rng.randrange(rng.choice([1, 2, 5, 60]))) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 4:
            a = rng.randrange(n)
            p, e = rng.randrange(1, (n - a) // rng.randrange(2, 9) + 2), rng.randrange(a, n + 1)
            for i in range(a, e):
                w[i] = w[a + (i - a) % p]
    return w


def held(rows):
    return {r.id: ([tuple(x) for x in r.runs], r.n_dropped, r.collapsed) for r in rows}


def test_z_function():
    import numpy as np

    rng = random.Random(4)
    for n in (0, 1, 5, 63, 64, 65, 300):
        w = [rng.randrange(2) for _ in range(n)]
        assert z_function(np.array(w, dtype=np.int32)) == [next((k for k in range(n - i) if w[k] != w[i + k]), n - i) for i in range(n)]


def test_equal_to_every_period(spark):
    rng = random.Random(7)
    texts = {i: some_words(rng) for i in range(300)}
    docs = spark.createDataFrame([(i, " \n".join(w)) for i, w in texts.items()], "id long, text string").repartition(3)
    found = held(periodic_runs(docs, ["id"]).collect())
    for i, w in texts.items():
        runs = brute(w)
        left = collapsed(w, runs)
        assert found[i] == (runs, len(w) - len(left), " ".join(left))


def test_long_texts_over_many_tiles(spark):
    rng = random.Random(9)
    one = ["x"] * 30_000
    root = [f"w{rng.randrange(10 ** 9)}" for _ in range(5000)]
    large = [f"a{i}" for i in range(777)] + root * 5 + root[:1234] + ["end"]
    plain = [f"u{i}" for i in range(60_000)]
    docs = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(large)), (3, " ".join(plain))], "id long, text string")
    found = held(periodic_runs(docs, ["id"]).collect())
    assert found[1] == ([(0, 30_000, 1)], 29_999, "x")
    assert found[2] == ([(777, 26_234, 5000)], 21_234, " ".join(large[:5777] + ["end"]))
    assert found[3] == ([], 0, " ".join(plain))


def test_nulls_empty_repeats_and_clashing_names(spark):
    docs = spark.createDataFrame(
        [(None, "a a a a a a b", 1), (1, None, 2), (2, "", 2), (3, " \t\n", 3), (4, "go go go go go go", 5), (4, "go go go go go go", 5), (5, "a b a b a b a b", 6)],
        "k1 long, text string, runs long")
    rows = periodic_runs(docs, ["k1", "runs"], prefix="_").collect()
    assert sorted(((r.k1, r.runs, [tuple(x) for x in r._runs], r._collapsed) for r in rows), key=repr) == sorted([
        (None, 1, [(0, 6, 1)], "a b"), (1, 2, [], ""), (2, 2, [], ""), (3, 3, [], ""), (4, 5, [(0, 6, 1)], "go"), (4, 5, [(0, 6, 1)], "go"),
        (5, 6, [(0, 8, 2)], "a b")], key=repr)
    assert periodic_runs(docs.limit(0), ["k1"]).collect() == []


def test_query(spark, tmp_path):
    rng = random.Random(2)
    texts = {i: None if i % 97 == 5 else " ".join(some_words(rng)) for i in range(400)}
    spark.createDataFrame([(i, t, "src") for i, t in texts.items()], "doc_id long, text string, period string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for i, text in texts.items():
        w = (text or "").split()
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs, r = brute(w), rows[i]
        best = min(((-length, start, p) for start, length, p in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (r.n_runs, (r.start, r.length, r.period, r.exponent_milli)) == (len(runs), want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(collapsed(w, runs)).encode()).hexdigest()
