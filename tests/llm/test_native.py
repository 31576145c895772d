"""Operators in DataFrame functions: against the same rules in plain Python."""

import random
from hashlib import sha256

import xxhash

from pyspark.sql import functions as F

from tidemark.llm.order_minhash import fingerprint, likeness, order_minhash
from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import judge, seed_urls

MASK = (1 << 64) - 1


def of_longs(*values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little"), seed)
    return seed


def plain_fingerprint(text, k=3, bins=32, size=2):
    words = (text or "").split()
    hashes = []
    for i in range(max(len(words) - k + 1, min(len(words), 1))):
        h = 42
        for w in words[i : i + k]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        hashes.append((h >> 1) >> 24)
    seen, numbers = {}, []
    for i, h in enumerate(hashes):
        n = seen[h] = seen.get(h, -1) + 1
        if n:
            occurrence = xxhash.xxh64_intdigest((n).to_bytes(4, "little"), of_longs(h))
            h = (occurrence >> 1) >> 24
        numbers.append((h, i))
    out = []
    for b in range(bins):
        own = sorted(x for x in numbers if x[0] >> 34 == b)[:size]
        if not own:
            out.append(None)
            continue
        out.append(of_longs(*[h for h, _ in sorted(own, key=lambda x: x[1])]) & 0x7FFFFFFF)
    return out


def test_fingerprints_match_plain_python(spark):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choices("abcdefgh", k=n)) for n in (1, 2, 3, 9, 200, 900)] + ["", None, " \t x\n", "la " * 50]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", fingerprint(F.col("text")).alias("f")).collect()
    for r in rows:
        assert r.f == plain_fingerprint(texts[r.i]), texts[r.i]


def test_order_matters(spark):
    text = " ".join(f"w{k}" for k in range(300))
    words = text.split()
    swapped = " ".join(words[150:] + words[:150])
    edited = " ".join(words[:140] + ["new"] + words[141:])
    row = spark.createDataFrame([(text, swapped, edited)], "a string, b string, c string").select(
        likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("b"), likeness(fingerprint(F.col("a")), fingerprint(F.col("c"))).alias("c"),
        likeness(fingerprint(F.lit("")), fingerprint(F.lit(" "))).alias("none")).first()
    assert row.c > 0.8 > row.b and row.none == 1.0


def test_edited_texts_follow_descending_ids(spark):
    texts = {5: "alpha beta gamma", 9: "one two three four five six", 1: "", 30: None, 12: "ä" * 20, 40: "copy of words", 41: "copy of words"}
    docs = spark.createDataFrame([(i, t, 7) for i, t in [*texts.items(), (9, texts[9]), (None, "no id at all")]], "doc_id long, text string, head int")
    got = {}
    for r in order_minhash(docs.repartition(5)).collect():
        got.setdefault(r.doc_id, []).append(r)
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        t, following = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        edited = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        assert {(r.n_chars, r.edited_sha256) for r in got[i]} == {(len(t), sha256(edited.encode()).hexdigest())}
    assert len(got[9]) == 2 and got[41][0].near_next == 1.0 and got[40][0].fingerprint == got[41][0].fingerprint
    assert got[None][0].edited_sha256 == sha256("no id at".encode()).hexdigest()
    single = order_minhash(docs.where("doc_id = 5")).first()
    assert single.near_next == 1.0
    assert order_minhash(docs.limit(0)).count() == 0


def test_urls_rules_and_learned_verdicts(spark):
    urls = {
        1: "https://WWW.Example.com/en/x?q=/es/", 2: "http://a.example.com/en/1", 3: "http://x.net/es/", 4: "http://x.net/es", 5: "https://shop.com", 6: "https://shop.com/",
        7: "ftp://notexample.com/en/", 8: None, 9: "no scheme here", 10: "http://m.casino.example.org/de/1", 11: "http://library.example.org/de/1", 12: "http://x.net#/fr/", 13: "://h/p"}
    pages = spark.createDataFrame([(i, u, "x") for i, u in urls.items()], "page_id long, url string, host string")
    rows = {r.page_id: r for r in judge(pages, URL_RULES, seed_urls(spark)).collect()}
    assert [(rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) for i in (1, 2, 3)] == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("a.example.com", "/en/1", "example.com/en/", "block"), ("x.net", "/es/", "net/es/", "block")]
    assert [rows[i].rule for i in (4, 5, 6, 7)] == [None, None, "com/", "com/"]
    assert [(rows[i].host, rows[i].path) for i in (8, 9, 12, 13)] == [("", ""), ("", ""), ("x.net", ""), ("h", "/p")]
    assert (rows[10].verdict, rows[11].verdict) == ("block", "allow")
    assert all(r.verdict in ("allow", "block") for r in rows.values())
    assert judge(pages.limit(0), URL_RULES, seed_urls(spark)).count() == 0
    nothing = {r.verdict for r in judge(pages.where("page_id = 8"), URL_RULES, seed_urls(spark).limit(0)).collect()}
    assert nothing == {"allow"}


def test_no_python_in_the_plans(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "c d e")], "doc_id long, text string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    for found in (order_minhash(docs), judge(pages, URL_RULES, seed_urls(spark))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
