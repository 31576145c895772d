"""URL filter: against a plain search for rules, and on names of sites that training did not see."""

import random

from pyspark.sql import functions as F

from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import FOLDS, judge, seed_urls


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path] + [len(path)])
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:stop]


def plain_rule(host, path):
    fitting = [(len(h) + len(p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fitting)[1:] if fitting else (None, None)


def test_host_path_and_rule_match_a_plain_search(spark):
    rnd = random.Random(2)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.www.example.com", "notexample.com", "net", "x.net", "xnet", "", "É.net", "com", "x.org", "h:8080"]
    paths = ["/en/", "/en", "/es/1", "/fr/", "/EN/", "", "/", "//en/", "/x/en/", "/en/://y"]
    urls = [rnd.choice(["http://", "://", "x", "HTTPS://"]) + rnd.choice(hosts) + rnd.choice(paths) + rnd.choice(["", "?a=/en/", "#/fr/", "?://x.net/es/"]) for _ in range(600)]
    urls += [None, "", "://", "http://x.net/es/" + "long/" * 20000, urls[0], urls[0]]
    pages = spark.createDataFrame([(i if i % 7 else None, i, u, "kept out") for i, u in enumerate(urls)], "page_id long, n long, url string, verdict string")
    rows = judge(pages.withColumn("page_id", F.coalesce("page_id", F.lit(None).cast("long"))), URL_RULES, seed_urls(spark, 300)).collect()
    got = sorted((r.page_id or -1, r.host, r.path, r.rule or "") for r in rows)
    want = []
    for i, u in enumerate(urls):
        host, path = plain_parts(u)
        want.append((i if i % 7 else -1, host, path, plain_rule(host, path)[0] or ""))
    assert got == sorted(want)
    verdicts = dict((v or "", {r.verdict for r in rows if r.rule == v}) for v in {r.rule for r in rows})
    for v, h, p in URL_RULES:
        assert verdicts.get(h + p, {v}) == {v}


def test_names_unseen_in_training(spark):
    table = seed_urls(spark).cache()
    hits = wrong = missed = right = 0
    for fold in range(FOLDS):
        held = table.where(F.col("fold") == fold).select(F.struct("url", "verdict", "name").alias("page_id"), "url")
        for r in judge(held, [], table.where(F.col("fold") != fold)).collect():
            gold = r.page_id["verdict"]
            hits += gold == r.verdict == "block"
            wrong += gold == "allow" != r.verdict
            missed += gold == "block" != r.verdict
            right += gold == r.verdict == "allow"
    figures = {"precision": hits / (hits + wrong), "recall": hits / (hits + missed), "allowed": right / (right + wrong)}
    print(figures)
    assert figures["precision"] >= 0.7 and figures["recall"] >= 0.5 and figures["allowed"] >= 0.9, figures


def test_a_score_of_one_half_allows_and_one_verdict_decides(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (2, None)], "page_id long, url string")
    one = seed_urls(spark, 200).where("verdict = 'block'")
    assert [r.verdict for r in judge(pages, [], one).collect()] == ["block"] * 3
    # The same urls under both verdicts: nothing to tell them apart, so every score is one half.
    both = spark.sql("SELECT * FROM VALUES ('http://q.org/', 'allow'), ('http://q.org/', 'block') AS t(url, verdict)")
    assert [(r.score, r.verdict) for r in judge(pages, [], both).collect()] == [(0.5, "allow")] * 3
