"""URL filters: rules on host and path, and logistic regression on hashed character n-grams for what no rule fits.

All of a url's work is in DataFrame functions. The model is trained on the driver from a small labelled url table, of
which at most about `SAMPLE_URLS` rows a verdict (chosen by a hash of the url) are taken. Weights are one literal array,
so scoring neither joins nor shuffles. `seed_urls` makes a table to start from by rules: site names of three kinds (unwanted
subjects, ordinary subjects, and made-up names of syllables, which are ordinary) with additions before and after, in many hosts,
endings and paths. Names are dealt to folds, so that a model can be judged on names it has not seen.

Defined results: a null url, or one without `://`, has an empty host and path, so no rule fits and the model's intercept
decides; where nothing is labelled, or with one verdict only, the verdict is that one (allow if none); a score of
exactly one half allows; a very long url is judged whole, its n-grams in one array; rows without a page_id are judged like others; repeated rows repeat their result; an empty table gives an empty result; only `page_id` and
`url` are read.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SAMPLE_URLS, SEED_URLS, FOLDS = 2000, 6000, 5
BUCKETS, GRAMS = 1 << 12, (3, 4)
ROUNDS, RATE, DECAY = 200, 0.5, 1e-3

# Fixed values of the seed table: subjects of sites, what stands beside them, and parts of addresses. A third of the rows is
# unwanted, a third ordinary by subject, a third ordinary with a made-up name.
UNWANTED = [
    "casino", "poker", "bets", "slots", "jackpot", "roulette", "pills", "viagra", "adult", "xxx", "camgirls", "escort", "porn", "linkfarm", "adserver",
    "clicktrack", "popup", "malware", "phishing", "warez", "cracks", "keygen", "torrents", "payday", "replica", "lottery", "hookup", "fakeid", "steroids", "spam"]
ORDINARY = [
    "news", "weather", "wiki", "docs", "library", "museum", "school", "university", "science", "history", "garden", "recipes", "travel",
    "cycling", "football", "music", "theatre", "health", "hospital", "council", "forum", "research", "software", "photography", "railway",
    "astronomy", "chemistry", "journal", "letters", "dictionary", "bakery", "archive", "gallery", "parish", "harbour"]
SYLLABLES = ["ba", "cor", "den", "el", "fi", "gra", "hol", "in", "jas", "ka", "lem", "mo", "nor", "or", "pi", "qua", "ri", "sol", "ter", "un", "vel", "win", "yar", "zan"]
UNWANTED_EXTRAS = ["", "", "free-", "-online", "cheap-", "-win", "best", "-bonus", "hot", "24", "-deals", "777"]
ORDINARY_EXTRAS = ["", "", "the", "-city", "my", "-club", "old", "-weekly", "open", "-guide", "-society", "21"]
HOSTS = ["www.{}", "{}", "blog.{}", "m.{}", "shop.{}"]
ENDINGS = [".com", ".org", ".net", ".info", ".example.com", ".example.org", ".co.uk", ".de", ".fr"]
PATHS = ["/", "/en/{}", "/de/{}.html", "/fr/{}", "/{}/index.html", "/article/{}", "", "/a/b/{}?page=2"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, host, path) that fits, as text, and its verdict; NULL where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def seed_urls(spark: SparkSession, rows: int = SEED_URLS) -> DataFrame:
    """(url, verdict, name, fold) of the seed table: `rows` rows, of which each part is chosen by a hash of the row's number.
    name: what the site is about; all rows of a name are in one fold."""

    def pick(salt: int, size: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(size)).cast("int")

    def one_of(values: list[str], salt: int) -> Column:
        return F.get(F.array(*map(F.lit, values)), pick(salt, len(values)))

    kind = pick(0, 3)
    made_up = F.concat(*(one_of(SYLLABLES, salt) for salt in (1, 2)), one_of(["", *SYLLABLES], 3))
    named = spark.range(rows).withColumn("name", F.when(kind == 0, one_of(UNWANTED, 4)).when(kind == 1, one_of(ORDINARY, 5)).otherwise(made_up))
    extra = F.when(kind == 0, one_of(UNWANTED_EXTRAS, 6)).otherwise(one_of(ORDINARY_EXTRAS, 6))
    site = F.when(extra.startswith("-") | extra.rlike("^[0-9]"), F.concat("name", extra)).otherwise(F.concat(extra, "name"))
    host = F.concat(F.replace(one_of(HOSTS, 7), F.lit("{}"), site), one_of(ENDINGS, 8))
    path = F.replace(one_of(PATHS, 9), F.lit("{}"), pick(10, 2000).cast("string"))
    url = F.concat(F.when(pick(11, 2) == 0, "http://").otherwise("https://"), host, path)
    return named.select(
        url.alias("url"), F.when(kind == 0, "block").otherwise("allow").alias("verdict"), "name", F.pmod(F.xxhash64("name", F.lit(12)), F.lit(FOLDS)).cast("int").alias("fold"))


def _gram_bucket(salt: int, value: Column, n: int):
    return lambda i: F.pmod(F.xxhash64(F.lit(salt), F.substring(value, i, F.lit(n))), F.lit(BUCKETS)).cast("int")


def buckets(host: Column, path: Column) -> Column:
    """Buckets of the n-grams of host and path, with their ends marked."""
    found = []
    for salt, value in ((1, host), (2, path)):
        marked = F.when(F.length(value) > 0, F.concat(F.lit("^"), value, F.lit("$"))).otherwise("")
        for n in GRAMS:
            last = F.length(marked) - (n - 1)
            at = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
            found.append(F.transform(at, _gram_bucket(salt, marked, n)))
    return F.concat(*found)


def train(labelled: DataFrame, sample: int = SAMPLE_URLS) -> tuple[np.ndarray, float]:
    """Weights and intercept from rows (url, buckets, verdict), of each verdict a bounded number."""
    counts = {r["verdict"]: r["n"] for r in labelled.groupBy("verdict").agg(F.count("*").alias("n")).collect()}  # two rows
    weights, intercept = np.zeros(BUCKETS), 0.0
    if len(counts) < 2:
        return weights, -1.0 if "block" in counts else 1.0
    share = F.lit(0)
    for verdict, n in sorted(counts.items()):
        share = F.when(F.col("verdict") == verdict, F.lit(min(1_000_000, 1_000_000 * sample // n + 1))).otherwise(share)
    rows = labelled.where(F.pmod(F.xxhash64("url", F.lit(17)), F.lit(1_000_000)) < share).select("url", "buckets", "verdict").collect()  # about 2 * sample rows
    rows.sort(key=lambda r: (r["url"], r["verdict"]))
    if not rows:
        return weights, 1.0
    size = np.array([len(r["buckets"]) for r in rows])
    own, flat = np.repeat(np.arange(len(rows)), size), np.array([b for r in rows for b in r["buckets"]], dtype=np.int64)
    gold = np.array([r["verdict"] == "allow" for r in rows], dtype=float)
    value = 1 / np.maximum(size, 1)[own]
    square, square_0 = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(ROUNDS):
        score = np.bincount(own, weights[flat] * value, minlength=len(rows)) + intercept
        wrong = (gold - 1 / (1 + np.exp(-score))) / len(rows)
        grad = np.bincount(flat, wrong[own] * value, minlength=BUCKETS) - DECAY * weights / len(rows)
        square += grad * grad
        square_0 += wrong.sum() ** 2
        weights += RATE * grad / np.sqrt(square)
        intercept += RATE * wrong.sum() / np.sqrt(square_0)
    return weights, float(intercept)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], labelled: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the model's probability of allow) of every row of `pages`.
    labelled: (url, verdict) with verdict allow or block; other rows are left out."""

    def split(rows: DataFrame, *columns: str) -> DataFrame:
        host, path = parts(F.col("url"))
        return rows.select(*columns, "url", host.alias("host"), path.alias("path")).withColumn("buckets", buckets(F.col("host"), F.col("path")))

    weights, intercept = train(split(labelled.where("verdict in ('allow', 'block')"), "verdict"))
    name, decided = rule_of(F.col("host"), F.col("path"), rules)
    table = F.from_json(F.lit(json.dumps([round(float(w), 9) for w in weights])), "array<double>")
    total = F.aggregate("buckets", F.lit(0.0), lambda held, b: held + F.get(table, b))
    score = 1 / (1 + F.exp(-(total / F.greatest(F.size("buckets"), F.lit(1)) + F.lit(intercept))))
    judged = split(pages, "page_id").select("page_id", "host", "path", name.alias("rule"), decided.alias("decided"), score.alias("score"))
    verdict = F.coalesce("decided", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
