"""One query per operator over its whole table, and the SQL that a query must equal where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import language_id, quality_rules, secrets, whitening
from tidemark.llm.decontamination import decontaminate
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.license_scan import scan_licenses
from tidemark.llm.order_minhash import let, order_minhash
from tidemark.llm.packing import pack
from tidemark.llm.periodic_runs import periodic_runs
from tidemark.llm.substring_dedup import dedup_substrings
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.url_filter import judge, seed_urls
from tidemark.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def held_out() -> Column:
    """Never of a document without an id: it is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~held_out()))
    found = language_id.label(docs, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_labelled", "n_switches")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_licenses, names (distinct, sorted, comma-joined), spans (license:start:end) and the least coverage."""
    found = scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])
    spans = F.transform("licenses", lambda s: F.concat_ws(":", s["license"], s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("names"),
        F.array_join(spans, ",").alias("spans"), F.array_min("licenses.coverage").alias("least_coverage"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=0, capacity=2048)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}/token_files"
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file(), end_id=2)
    return read_token_files(spark, path)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs), ["doc_id"])

    def of(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secret_spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest("secret_spans").alias("spans"))


#: The rules of the query, as verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), URL_RULES, seed_urls(spark))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), window=50)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    found = quality_rules.judge_quality(docs, rules, ["doc_id"])
    return found.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "rule")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    rows = whitening.whiten(vectors, model, ["vec_id"])
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(whitening.explained(model), F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, the end of every tenth text made periodic: with h the crc32 of doc_id, words from g % n on repeat
    the first 1 + (n - g % n) div (3 + g % 8) of them, where h % 10 = 0 and g = h div 10."""
    white = " \t\n\x0b\f\r"
    g = F.expr("crc32(cast(doc_id as string)) div 10")

    def again(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        place = F.sequence(F.lit(0), F.size(words) - 1)
        return F.array_join(F.transform(place, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    periodic = F.when(F.length(F.btrim("text", F.lit(white))) > 0, let(F.split(F.btrim("text", F.lit(white)), "[\x20\x09-\x0d]+"), again))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return docs.select("doc_id", F.when(chosen, periodic).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")), ["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    # The greatest length, then the smallest start, then the smallest period: the greatest of negated numbers.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_order_minhash": op4_order_minhash,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_token_files": op6_token_files,
    "op7_secret_scan": op7_secret_scan,
    "op8_url_filter": op8_url_filter,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_quality_rules": op11_quality_rules,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op3_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + 2), ' ')) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
reach AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.seen)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, d.component_id
FROM (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY 1) d LEFT JOIN n USING (doc_id)
""",
    "op9_substring_dedup": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
hit AS (SELECT g.doc_id, g.i FROM g JOIN (SELECT gram, min(doc_id) AS low FROM g GROUP BY 1) m USING (gram) WHERE g.doc_id > m.low),
covered AS (SELECT doc_id, list(DISTINCT k) AS k FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM hit) GROUP BY 1),
words AS (SELECT d.doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d JOIN covered USING (doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(k) AS k FROM covered),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.k) AS kept FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.k = words.k
  WHERE gone.k IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(c.k), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN c.doc_id IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept.kept, '') END) AS kept_sha256
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN kept ON kept.doc_id = d.doc_id
""",
    "op10_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + 12), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT g.doc_id, g.i, g.n, p.item_id FROM g JOIN p ON g.gram = p.gram AND g.n = p.n),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    # crc32 is written out as a fold over the bits of doc_id's digits: a number xors a byte in, -1 shifts by one bit.
    "op13_periodic_runs": """
WITH c AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(CAST(string_split(CAST(doc_id AS VARCHAR), '') AS VARCHAR[]),
      lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x // 2, 3988292384 * (x % 2)) END)) AS h
  FROM documents),
a AS (SELECT doc_id, w, h, h // 10 AS g, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM c),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM p),
t AS MATERIALIZED (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM d WHERE n >= 6),
e AS (SELECT x.doc_id, y.i - x.i AS p, x.i FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM e) GROUP BY doc_id, p, island),
r AS MATERIALIZED (SELECT doc_id, start, length, min(p) AS period FROM s WHERE length >= 6 AND length >= 4 * p GROUP BY ALL),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (
  SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS text FROM t SEMI JOIN r ON t.doc_id = r.doc_id
  ANTI JOIN dropped ON t.doc_id = dropped.doc_id AND t.i = dropped.i GROUP BY 1),
best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
every AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
  CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
  sha256(CASE WHEN kept.doc_id IS NULL THEN array_to_string(d.w, ' ') ELSE kept.text END) AS collapsed_sha256
FROM d LEFT JOIN every USING (doc_id) LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
""",
}
