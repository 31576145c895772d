"""Operators against brute force on small inputs, and the skewed join under a hot key."""

import itertools
import random

from pyspark.sql import functions as F

from tidemark.functions import casts, names
from tidemark.operators.skew import skewed_left_join
from tidemark.sources import csv_files
from tidemark.sources.lines import number_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_near_misses_equal_comparing_all_pairs(spark):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abA_") for _ in range(rng.randint(0, 7))) for _ in range(120)})
    left, right = words[::2], words[1::2] + ["LONGNAME"]
    left.append("longname")
    got = names.near_misses(
        spark.createDataFrame([("d", w) for w in left], "folder string, name string"),
        spark.createDataFrame([("d", w) for w in right], "folder string, candidate string"), ["folder"])
    want = {
        (a, b, distance(a, b)) for a, b in itertools.product(left, right)
        if a != b and (distance(a, b) <= 2 or a.lower() == b.lower())}
    assert {(r.name, r.candidate, r.distance) for r in got.collect()} == want and want


def test_skewed_join_splits_a_hot_key_and_keeps_every_row(spark):
    settings = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
        left = spark.range(0, 60000, 1, 12).select(F.lit("t").alias("tenant_id"), key.alias("order_id"), "id")
        right = spark.range(0, 60000, 2).select(F.lit("t").alias("tenant_id"), F.col("id").cast("string").alias("order_id"))
        right = right.union(spark.createDataFrame([("t", "hot")])).distinct().withColumn("known", F.lit(True))
        joined = skewed_left_join(left, right, ["tenant_id", "order_id"])
        rows = joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 60000
    assert all((r.known is True) == (r.id % 3 == 0 or (r.id % 3 == 2 and r.id % 2 == 0)) for r in rows)


def test_impossible_days_bound_windows_as_text_does(spark):
    texts = ["2026-02-30", "2026-13-45", "2026-00-10", "2026-02-00", "2026-02-28"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (str(r.a), str(r.b)) for r in df.select(
        "t", casts.first_real_day(F.col("t")).alias("a"), casts.last_real_day(F.col("t")).alias("b")).collect()}
    assert got == {
        "2026-02-30": ("2026-03-01", "2026-02-28"), "2026-13-45": ("2027-01-01", "2026-12-31"),
        "2026-00-10": ("2026-01-01", "2025-12-31"), "2026-02-00": ("2026-02-01", "2026-01-31"),
        "2026-02-28": ("2026-02-28", "2026-02-28")}


def test_batch_ranges_and_gaps(spark):
    df = spark.createDataFrame([("a", b) for b in (1, 3, 4, 5, 5)] + [("b", 4)], "k string, batch_no int")
    assert {r.k: r.batches for r in names.batch_ranges(df, ["k"]).collect()} == {"a": "batches 1, 3-5", "b": "batch 4"}
    gaps = names.batch_gaps(df, ["k"])
    assert sorted((r.k, r.first, r.last) for r in gaps.selectExpr("k", "first", "last").collect()) == [("a", 2, 2), ("b", 1, 3)]
    assert sorted((r.k, r.missing) for r in names.skipped_numbers(gaps, ["k"]).collect()) == [("a", 2), ("b", 1), ("b", 2), ("b", 3)]
    assert sorted((r.k, r.n, r.batches) for r in names.gap_texts(gaps, ["k"]).collect()) == [("a", 1, "2"), ("b", 3, "1, 2, 3")]


def test_gaps_of_any_length(spark):
    """Numbers up to the largest int, gaps of one chunk and one more, repeated and unordered numbers, and no rows at all."""
    top, chunk = 2**31 - 1, names.CHUNK
    rows = [("far", 1), ("far", top), ("chunk", 2 * chunk + 3), ("chunk", chunk + 1), ("chunk", chunk + 1), ("edge", 102), ("edge", 1)]
    gaps = names.batch_gaps(spark.createDataFrame(rows, "k string, batch_no int"), ["k"])
    assert {r.k: (r.n, r.batches) for r in names.gap_texts(gaps, ["k"]).collect()} == {
        "far": (top - 2, f"2-{top - 1}"), "chunk": (2 * chunk + 1, f"1-{chunk}, {chunk + 2}-{2 * chunk + 2}"),
        "edge": (100, ", ".join(map(str, range(2, 102))))}
    got = [r.missing for r in names.skipped_numbers(gaps.filter("k = 'chunk'"), ["k"]).collect()]
    assert sorted(got) == [n for n in range(1, 2 * chunk + 3) if n != chunk + 1]
    assert names.skipped_numbers(gaps.filter("k = 'far'"), ["k"]).filter("missing > 3").limit(2).count() == 2
    assert names.gap_texts(gaps.limit(0), ["k"]).isEmpty()


def test_records_over_blocks_start_where_a_plain_walk_says(spark):
    """Records across any number of blocks: whole, in files that never close a quote, and in files side by side."""
    rng = random.Random(3)
    files = {
        f"f{f}": ["".join(rng.choice(['"', '"', "x", ","]) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 60))]
        for f in range(12)}
    files["swallowed"] = ['a,"'] + ["b,c"] * 500
    # Blocks of one to nine lines, handed over in any order.
    rows = []
    for name, texts in files.items():
        block = 0
        for pos, text in enumerate(texts):
            block = pos if rng.random() < 0.2 else block
            rows.append((name, block * 100, pos + 7, text, -1))
    rng.shuffle(rows)
    lines = spark.createDataFrame(rows, "file string, block bigint, pos bigint, text string, size bigint").repartition(5)
    checked = csv_files.check_lines(number_lines(lines).lines)
    got = {(r.file, r.record): r.end_line for r in csv_files.record_shapes(checked).collect()}
    texts = {(r.file, r.line_no): r.text for r in csv_files.record_texts(checked).collect()}
    want, want_texts = {}, {}
    for name, lines_ in files.items():
        last = max((n for n, t in enumerate(lines_, 1) if t), default=0)
        start, inside = 1, False
        for n, text in enumerate(lines_[:last], 1):
            start = start if inside else n
            inside ^= text.count('"') % 2 == 1
            want[name, start] = n
            want_texts.setdefault((name, start), []).append(text)
    assert got == want and texts == {k: "\n".join(v) for k, v in want_texts.items()}
    assert got["swallowed", 1] == 501
