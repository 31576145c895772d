"""Newest lines of a key."""

import random

from catalog import deliveries as d, queries
from tidemark.operators import staging
from tidemark.session import cut, cut_all


def raw_spend(spark, lines):
    rows = [("t1", "ad_spend", 2200 + batch, line, dict(date="1998-04-26", campaign_id=campaign, platform=platform, spend=spend))
            for batch, line, campaign, platform, spend in lines]
    return spark.createDataFrame(rows, "tenant_id string, source string, batch_file_id bigint, line_no bigint, payload map<string,string>").coalesce(1)


def test_lines_that_tie_are_staged_alike_in_whatever_order_they_are_read(spark):
    # N and R are both mapped to google for t1; batch 5 onwards names spend cost_usd.
    lines = [(4, 7, "c-1", "N", "941.3154"), (4, 7, "c-1", "R", "861.3454"), (3, 9, "c-1", "R", "1"), (4, 6, "c-2", "R", "2"), (4, 7, "c-2", "N", "3")]
    found = []
    for order in (lines, lines[::-1]):
        staged = staging.ad_spend(raw_spend(spark, order), d.ledger(spark), d.value_map(spark), d.WIDTH)
        found.append(sorted((r.campaign_id, r.platform, str(r.spend)[:8], r.batch_file_id, r.batch_no, r.line_no) for r in staged.collect()))
    assert found[0] == found[1] == [("c-1", "google", "861.3454", 2204, 4, 7), ("c-2", "google", "3.000000", 2204, 4, 7)]


def test_lines_of_several_runs_are_the_newest_of_each_run(spark):
    rnd = random.Random(4)
    lines = [(f"t{rnd.randrange(2)}", f"k{rnd.randrange(30)}", rnd.randrange(1, 4), rnd.randrange(6), rnd.choice(["x", "y", None]), rnd.random() < 0.6, rnd.random() < 0.6)
             for _ in range(400)]
    df = spark.createDataFrame(lines, "tenant_id string, key string, batch_no int, line_no bigint, value string, first boolean, second boolean").repartition(3)
    both = staging.latest_of_runs(df, ["key"], ["first", "second"])
    columns = ["tenant_id", "key", "batch_no", "line_no", "value"]
    for run in ("first", "second"):
        want = staging.latest(df.filter(run).select(*columns), ["key"])
        assert sorted(map(repr, both.filter(run).select(*columns).collect())) == sorted(map(repr, want.collect()))
    assert both.filter("NOT first AND NOT second").isEmpty()


def test_lines_are_read_once_for_both_runs(spark, monkeypatch):
    read = []
    monkeypatch.setattr(queries, "cut_all", lambda frames: read.extend(frames.values()) or cut_all(frames))
    monkeypatch.setattr(queries, "cut", lambda df, name: read.append(df) or cut(df, name), raising=False)
    staged = queries._staged_for_marts(spark, "/root/testdata/sf0.001", {"first": queries._first_ledger(spark), "second": queries._second_ledger(spark)})
    assert {r.is_orphan for r in staged["first"]["refunds"].select("is_orphan").distinct().collect()} == {True, False}
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in read] + [
        df._jdf.queryExecution().optimizedPlan().toString() for run in staged.values() for df in run.values()]
    assert sum(plan.count("l_extendedprice#") > 0 for plan in plans) == 2  # ad spend and refunds, once each
