"""How often a delivery of CSV files is gone through."""

from tidemark.operators.headers import header_rules
from tidemark.plans.load import parse_csv
from tidemark.sources.lines import lines_of

TEXT = '''date,"campaign_id",platform,spend
2030-01-01,"a
b",x,1
2030-01-02,c,"y
z",2
'''


def test_records_over_lines_are_put_together_once(spark):
    files = spark.createDataFrame([("f", "t0", "ad_spend"), ("h", "t0", "ad_spend")], "file string, tenant_id string, source string")
    configured = files.select("tenant_id", "source").distinct()
    none = spark.createDataFrame([], "tenant_id string, source string, alias string, canonical string")
    texts = spark.createDataFrame([("f", TEXT), ("h", TEXT.replace("platform,", '"plat\nform",'))], "file string, text string")
    parsed = parse_csv(files, lines_of(texts, "file", "text"), header_rules(spark, none, configured))
    assert {r.file: r.reasons is None for r in parsed.verdicts.collect()} == {"f": True, "h": False}
    assert sorted((r.file, r.line_no, r.payload["campaign_id"], r.payload["platform"]) for r in parsed.records.collect()) == [
        ("f", 2, "a\nb", "x"), ("f", 4, "c", "y\nz")]
    plan = parsed.records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("+- Window [") == 2  # one segmented scan; before, a second one for the headers
