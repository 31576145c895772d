"""Statistics against plain Python, learned lists against planted rules and their own conditions."""

import random
import re

import numpy as np

from tidemark.llm.quality_rules import COUNTS, FEATURES, DecisionList, cover, judge_quality, learn, statistics
from tidemark.llm.queries import op11_quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    repeated = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated))


def some_text(rng):
    words = [rng.choice(["a", "bé", "c#", "日本", "x%", "dog", "é", "1"]) for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(3)):
        if len(words) > 10:
            i, j = rng.randrange(len(words) - 9), rng.randrange(len(words))
            words[j:j] = words[i : i + rng.randrange(6, 14)]
    return "".join(w + rng.choice([" ", "  ", "\t", "\n", " \n", "\x0b", "\xa0", "\r\n"]) for w in words)


def test_counts_equal_plain_python(spark):
    rng = random.Random(3)
    texts = dict(enumerate([None, "", " \n\t ", "a", "a\na\n\n \n \na \n", "w " * 500, " ".join(map(str, range(70_000))) + " 1 2 3 4 5 6 7 8 9"] + [some_text(rng) for _ in range(400)]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    rows = {r.doc_id: r for r in statistics(docs, ["doc_id"]).collect()}
    for i, text in texts.items():
        want = brute(text)
        assert tuple(rows[i][c] for c in COUNTS) == want, text
        assert rows[i].base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def tables(spark, n=600, seed=5):
    """Texts of which those with many symbols, and those with long words, are labelled bad."""
    rng = random.Random(seed)
    docs, labels, bad = [], [], {}
    for i in range(n):
        kind = i % 6
        word = {0: lambda: "#".join(rng.choices("abcdefgh", k=rng.randrange(2, 4))), 1: lambda: "".join(rng.choices("abcdefgh", k=14))}.get(kind, lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))))
        docs.append((i, " ".join(word() for _ in range(rng.randrange(25, 60))), "k"))
        bad[i] = kind < 2
        if i % 2 == i // 6 % 2:
            labels.append((i, int(kind >= 2), 0))
    return spark.createDataFrame(docs, "doc_id long, text string, kept string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), bad


def test_learned_list_finds_what_it_was_not_shown(spark):
    docs, labels, bad = tables(spark)
    rules = learn(docs, labels)
    assert len(rules.rules) >= 2 and rules.default
    rows = judge_quality(docs, rules, ["doc_id", "kept"], prefix="_").collect()
    assert {r.kept for r in rows} == {"k"}
    wrong = [r.doc_id for r in rows if r._kept == bad[r.doc_id]]
    assert len(wrong) <= 6, (rules.as_text(), len(wrong))
    # The expression says what the conditions say, in their order.
    for r in rows:
        first = next((k for k, rule in enumerate(rules.rules, 1) if all((r["_" + f] >= t) == up for f, up, t in rule)), None)
        assert r._rule == first and r._kept == (not r._base_failed and first is None)


def test_covering_prefers_nothing_to_a_wrong_rule():
    rng = np.random.default_rng(1)
    x, bad = rng.random((3000, len(FEATURES))), rng.random(3000) < 0.2
    prune = np.arange(3000) % 3 == 0
    assert cover(x, bad, prune) == []
    bad = (x[:, 1] > 0.7) & (x[:, 4] < 0.4)
    rules = cover(x, bad, prune)
    held = np.zeros(3000, dtype=bool)
    for rule in rules:
        held |= np.logical_and.reduce([(x[:, j] >= t) == up for j, up, t in rule])
    assert (held == bad).mean() > 0.99


def test_labels_of_one_kind_none_repeated_and_null(spark):
    docs, labels, _ = tables(spark, 60)
    assert learn(docs, labels.limit(0)) == DecisionList()
    assert learn(docs.limit(0), labels) == DecisionList()
    assert learn(docs, labels.where("quality = 1")) == DecisionList([], True)
    assert learn(docs, labels.where("quality = 0")) == DecisionList([], False)
    one = judge_quality(docs, DecisionList([], False), ["doc_id"])
    assert not one.where("kept").count() and one.count() == 60
    more = spark.createDataFrame([(None, 0, 0), (4, None, 0), (4, 1, 0), (4, 0, 1), (4, 0, 0)], labels.schema)
    repeated = docs.unionByName(docs).unionByName(docs.selectExpr("cast(null as long) as doc_id", "text", "kept"))
    assert learn(repeated, labels.unionByName(labels).unionByName(more)).rules == learn(docs, labels.where("doc_id <> 4").unionByName(more)).rules


def test_ties_at_a_threshold_and_the_order_of_rules(spark):
    docs = spark.createDataFrame([(1, "ab cd " * 3), (2, "ab cd ef gh " * 6)], "doc_id long, text string")
    rules = DecisionList([[("n_words", True, 24.0), ("mean_word", False, 2.0)], [("n_words", True, 24.0)], [("n_words", False, 24.0)]])
    assert [r.rule for r in judge_quality(docs, rules, ["doc_id"]).orderBy("doc_id").collect()] == [3, 2]
    assert rules.as_text()[0] == "n_words >= 24 and mean_word < 2: drop"


def test_query(spark, tmp_path):
    docs, labels, bad = tables(spark)
    docs.unionByName(spark.createDataFrame([(None, "x y", ""), (9999, None, "")], docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = op11_quality_rules(spark, str(tmp_path)).collect()
    assert len(rows) == 602
    texts = {r.doc_id: r.text for r in docs.collect()} | {None: "x y", 9999: None}
    for r in rows:
        assert tuple(r[c] for c in COUNTS) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert sum(r.kept == bad.get(r.doc_id, True) for r in rows) <= 6
    plan = op11_quality_rules(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
