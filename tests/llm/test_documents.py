"""Operators on documents against brute force, and their results on unusual input."""

import random
import re
from hashlib import sha256
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidemark.llm.decontamination import decontaminate
from tidemark.llm import jaccard_join
from tidemark.llm.jaccard_join import histogram, jaccard_components, overlap_bound
from tidemark.llm.license_scan import TEMPLATES, scan_licenses
from tidemark.llm.substring_dedup import dedup_substrings, levels

SCHEMA = "doc_id long, text string, score double, n int"


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 0.5, 1) for i, t in rows], SCHEMA)


def prose(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def corpus(seed):
    rnd = random.Random(seed)
    texts = [prose(rnd, rnd.randrange(1, 120)) for _ in range(25)]
    for _ in range(25):
        own = rnd.choice(texts).split()
        for _ in range(rnd.randrange(0, 3)):
            own[rnd.randrange(len(own))] = "edited"
        texts.append(("\t" if rnd.random() < 0.3 else " ").join(own))
    passage = prose(rnd, 30)
    texts += [f"{prose(rnd, 5)} {passage} {prose(rnd, 9)}" for _ in range(4)] + ["", " \n ", None, "ÀÉ x", texts[0], texts[0].upper()]
    rnd.shuffle(texts)
    return list(enumerate(texts)) + [(3, texts[3])]


def shingles(text, n):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 60)])
def test_components_match_all_pairs(spark, n, percent):
    rows = corpus(n)
    sets = [(i, shingles(t, n)) for i, t in rows]
    low = {k: i for k, (i, _) in enumerate(sets)}
    changed = True
    linked = [(a, b) for a, b in combinations(range(len(sets)), 2)
              if sets[a][1] and 100 * len(sets[a][1] & sets[b][1]) >= percent * len(sets[a][1] | sets[b][1])]
    while changed:
        changed = False
        for a, b in linked:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    want = sorted((sets[k][0], len(sets[k][1]), low[k]) for k in low)
    got = sorted(tuple(r) for r in jaccard_components(table(spark, rows), n, percent).collect())
    assert got == want


def brute_components(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    low = list(range(len(sets)))

    def find(k):
        while low[k] != k:
            k = low[k]
        return k

    for a, b in combinations(range(len(sets)), 2):
        if sets[a][1] and 100 * len(sets[a][1] & sets[b][1]) >= percent * len(sets[a][1] | sets[b][1]):
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    ids = {}
    for k in range(len(sets)):
        ids[find(k)] = min(ids.get(find(k), 1 << 60), sets[k][0])
    return sorted((sets[k][0], len(sets[k][1]), ids[find(k)]) for k in range(len(sets)))


@pytest.mark.parametrize("percent,hot", [(90, 1), (80, 0), (50, 1)])
def test_hot_tokens_told_apart_by_the_next_ones_lose_no_link(spark, monkeypatch, percent, hot):
    monkeypatch.setattr(jaccard_join, "HOT_COMPONENTS", hot)
    rnd = random.Random(percent)
    texts = [" ".join(rnd.choices("abcdefg", k=rnd.randrange(1, 40))) for _ in range(220)]
    for _ in range(80):
        own = rnd.choice(texts).split()
        own.insert(rnd.randrange(len(own) + 1), rnd.choice("abcdefg"))
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    assert sorted(tuple(r) for r in jaccard_components(table(spark, rows), 3, percent).collect()) == brute_components(rows, 3, percent)


def test_sizes_that_cannot_link_make_no_candidates(spark, monkeypatch):
    """20,000 texts of seven words from seven, and one token that all of 3,000 longer texts hold among their first."""
    held = {}

    def counted(df, name, real=jaccard_join.cut):
        held[name] = real(df, name)
        return held[name]

    monkeypatch.setattr(jaccard_join, "cut", counted)
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices("abcdefg", k=7))) for i in range(20_000)]
    found = jaccard_components(table(spark, rows), 3, 90)
    assert found.count() == 20_000 and held["blocks"].count() == 0 and held["asked"].count() == 0
    rows = [(i, " ".join(rnd.choices("abcdefg", k=21))) for i in range(3000)]
    jaccard_components(table(spark, rows), 3, 90).count()
    assert held["asked"].count() < 10 * len(rows)


def test_components_of_an_empty_table(spark):
    assert jaccard_components(table(spark, []), 3, 90).count() == 0


def test_histograms_never_bound_too_low():
    import numpy as np

    rng = np.random.default_rng(1)
    for size in (1, 7, 300, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 63, size * 2, dtype=np.uint64)]))
        assert overlap_bound(histogram(a), histogram(b)) >= len(np.intersect1d(a, b))
    crowded = np.arange(1000, dtype=np.uint64)
    assert overlap_bound(histogram(crowded), histogram(crowded)) >= 1000


@pytest.mark.parametrize("window,first", [(6, 2), (5, 3), (8, 8)])
def test_substrings_match_all_windows(spark, window, first):
    rows = corpus(window)
    held = {}
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            held[key] = min(held.get(key, i), i)
    want = []
    for i, t in rows:
        w = (t or "").split()
        gone = {j for k in range(len(w) - window + 1) if held[tuple(w[k : k + window])] < i for j in range(k, k + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((i, len(w), len(gone), sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in dedup_substrings(table(spark, rows), window, first).collect()]
    assert sorted(got) == sorted(want)


def test_substring_levels_double():
    assert levels(50, 13) == [13, 26, 50]
    assert levels(50, 25) == [25, 50]
    assert levels(4, 13) == [4]


def test_substrings_without_doc_ids_or_rows(spark):
    text = " ".join(str(k) for k in range(60))
    got = {r.doc_id: r.n_removed for r in dedup_substrings(table(spark, [(None, text), (7, text), (9, text + " end")])).collect()}
    assert got == {None: 0, 7: 0, 9: 60}
    assert dedup_substrings(table(spark, [])).count() == 0


def words10(text):
    out, word = [], ""
    for c in text or "":
        if c > "\x7f" or c.isascii() and c.isalnum():
            word += c.lower() if c.isascii() else c
        elif word:
            out.append(word)
            word = ""
    return out + [word] if word else out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 40])
def test_decontamination_matches_all_windows(spark, shard_bytes):
    rnd = random.Random(4)
    items = [(k, prose(rnd, n, 50)) for k, n in enumerate((20, 13, 12, 3, 1))] + [(9, "Ünïcode—x"), (9, None), (10, "--")]
    rows = [(i, t) for i, t in corpus(3)]
    for k, (_, t) in enumerate(items[:6]):
        rows.append((100 + k, f"{prose(rnd, 7)}: {t.upper() if k != 5 else t}; {prose(rnd, 5)}"))
    rows.append((120, " ".join(items[0][1].split()[4:18])))
    found = {str(i): {tuple(words10(t)[k : k + 13]) for k in range(max(1, len(words10(t)) - 12))} for i, t in items if words10(t)}
    want = []
    for i, t in rows:
        w = words10(t)
        hit, own = set(), set()
        for name, windows in found.items():
            for win in windows:
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k : k + len(win)]) == win:
                        hit |= set(range(k, k + len(win)))
                        own.add(name)
        want.append((i, len(w), len(hit), len(own), sorted(own), len(hit) > 0 and 20 * len(hit) >= len(w)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in decontaminate(table(spark, rows), benchmark, ["doc_id"], shard_bytes=shard_bytes).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_decontamination_spans_and_empty_sides(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    text = f"Ça — {item.replace(' ', ', ').upper()}! fin"
    row = decontaminate(table(spark, [(1, text)]), benchmark, ["doc_id"], spans=True).first()
    assert [text[s.start : s.end] for s in row.spans] == [item.replace(" ", ", ").upper()]
    assert decontaminate(table(spark, []), benchmark, ["doc_id"]).count() == 0
    none = decontaminate(table(spark, [(1, text)]), benchmark.limit(0), ["doc_id"]).first()
    assert (none.n_hit, none.contaminated) == (0, False)


def test_license_notices_exact_edited_and_repeated(spark):
    mit, gpl = TEMPLATES["mit-text"], TEMPLATES["gpl-3.0"]
    words = mit.split()
    edited = " ".join(words[:20] + ["really"] + words[20:40] + words[41:])
    texts = [f"é {mit} end", f"Intro\n{edited}", f"{gpl}. {gpl.upper()}", "nothing licensed here", "", None, mit.split(", free")[0]]
    rows = scan_licenses(table(spark, list(enumerate(texts))), ["doc_id"]).orderBy("doc_id").collect()
    assert texts[0][rows[0].licenses[0].start : rows[0].licenses[0].end] == mit[:-1]
    assert (rows[0].licenses[0].license, rows[0].licenses[0].coverage) == ("mit-text", 1.0)
    assert rows[1].licenses[0].license == "mit-text" and 0.9 < rows[1].licenses[0].coverage < 1
    assert [s.license for s in rows[2].licenses] == ["gpl-3.0", "gpl-3.0"]
    assert texts[2][rows[2].licenses[1].start : rows[2].licenses[1].end] == gpl.upper()
    assert all(r.licenses == [] for r in rows[3:])
    assert scan_licenses(table(spark, []), ["doc_id"]).count() == 0


def occurrences(text, notice):
    """Places of every copy of a notice, by search."""
    return [(m.start(), m.end()) for m in re.finditer(re.escape(notice), text)]


def test_license_notices_repeated_close_together(spark):
    rnd = random.Random(11)
    short = ["mit", "cc-by-4.0", "cc-by-nc-4.0", "cc-by-sa-4.0", "apache-2.0", "gpl-3.0"]
    cases = [(n, gap.join([TEMPLATES[n]] * k)) for n in short for gap in (" ", "\n", " word ", " two words ") for k in (2, 5, 40)]
    # Parts of the notice around it, which hit too, on other diagonals.
    for n in short:
        own = TEMPLATES[n].split()
        for _ in range(6):
            parts = [" ".join(own[: rnd.randrange(2, 4)]) + " " + prose(rnd, rnd.randrange(3, 9)) for _ in range(rnd.randrange(1, 6))]
            at = rnd.randrange(len(parts) + 1)
            cases.append((n, " ".join([*parts[:at], TEMPLATES[n], *parts[at:]])))
    rows = scan_licenses(table(spark, list(enumerate(t for _, t in cases))), ["doc_id"]).collect()
    assert len(rows) == len(cases)
    for r in rows:
        n, text = cases[r.doc_id]
        assert [(s.license, s.start, s.end, s.coverage) for s in r.licenses] == [(n, a, b, 1.0) for a, b in occurrences(text, TEMPLATES[n])], text


def test_license_notices_side_by_side_are_told_apart(spark):
    mixed = [TEMPLATES[n] for n in ("mit", "apache-2.0", "cc-by-4.0", "mit", "cc-by-sa-4.0", "apache-2.0")]
    texts = [" ".join(mixed), "\n".join([TEMPLATES["mit-text"]] * 3)]
    rows = scan_licenses(table(spark, list(enumerate(texts))), ["doc_id"]).orderBy("doc_id").collect()
    assert [texts[0][s.start : s.end] for s in rows[0].licenses] == mixed
    assert [s.license for s in rows[1].licenses] == ["mit-text"] * 3


def test_short_license_notices_with_one_word_changed(spark):
    cases = []
    for n in ("mit", "cc-by-4.0", "apache-2.0", "gpl-3.0"):
        own = re.findall("[A-Za-z0-9]+", TEMPLATES[n])
        cases += [(n, " ".join([*own[:k], "changed", *own[k + 1 :]]), len(own)) for k in range(1, len(own) - 1) if len(own) > 5 or k != 2]
    edited = TEMPLATES["apache-2.0"].replace("Version", "Edition")
    cases.append(("apache-2.0", edited, 8))
    rows = scan_licenses(table(spark, [(k, f"one {t} two") for k, (_, t, _) in enumerate(cases)]), ["doc_id"]).collect()
    for r in rows:
        n, text, size = cases[r.doc_id]
        assert [(s.start, s.end, s.coverage) for s in r.licenses if s.license == n] == [(4, 4 + len(text), (size - 1) / size)], text
    three = f"{TEMPLATES['apache-2.0']} {edited} {TEMPLATES['apache-2.0']}"
    row = scan_licenses(table(spark, [(1, three)]), ["doc_id"]).first()
    assert [three[s.start : s.end] for s in row.licenses] == [TEMPLATES["apache-2.0"], edited, TEMPLATES["apache-2.0"]]


def test_bsd_licenses_of_two_and_three_clauses(spark):
    texts = [f"x {TEMPLATES[n]} y" for n in ("bsd-2-clause", "bsd-3-clause")]
    rows = scan_licenses(table(spark, list(enumerate(texts))), ["doc_id"]).orderBy("doc_id").collect()
    assert [[(s.license, s.coverage) for s in r.licenses] for r in rows] == [[("bsd-2-clause", 1.0)], [("bsd-3-clause", 1.0)]]


def test_rows_keep_their_own_columns(spark):
    found = scan_licenses(table(spark, [(1, "x")]), ["doc_id", "score", "n", "text"]).first()
    assert (found.doc_id, found.score, found.n, found.text) == (1, 0.5, 1, "x")


def test_long_texts_and_hot_groups(spark):
    long = " ".join(str(k) for k in range(30_000))
    rows = [(0, long), (1, long + " tail")] + [(k, "one line that many share and more") for k in range(2, 300)]
    got = {r.doc_id: r.component_id for r in jaccard_components(table(spark, rows), 3, 90).collect()}
    assert got[1] == 0 and all(got[k] == 2 for k in range(2, 300))
    gone = {r.doc_id: r.n_removed for r in dedup_substrings(table(spark, rows)).collect()}
    assert gone[1] == 30_000 and gone[0] == 0
    assert table(spark, rows).select(F.max("doc_id")).first()[0] == 299


def test_rows_without_an_id_link_others(spark):
    words = [f"v{k}" for k in range(60)]
    a, bridge, b = (" ".join(words[: 50 - 3 * k]) for k in range(3))
    rows = [(1, a), (None, bridge), (None, bridge), (2, b), (3, "on its own here now"), (None, "without an id and alone")]
    found = sorted((r.component_id is None, r.component_id or 0, r.doc_id or 0) for r in jaccard_components(table(spark, rows), n=3, percent=93).collect())
    # 48 and 45 shingles, 45 and 42: 93 percent; 48 and 42: less.
    assert found == [(False, 1, 0), (False, 1, 0), (False, 1, 1), (False, 1, 2), (False, 3, 3), (True, 0, 0)]
