"""Many copies of one text, each with edits of its own: the Jaccard join's work on them."""

import random

from tidemark.llm import jaccard_join


def test_edited_copies_of_one_text_are_not_held_against_each_other(spark, monkeypatch):
    rnd = random.Random(5)
    text = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(text))]
    for i in range(1, 240):
        own = list(text)
        for at in rnd.sample(range(150), rnd.randint(1, 3)):  # a word is in three shingles: 142 to 148 of 148 are left
            own[at] = f"e{i}x{at}"
        rows.append((i, " ".join(own)))
    far = list(text)
    for at in range(5, 150, 15):  # thirty of 148 shingles: too far from all others
        far[at] = f"far{at}"
    rows.append((1000, " ".join(far)))
    counts, cut = {}, jaccard_join.cut

    def counted(df, name):
        found = cut(df, name)
        counts[name] = counts.get(name, 0) + found.count()
        return found

    monkeypatch.setattr(jaccard_join, "cut", counted)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    sets = {i: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} for i, w in ((i, t.split()) for i, t in rows)}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {i: find(i) for i in sets}
    print(counts)
    assert counts["asked"] <= len(rows) and counts.get("finer", 0) <= len(rows)
