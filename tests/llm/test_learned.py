"""Random fields against enumeration, and learned operators on held-out and unusual input."""

import random
import re
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import language_id, secrets
from tidemark.llm.crf import Model, marginals, viterbi
from tidemark.llm.texts import slices

EN = "the of and to in that with for shall between which water mother house thinking thorough weather".split()
DE = "der die und das nicht mit für zwischen welche wasser mutter haus denken gründlich wetter straße".split()


def test_marginals_and_best_paths_match_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 4, 4, 5, 8])
    emission, move, start = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    gamma, expected = marginals(emission, first, move, start, pairs=True)
    best = viterbi(emission, first, move, start)
    pairs = np.zeros((3, 3))
    for a, b in zip(first[:-1], first[1:]):
        total, held, top = 0.0, np.zeros((b - a, 3)), (-1e9, None)
        for path in product(range(3), repeat=b - a):
            s = sum(emission[a + t, k] for t, k in enumerate(path)) + sum(move[x, y] for x, y in zip(path, path[1:])) + (start[path[0]] if path else 0)
            total += np.exp(s)
            top = max(top, (s, path))
            for t, k in enumerate(path):
                held[t, k] += np.exp(s)
        if b == a:
            continue
        assert np.allclose(gamma[a:b], held / total)
        assert tuple(best[a:b]) == top[1]
        for path in product(range(3), repeat=b - a):
            s = sum(emission[a + t, k] for t, k in enumerate(path)) + sum(move[x, y] for x, y in zip(path, path[1:])) + start[path[0]]
            for x, y in zip(path, path[1:]):
                pairs[x, y] += np.exp(s) / total
    assert np.allclose(expected, pairs)


def test_fitting_learns_labels_and_transitions():
    rng = np.random.default_rng(3)
    gold = np.repeat(rng.integers(0, 2, 200), 10)
    seen = np.where(rng.random(len(gold)) < 0.8, gold, 1 - gold)
    first = np.arange(0, len(gold) + 1, 40)
    model = Model(2, 2)
    model.fit(np.arange(2), np.arange(3), seen, first, gold)
    gamma = marginals(model.emissions(np.arange(2), np.arange(3))[seen], first, model.transition, model.start)
    assert (gamma.argmax(axis=1) == gold).mean() > 0.9 > (seen == gold).mean()
    assert model.transition[0, 0] > model.transition[0, 1]


def sentences(words, rnd, n):
    return " ".join(rnd.choices(words, k=n))


@pytest.fixture(scope="module")
def languages(spark):
    rnd = random.Random(1)
    rows = [(k, sentences(EN if k % 2 else DE, rnd, 60), "en" if k % 2 else "de") for k in range(60)] + [(90, None, "en"), (91, "x", None)]
    return language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_languages_of_texts_and_words(spark, languages):
    rnd = random.Random(2)
    half = sentences(EN, rnd, 15) + ". " + sentences(DE, rnd, 15)
    texts = [sentences(EN, rnd, 30).upper(), sentences(DE, rnd, 30), half, "", None, "12 — !", "ß"]
    docs = spark.createDataFrame([(k, t, 0.0) for k, t in enumerate(texts)], "doc_id long, text string, score double")
    rows = language_id.label(docs, languages, ["doc_id"], spans=True).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:2]] == ["en", "de"] and min(r.score for r in rows[:2]) > 0.8
    assert [s.lang for s in rows[2].lang_spans] == ["en", "de"] and rows[2].n_switches == 1
    assert half[rows[2].lang_spans[1].start : rows[2].lang_spans[1].end] == half.split(". ")[1]
    assert [(r.lang_pred, r.score) for r in rows[3:6]] == [("und", 0.0)] * 3
    assert rows[6].lang_pred in ("de", "en") and 0 < rows[6].score <= 1


def test_languages_without_labels_or_rows(spark, languages):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    nothing = language_id.fit(empty)
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert language_id.label(docs, nothing, ["doc_id"]).first().lang_pred == "und"
    assert language_id.label(empty, languages, ["doc_id"]).count() == 0


def secret_corpus(rnd):
    rows = []
    for k in range(300):
        text = sentences(EN + DE, rnd, 60)
        value = "".join(rnd.choices("0123456789abcdef", k=rnd.choice((20, 32, 40))))
        if k % 3 == 0:
            words = text.split()
            words.insert(rnd.randrange(60), rnd.choice((f"password={value}", f'token = "{value}"', value, "AKIA" + value.upper()[:16])))
            text = " ".join(words)
        rows.append((k, text))
    return rows


def test_secrets_base_spans_match_plain_search(spark):
    odd = [
        "", None, "token: password = abcdefghijklmnop", "TOKEN=ſhort", "Paßword=abcdefghijklmnop api-key=abcdefghijkl apikey:'abcdefghijkl'", "AKIAAKIA" + "A" * 20,
        "x" + "0" * 15 + "g" + "1" * 16, "é secret = \"" + "Z9" * 6 + "\" é", "toKen=" + "a" * 40]
    rows = list(enumerate(odd)) + [(i + 100, t) for i, t in secret_corpus(random.Random(5))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kind string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secret_spans if s.kind != "crf"] for r in secrets.scan(docs, None, ["doc_id"]).collect()}
    keyed = re.compile(r'(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)', re.I | re.A)
    for i, t in rows:
        t = t or ""
        want = [(m.start(), 0, "assign", m.end()) for m in keyed.finditer(t) if len(m[2]) >= 12]
        want += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert found[i] == [(k, a, b) for a, _, k, b in sorted(want)], t


def test_the_field_adds_what_patterns_miss_and_leaves_prose(spark):
    rnd = random.Random(6)
    rows = secret_corpus(rnd)
    model = secrets.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    missed = "der the password=0123-4567-89ab-cdef-0123 and of token = \"9fA3c0D1e2B7a6f5\" water"
    broken = sentences(EN, rnd, 20) + " token (\"4f9b2c77d1e05a3\") " + sentences(EN, rnd, 20)
    plain = [sentences(EN + DE, rnd, 80) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate([missed, broken, *plain, None])), "doc_id long, text string")
    spans = {r.doc_id: r.secret_spans for r in secrets.scan(docs, model, ["doc_id"]).collect()}
    assert any(s.kind == "crf" for s in spans[1])
    assert all(spans[k] == [] for k in range(2, 33))
    clean = {r.doc_id: r.text for r in secrets.redact(docs, model).collect()}
    assert "9fA3c0D1e2B7a6f5" not in clean[0] and "4f9b2c77d1e05a3" not in clean[1]
    assert [clean[k + 2] for k in range(30)] == plain and clean[32] is None


def test_secrets_around_a_base_span_are_reported_and_redacted(spark, monkeypatch):
    # The field tags the whole token, of which the base pattern knows the hex digits in the middle only.
    token = "Zq7Xw9KxT" + "0123456789abcdef01" + "Qz8Lm2Tx"
    text = f"see {token} there"
    tags = [0, 1, 0]
    monkeypatch.setattr(secrets, "emissions", lambda model, feature: None)
    monkeypatch.setattr(secrets, "viterbi", lambda *_: np.array(tags))
    part = next(slices(pa.array([text])))
    at = text.index("0123")
    own = secrets._spans_of(part, Model(1 << secrets.BUCKET_BITS, 3))
    assert own == [[(4, at, "crf"), (at, at + 18, "hex"), (at + 18, 4 + len(token), "crf")]]
    assert secrets.redacted(part, Model(1 << secrets.BUCKET_BITS, 3)) == ["see [SECRET] there"]
    tags[:] = [0, 1]
    assert secrets._spans_of(next(slices(pa.array(["see 0123456789abcdef01."]))), Model(1 << secrets.BUCKET_BITS, 3)) == [[(4, 22, "hex")]]


def test_secrets_rarer_than_the_sample_are_learned_from(spark):
    rnd = random.Random(4)
    rows = [(k, " ".join(rnd.choices(["stone", "river", "water", "and"], k=20))) for k in range(3000)]
    rows += [(5000 + k, f"set password={''.join(rnd.choices('abcXYZ0189', k=20))} here") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert secrets.fit(docs.where("doc_id < 5000"), sample_docs=2) is None
    assert secrets.fit(docs, sample_docs=2) is not None


def test_spans_that_meet_become_one_mark(spark, monkeypatch):
    monkeypatch.setattr(secrets, "_spans_of", lambda part, model: [[(0, 3, "crf"), (3, 5, "hex"), (5, 6, "crf"), (8, 9, "crf")]])
    part = next(slices(pa.array(["abcdefghij"])))
    assert secrets.redacted(part, None) == ["[SECRET]gh[SECRET]j"]


def test_secrets_with_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "plain words only")], "doc_id long, text string")
    assert secrets.fit(docs) is None
    assert secrets.fit(docs.limit(0)) is None
    assert secrets.scan(docs.limit(0), None, ["doc_id"]).count() == 0
