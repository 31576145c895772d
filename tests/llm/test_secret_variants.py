"""What the field finds beside the base patterns: kinds of secrets it was not trained on, and texts without any."""

import random
import string

import numpy as np
import pytest

from tidemark.llm import secrets

WORDS = "the of and water mother house shall between which thorough weather token key pass secret author keyboard der die wasser straße gründlich".split()
MIXED = string.ascii_letters + string.digits

# Families by what stands before and after the value. None of these names, links or brackets is used to train.
FAMILIES = {
    "arrow": ("client_secret -> ", "", MIXED, 24),
    "sentence": ("the secret key is ", "", MIXED, 20),
    "header": ("Authorization: Bearer ", "", MIXED + "-_", 36),
    "json": ('{"refresh_token_value": "', '"}', MIXED + "+/", 28),
    "tag": ("<passwd_hash>", "</passwd_hash>", MIXED, 18),
    "flag": ("--auth-key-file ", " --verbose", string.ascii_uppercase + string.digits, 22),
    "short hex": ("api key (", ")", string.digits + "abcdef", 15),
    "signs in quotes": ('password is "', '"', MIXED + "~!@#%^&*", 16)}


def corpus(rnd):
    rows = []
    for k in range(400):
        words = rnd.choices(WORDS, k=60)
        if k % 3 == 0:
            value = "".join(rnd.choices(string.digits + "abcdef", k=rnd.choice((16, 20, 32, 40))))
            words.insert(rnd.randrange(60), rnd.choice((f"password={value}", f'token = "{value}"', value, "AKIA" + value.upper()[:16], f"api_key: {value}")))
        rows.append((k, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def field(spark):
    return secrets.fit(spark.createDataFrame(corpus(random.Random(1)), "doc_id long, text string"))


def planted(rnd, family, n):
    lead, close, letters, size = FAMILIES[family]
    rows = []
    for _ in range(n):
        value = rnd.choice(string.ascii_letters.lower()[:6]) + "".join(rnd.choices(letters, k=size - 2)) + rnd.choice(string.digits)
        head = " ".join(rnd.choices(WORDS, k=rnd.randint(0, 30)) + [lead])
        rows.append((head + value + close + " " + " ".join(rnd.choices(WORDS, k=20)), len(head), len(head) + len(value)))
    return rows


def test_kinds_of_secrets_unseen_in_training_are_found_whole(spark, field):
    rnd = random.Random(7)
    rows = [(family, *r) for family in FAMILIES for r in planted(rnd, family, 50)]
    docs = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.secret_spans] for r in secrets.scan(docs, field, ["doc_id"]).collect()}
    share, whole = {}, 0
    for i, (family, _, a, b) in enumerate(rows):
        covered = {x for s, e in found[i] for x in range(s, e)}
        whole += set(range(a, b)) <= covered
        share.setdefault(family, []).append(set(range(a, b)) <= covered)
    share = {k: float(np.mean(v)) for k, v in share.items()}
    print(share)
    assert min(share.values()) >= 0.8 and whole >= 0.9 * len(rows), share


def test_clean_texts_stay_clean(spark, field):
    rnd = random.Random(8)
    odd = [
        "the key 2019", "token: the water", "password is required", "secret of the house", "keyboard layout de-DE", "see https://www.example.org/the/weather?page=12",
        "ISBN 978-3-16-148410-0", "mail author@example.org", "at 12:30 on 2024-02-29", "v2.10.3-beta", "passed 1,024 of 2,048", "Schlüssel: gründlich", "room B747"]
    texts = []
    for _ in range(1000):
        words = rnd.choices(WORDS, k=70)
        words.insert(rnd.randrange(70), rnd.choice(odd))
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wrong = [(texts[r.doc_id][s.start : s.end]) for r in secrets.scan(docs, field, ["doc_id"]).collect() for s in r.secret_spans]
    assert len(wrong) <= 1, wrong


def test_odd_rows_are_searched_like_others(spark, field):
    long = "water of the house " * 20000 + 'password is "Zx9-Qw8~Lm2Tp" and ' + "mother " * 20000
    rows = [(None, 'token => "aB3dE5fG7hJ9kL1m" x'), (1, long), (1, long), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, [(s.start, s.end) for s in r.secret_spans]) for r in secrets.scan(docs, field, ["doc_id"]).collect()]
    at = long.index("Zx9")
    assert sorted((x for x in got if x[0]), key=lambda x: x[0]) == [(1, [(at, at + 13)])] * 2 + [(2, []), (3, [])]
    assert [x[1] for x in got if x[0] is None] == [[(10, 26)]]


def test_variants_come_from_base_spans_only():
    assert secrets.variants([("no secret in here", 0)]) == []
    made = secrets.variants([("der password=0123456789abcdef0123 of " + "x" * 5000, 3), ("plain words", 4)], 200)
    assert len(made) == 200 and made == secrets.variants([("der password=0123456789abcdef0123 of " + "x" * 5000, 3), ("plain words", 4)], 200)
    assert 60 < sum(1 for _, _, own in made if own) < 140 and max(len(text) for text, _, _ in made) < 2000
    assert all(0 <= a < b <= len(text) for text, _, own in made for a, b in own)
