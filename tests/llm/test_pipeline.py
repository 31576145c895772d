"""The pipeline's stages: what each drops and changes, and that they chain."""

import random

import corpus_pipeline as P

from tidemark.llm.secrets import fit as fit_secrets


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1.0) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    rnd = random.Random(1)
    words = [f"{a}{b}" for a in "the of and water stone river".split() for b in ("", "s", "ing", "ed", "er")]
    clean = [(k, " ".join(rnd.choices(words, k=80)), "en" if k % 2 else "de") for k in range(30)]
    item = "what is the tallest of all the mountains that stand on the island today"
    near = clean[3][1] + " end"
    rows = clean + [(40, near, "en"), (41, clean[4][1], "de"), (41, clean[4][1], "de"), (42, f"some words {item} more", "en"), (43, None, "en"), (44, "12 34", "en"), (45, "my password=0123456789abcdef01 ok then", None), (None, "a row without an id", "en")]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = docs_of(spark, rows)
    kept = P.identify_language(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in rows} - {43, 44}
    single = P.drop_near_duplicates(spark, docs, str(tmp_path))
    assert single.columns == docs.columns
    left = sorted((r.doc_id for r in single.collect()), key=lambda x: (x is None, x))
    assert left == [*range(30), 42, 43, 44, 45, None]
    sound = P.drop_contaminated(spark, docs, str(tmp_path))
    assert sound.columns == docs.columns and sound.count() == len(rows) - 1
    safe = P.redact_secrets(spark, docs, str(tmp_path))
    assert safe.columns == docs.columns
    texts = {r.doc_id: r for r in safe.collect()}
    assert texts[45].text == "my [SECRET] ok then" and texts[45].n_chars == len(texts[45].text)
    assert all(texts[i].text == t for i, t, _ in clean)
    assert fit_secrets(docs.limit(0)) is None


def test_near_copies_are_dropped_by_row(spark, tmp_path):
    """An id with several texts is judged text by text, rows without an id come last, and repeated rows stay once."""
    rnd = random.Random(8)
    one, other, third = (" ".join(rnd.choices([f"w{i}" for i in range(300)], k=60)) for _ in range(3))
    rows = [(3, one, "en"), (5, other, "en"), (5, one + " end", "en"), (5, other, "en"), (None, other + " x", "en"), (None, third, "en"), (None, third, "en"), (7, None, "en"), (8, "", "en")]
    left = P.drop_near_duplicates(spark, docs_of(spark, rows), str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([(3, one), (5, other), (None, third), (7, None), (8, "")], key=repr)


def test_stages_take_empty_tables_and_unlabelled_texts(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = docs_of(spark, [(1, "words", None), (2, "1", None)])
    assert [r.doc_id for r in P.identify_language(spark, docs, str(tmp_path)).collect()] == [1]
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_run_equals_its_stages_one_by_one(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(k, " ".join(rnd.choices(["stone", "river", "und", "der", "token=0123456789abcdef0123", "the"], k=rnd.randint(1, 90))), rnd.choice(["en", "de"])) for k in range(60)]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[5][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, docs.select(*key).collect())) == sorted(map(tuple, P.run(spark, str(tmp_path)).select(*key).collect()))


def test_texts_in_no_learned_language_are_dropped_whatever_the_number_of_labels(spark, tmp_path):
    rnd = random.Random(7)
    tongues = {
        "en": "the of and water stone river morning winter house letter where they would never leave again because nothing else mattered".split(),
        "de": "der und nicht wasser stein fluss morgen winterlich haus brief wohin sie niemals wieder gehen weil sonst nichts wichtig war".split(),
        "fr": "le et dans eau pierre rivière matin hiver maison lettre où ils jamais partir encore parce que rien autre comptait".split(),
        "es": "el y en agua piedra río mañana invierno casa carta donde ellos nunca salir otra vez porque nada más importaba".split()}
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto"
    russian = "все люди рождаются свободными и равными в своём достоинстве и правах"
    junk = " ".join("".join(rnd.choices("bcdfghjklmnpqrstvwxz", k=rnd.randint(4, 9))) for _ in range(30))
    for labels in (["en"], ["en", "de"], ["de", "en", "es", "fr"]):
        rows = [(k, " ".join(rnd.choices(tongues[labels[k % len(labels)]], k=60)), labels[k % len(labels)]) for k in range(48)]
        switched = [(100 + k, " ".join(w for lang in rnd.sample(labels, len(labels)) for w in rnd.choices(tongues[lang], k=8)), None) for k in range(4)]
        rows += switched + [(200, finnish, None), (201, russian, None), (202, junk, None)]
        left = {r.doc_id for r in P.identify_language(spark, docs_of(spark, rows), str(tmp_path)).collect()}
        assert left == {i for i, *_ in rows} - {200, 201, 202}, labels
