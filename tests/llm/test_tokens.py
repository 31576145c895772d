"""Token ids, bit packing and sequence packing: exact round trips."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import pack, solve
from tidemark.llm.texts import slices
from tidemark.llm.token_files import Pack, pack_bits, read_token_files, unpack_bits, write_pack, write_token_files
from tidemark.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_librarys_ids():
    rnd = random.Random(1)
    some = ["a", "b", "'s", " ", "  ", "\n", ",", ".", "é", "—", "1", "\t", "日", "<", "|>", "<|endoftext|>", "\r\n", "×", " ", "　", "\x1c"]
    texts = ["", None, " \n", "it's, don't", "“q” – z"] + ["".join(rnd.choices(some, k=rnd.randint(1, 30))) for _ in range(3000)]
    encoder = Encoder(PATH)
    for part in slices(pa.array(texts)):
        ids, count = encoder.encode(part)
        at = np.concatenate([[0], np.cumsum(count)])
        for i in range(len(part)):
            assert list(ids[at[i] : at[i + 1]]) == ids_of(texts[part.lo + i]), texts[part.lo + i]


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 31])
def test_bits_round_trip(bits):
    for n in (0, 1, 63, 64, 65, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint32)
        assert (unpack_bits(pack_bits(ids, bits), bits, n) == ids).all()


def test_pack_gives_single_documents():
    docs = [np.arange(n, dtype=np.uint32) for n in (0, 5, 9000, 1, 4096)]
    held = Pack(write_pack([4, None, 6, 7, 8], docs, 14))
    assert all((held.document(k) == d).all() for k, d in enumerate(docs))
    assert (held.ids(4990, 5010) == np.arange(4985, 5005)).all()
    assert list(held.nulls) == [0, 1, 0, 0, 0]
    with pytest.raises(ValueError):
        Pack(b"x" * 100)


def rows():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices(["token", "id", "Ünicode", "\n", "42"], k=rnd.randint(1, 300))) for _ in range(40)] + ["", None, "a"]
    ids = list(range(100, 100 + len(texts)))
    rnd.shuffle(ids)
    return list(zip(ids, texts)) + [(ids[0], texts[0])]


def test_files_hold_every_document_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows()], "doc_id long, text string, start int")
    write_token_files(docs, str(tmp_path / "ids"), PATH, end_id=2, pack_ids=500)
    got = sorted(tuple(r) for r in read_token_files(spark, str(tmp_path / "ids")).collect())
    want, before = [], 0
    for i, t in sorted(rows(), key=lambda r: (r[0], r[1] or "")):
        ids = np.array([*ids_of(t), 2], dtype="<u4")
        want.append((i, before, len(ids), zlib.crc32(ids.tobytes())))
        before += len(ids)
    assert got == sorted(want)


def test_files_of_an_empty_table(spark, tmp_path):
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "ids"), PATH)
    assert read_token_files(spark, str(tmp_path / "ids")).count() == 0


@pytest.mark.parametrize("capacity", [64, 200])
def test_sequences_hold_every_piece_without_gaps(spark, capacity):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows()], "doc_id long, text string, piece string")
    got = [r.asDict() for r in pack(docs, PATH, 0, capacity).collect()]
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for i, t in rows():
        ids = np.array([*ids_of(t), 0], dtype="<u4")
        head = len(ids) % capacity or capacity
        edges = [0, *range(min(head, len(ids)), len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bound = -(-sum(r["length"] for r in got) // capacity)
    assert len(by_sequence) <= bound + 3


def test_packing_an_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_the_histogram_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 2049, 20_000) if seed % 2 else np.clip(rng.lognormal(6.3, 1, 20_000), 1, 2048).astype(int)
    histogram = Counter(lengths.tolist())
    plan = solve(dict(histogram))
    held = Counter()
    for config, number in plan:
        assert number > 0 and sum(n * a for n, a in config.items()) <= 2048
        for n, a in config.items():
            held[n] += a * number
    assert held == histogram
    assert sum(number for _, number in plan) <= 1.01 * lengths.sum() / 2048 + 2
    assert solve({}) == []
