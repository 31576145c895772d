"""Token ids as bit-packed files: each id takes the fewest bits that hold the vocabulary.

A pack is a self-contained byte string of whole documents:

    magic "TIDPACK1", then little-endian: bits u32, ids per block u32, documents u64, ids u64
    block offsets   (blocks + 1) u64, counted from the first block's byte
    document starts (documents + 1) u64, in ids
    doc ids         documents x i64, then documents x u8 (1: the doc_id is null)
    blocks          ids packed lowest bit first into 64-bit words; a block starts at a word

Every block but the last holds the same number of ids, so an id is found by its block's offset without reading others,
and a block is unpacked with numpy, 64 ids at a time. Packs are written by Spark's own writer as rows of
(part, pack, start, payload) in ascending doc_id order, so they work on any store and a lost task leaves none behind;
`start` is the number of ids before the pack in its part. A pack is closed at about a million ids; only a longer
document makes a larger one.

Defined results: a null or empty text has the end id alone; rows without doc_id come first; equal doc_ids follow each
other by text; an empty table gives an empty result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.texts import map_batches, slices
from tidemark.llm.tokens import encoder

MAGIC = b"TIDPACK1"
BLOCK_IDS = 4096
PACK_IDS = 1 << 20
_HEAD = struct.Struct("<8sIIQQ")


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """64-bit words holding the ids; the last group of 64 is filled up with zeros."""
    groups = -(-len(ids) // 64)
    wide = np.zeros(groups * 64, dtype=np.uint64)
    wide[: len(ids)] = ids
    wide = wide.reshape(groups, 64)
    out = np.zeros((groups, bits), dtype=np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= wide[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= wide[:, j] >> np.uint64(64 - shift)
    return out.reshape(-1)


def unpack_bits(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    held = words.reshape(-1, bits)
    mask = np.uint64((1 << bits) - 1)
    out = np.empty((len(held), 64), dtype=np.uint32)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = held[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value |= held[:, word + 1] << np.uint64(64 - shift)
        out[:, j] = value & mask
    return out.reshape(-1)[:n]


def write_pack(doc_ids: list[int | None], ids: list[np.ndarray], bits: int, block: int = BLOCK_IDS) -> bytes:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<u8")
    blocks = -(-len(flat) // block)
    words = np.minimum(np.arange(blocks + 1) * block, -(-len(flat) // 64) * 64) // 64 * bits
    return b"".join([
        _HEAD.pack(MAGIC, bits, block, len(ids), len(flat)), (words * 8).astype("<u8").tobytes(), starts.tobytes(),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
        pack_bits(flat, bits).astype("<u8").tobytes()])


class Pack:
    """A pack read back; nothing is unpacked before it is asked for."""

    def __init__(self, payload: bytes):
        magic, self.bits, self.block, docs, self.n_ids = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("this is no token pack")
        at = _HEAD.size
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(payload, "<u8", blocks + 1, at)
        self.starts = np.frombuffer(payload, "<u8", docs + 1, at := at + 8 * (blocks + 1)).astype(np.int64)
        self.doc_ids = np.frombuffer(payload, "<i8", docs, at := at + 8 * (docs + 1))
        self.nulls = np.frombuffer(payload, np.uint8, docs, at := at + 8 * docs)
        self.payload, self.at = payload, at + docs

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi-1 of the pack; only their blocks are unpacked."""
        if hi <= lo:
            return np.zeros(0, dtype=np.uint32)
        first, last = lo // self.block, -(-hi // self.block)
        a, b = int(self.offsets[first]), int(self.offsets[last])
        words = np.frombuffer(self.payload, "<u8", (b - a) // 8, self.at + a)
        n = min(last * self.block, self.n_ids) - first * self.block
        return unpack_bits(words, self.bits, n)[lo - first * self.block : hi - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def _packs(tokenizer: str, end_id: int, pack_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, before = TaskContext.get().partitionId(), 0, 0
        encode = encoder(tokenizer)
        bits = max(1, (encode.size - 1).bit_length())
        doc_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            payload = write_pack(doc_ids, held, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "pack", "start", "n_ids", "payload"])

        for batch in batches:
            own = batch.column(1).to_pylist()
            for part in slices(batch.column(0)):
                ids, count = encode.encode(part)
                at = np.concatenate([[0], np.cumsum(count)])
                for i in range(len(part)):
                    one = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id))
                    doc_ids.append(own[part.lo + i])
                    held.append(one)
                    size += len(one)
                    if size >= pack_ids:
                        yield close()
                        number, before = number + 1, before + size
                        doc_ids, held, size = [], [], 0
        if doc_ids:
            yield close()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, pack_ids: int = PACK_IDS) -> None:
    """Write the packs of all documents, in ascending doc_id order over parts and packs, below `path`."""
    ordered = docs.select("text", "doc_id").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    packs = map_batches(ordered, _packs(tokenizer, end_id, pack_ids), "part int, pack int, start long, n_ids long, payload binary")
    packs.write.option("compression", "uncompressed").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part, before = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            pack = Pack(batch.column(2)[row].as_buffer().to_pybytes())
            flat = pack.ids(0, pack.n_ids).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(pack.starts[:-1], pack.starts[1:])]
            n = len(crc)
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * n, pa.int32()), pa.array(pack.doc_ids, pa.int64(), mask=pack.nulls.astype(bool)), pa.array(before + pack.starts[:-1], pa.int64()),
                pa.array(np.diff(pack.starts), pa.int64()), pa.array(crc, pa.int64())], names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document over all packs), n_tokens and ids_crc32 of every document written."""
    packs = spark.read.schema("part int, pack int, start long, n_ids long, payload binary").parquet(path)
    docs = map_batches(packs.select("part", "start", "payload"), _read, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row for each written file, so the window's single task holds no more rows than the folder has files.
    totals = packs.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select("part", before.alias("before"))
    return docs.join(totals, "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
