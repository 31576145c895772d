"""Vectorised work on the texts of an Arrow batch, shared by the operators.

A text is read as UTF-8 bytes straight from Arrow's buffers. Work goes in slices of a few megabytes, so what a
task holds does not grow with its partition; one text is never split here and bounds the slice from below.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import ship

SLICE_BYTES = 2 << 20
#: For work that makes many numbers of each word.
NARROW_BYTES = 512 << 10

U8 = np.uint64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U8)
_ODD = [U8(0x9E3779B97F4A7C15), U8(0xC2B2AE3D27D4EB4F), U8(0x165667B19E3779F9), U8(0xD6E8FEB86659FD93)]


class Slice:
    """Rows [lo, hi) of a batch: their bytes, and where each text begins and the last one ends."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, off: np.ndarray):
        self.lo, self.hi, self.data, self.off = lo, hi, data, off

    def __len__(self) -> int:
        return self.hi - self.lo

    def text(self, i: int) -> bytes:
        return self.data[self.off[i] : self.off[i + 1]].tobytes()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a batch in slices of about `limit` bytes; a null text counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield Slice(i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def byte_class(ranges: list[tuple[int, int]], inverted: bool = False) -> np.ndarray:
    """A table of 256 booleans: which bytes lie in the ranges (ends included), or outside them."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return ~table if inverted else table


#: Words of `[^\x20\x09-\x0D]+`.
PLAIN_WORD = byte_class([(0x20, 0x20), (0x09, 0x0D)], inverted=True)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def words(part: Slice, inside_of: np.ndarray, data: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all runs of word bytes, and for each text the index of its first run (one entry more)."""
    data = part.data if data is None else data
    n, off = len(data), part.off
    inside = inside_of[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits, in place."""
    h ^= h >> U8(32)
    h *= _ODD[0]
    h ^= h >> U8(29)
    h *= _ODD[1]
    h ^= h >> U8(32)
    return h


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run, eight bytes at a time."""
    padded = np.zeros(len(data) + 16, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    h = left.astype(U8) * _ODD[2] + _ODD[3]
    h ^= eight[starts] & _MASKS[np.minimum(left, 8)]
    mix(h)
    more = np.flatnonzero(left > 8)
    step = 8
    while len(more):
        rest = left[more] - step
        part = h[more] ^ (eight[starts[more] + step] & _MASKS[np.minimum(rest, 8)])
        h[more] = mix(part)
        more = more[rest > 8]
        step += 8
    return h


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive runs by the position of the first; texts' ends are the caller's business."""
    if len(h) < n:
        return np.zeros(0, dtype=U8)
    total = h[: len(h) - n + 1] * _ODD[0]
    for k in range(1, n):
        total = mix(total + h[k : len(h) - n + 1 + k] * _ODD[k % 4]) if n <= 8 else total * _ODD[0] + h[k : len(h) - n + 1 + k]
    return mix(total + U8(n))


def long_gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Like gram_hashes in log2(n) steps: hashes of two halves, which may overlap, make one of the whole."""
    size, held = 1, h * _ODD[0] + _ODD[3]
    while size < n:
        step = min(size, n - size)
        if len(held) <= step:
            return np.zeros(0, dtype=U8)
        held = mix(held[:-step] * _ODD[1] + (held[step:] ^ _ODD[2]) * _ODD[3] + U8(step))
        size += step
    return held


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..lengths[0]-1, 0..lengths[1]-1, ... in one array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(begin, lengths)


def as_signed(h: np.ndarray) -> np.ndarray:
    return h.astype(U8).view(np.int64)


def lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column from the number of values of each row and all values."""
    off = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), values)


def fresh(name: str, taken: list[str]) -> str:
    """`name`, longer if a column of `taken` has it already (Spark's names ignore case)."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name += "_"
    return name


def annotate(docs: DataFrame, keep: list[str], fields: T.StructType, fn: Callable[[Slice], list[pa.Array]], text: str = "text",
             among: DataFrame | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """The columns `keep` of `docs`, row by row, and the columns `fields` that `fn` makes of each slice of texts (of about
    `limit` bytes).

    Rows are not shuffled. `fields` must have names of their own (see `fresh`). among: a frame of one id column; only rows
    whose value of that column may be in it are looked at (see `id_marks`; a join must decide)."""
    schema = T.StructType([docs.schema[c] for c in keep] + list(fields))
    arrow = to_arrow_schema(schema)
    made = list(arrow)[len(keep) :]
    marks = id_marks(among) if among is not None else None
    rest = [c for c in keep if c != text]  # the texts are sent once
    at = [1 + rest.index(c) if c != text else 0 for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if marks is not None:
                batch = marks.marked(batch)
            for part in slices(batch.column(0), limit):
                new = fn(part)
                new = [a if a.type == f.type else a.cast(f.type) for a, f in zip(new, made, strict=True)]
                old = [batch.column(k).slice(part.lo, len(part)) for k in at]
                yield pa.RecordBatch.from_arrays(old + new, names=arrow.names)

    columns = [docs[text].alias("_text"), *[docs[c] for c in rest]]
    return map_batches(docs.select(*columns, *([marks.place(docs[among.columns[0]])] if marks else [])), run, schema)


#: Bits of the filter of `id_marks` (1 MB, whatever the input).
FILTER_BITS = 1 << 23


class Marks:
    """A filter of ids of fixed size: what is not marked is not among the ids; what is may be."""

    def __init__(self, sent):
        self.sent = sent

    @staticmethod
    def place(key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_bit")

    def marked(self, batch: pa.RecordBatch, others: bool = False) -> pa.RecordBatch:
        """The marked rows of a batch whose last column is the place, or the others."""
        bit = batch.column(batch.num_columns - 1).to_numpy()
        return batch.filter(pa.array(((self.sent.value[bit // 64] >> (bit % 64)) & 1).astype(bool) != others))


def id_marks(ids: DataFrame) -> Marks:
    """Marks of a frame's only column. With very many ids they let everything through, and the join that follows decides."""
    held = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    places = ids.select(Marks.place(ids[ids.columns[0]]))
    words = places.groupBy(F.expr("cast(_bit div 64 as int)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("bits"))
    for word, value in words.collect():  # FILTER_BITS / 64 rows at most
        held[word] = value
    return Marks(ids.sparkSession.sparkContext.broadcast(held))


def id_filter(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose value of the only column of `ids` may be among them, so that others are not shuffled by a join."""
    marks = id_marks(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = marks.marked(batch)
            yield pa.RecordBatch.from_arrays(own.columns[:-1], names=own.schema.names[:-1])

    return map_batches(rows.select("*", Marks.place(ids.columns[0])), run, rows.schema)


#: What this worker process keeps between tasks of one stage, and the stage's name.
_kept: dict[str, Any] = {}
_stage: list[str] = [""]


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What `make` gives, made once a worker process and stage: a worker outlives its stage, and whatever it keeps is taken from
    the next one's memory."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def _enter(stage: str) -> None:
    if _stage[0] != stage:
        _kept.clear()
        _stage[0] = stage
        give_back()


def give_back() -> None:
    """Return what Arrow and the C library hold without use to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


def map_batches(rows: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """mapInArrow with this package at hand in the workers, which give back after a task what they do not keep."""
    ship(rows.sparkSession)
    stage = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _enter(stage)
        yield from fn(batches)
        give_back()

    return rows.mapInArrow(run, schema)
