"""Substring dedup by level-wise doubling: words covered by a long window that already starts in an earlier document go.

Windows of `window` words are found through shorter ones. At level m (13, 26, then the window itself) every window that
is still alive stands for its least m-gram (by hash): equal windows have equal ones, so a window whose least m-gram
is that of windows of one document alone cannot repeat, and is dropped. Only what repeats at one length is looked at
at twice that length; at the last length the windows themselves are compared. Each level holds a few hundredths of the
words left, and texts without a survivor are not read again.

Documents of the same words are one class from the start: the smallest doc_id stands for it, the others lose all words.

Defined results: null, empty and wordless texts have no words; texts below `window` words keep all; a repeated row
(same doc_id and words) gives the same result as its first, since no smaller doc_id has it; rows without a doc_id keep
all words and take none from others; an empty table gives an empty result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.texts import (
    PLAIN_WORD, U8, Slice, annotate, as_signed, id_filter, lists, long_gram_hashes, map_batches, run_hashes, slices, words)
from tidemark.session import cut

WINDOW = 50
FIRST = 13


def levels(window: int, first: int = FIRST) -> list[int]:
    """first, twice that, ... and the window last."""
    found = [min(first, window)]
    while found[-1] < window:
        found.append(min(2 * found[-1], window))
    return found


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive hashes."""
    size, held = 1, grams
    while size < width:
        step = min(size, width - size)
        if len(held) <= step:
            return held[:0]
        held = np.minimum(held[:-step], held[step:])
        size += step
    return held


class _Windows:
    """Windows of a slice: for each text the hashes that stand for them at level m, by the window's first word."""

    def __init__(self, part: Slice, window: int):
        self.window = window
        self.starts, self.ends, self.first = words(part, PLAIN_WORD)
        self.h = run_hashes(part.data, self.starts, self.ends)
        self.held: dict[int, np.ndarray] = {}

    def at(self, m: int, i: int) -> np.ndarray:
        if m not in self.held:
            self.held[m] = _least(long_gram_hashes(self.h, m), self.window - m + 1)
        a, b = self.first[i], self.first[i + 1]
        return self.held[m][a : max(a, b - self.window + 1)]


def _digest(part: Slice, i: int) -> str:
    return sha256(b" ".join(part.text(i).split())).hexdigest()


def _base(window: int, m: int):
    def make(part: Slice) -> list[pa.Array]:
        held = _Windows(part, window)
        anchors = [np.unique(held.at(m, i)) for i in range(len(part))]
        return [
            pa.array(np.diff(held.first), pa.int64()), pa.array([_digest(part, i) for i in range(len(part))], pa.string()),
            lists(np.array([len(a) for a in anchors]), pa.array(as_signed(np.concatenate(anchors)), pa.int64()))]

    return make


def _alive(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    among = np.sort(among.view(U8))
    place = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[place] == values


def _extend(window: int, m: int, longer: int):
    """Rows (text, doc_id, sha, anchors): the hashes at the longer level of windows alive at level m."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shas, anchors = batch.column(1), batch.column(2), batch.column(3)
            for part in slices(batch.column(0)):
                held = _Windows(part, window)
                at, out = [], []
                for i in range(len(part)):
                    row = part.lo + i
                    if _digest(part, i) != shas[row].as_py():
                        continue
                    own = np.asarray(anchors[row].values, dtype=np.int64)
                    out.append(np.unique(held.at(longer, i)[_alive(held.at(m, i), own)]))
                    at.append(row)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), shas.take(take), lists(np.array([len(o) for o in out]), pa.array(as_signed(np.concatenate(out or [np.zeros(0, U8)])), pa.int64()))],
                    names=["doc_id", "sha", "anchors"])

    return run


def _remove(window: int):
    """Rows (text, doc_id, sha, anchors): what is left without the words of windows among `anchors`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, anchors = batch.column(2), batch.column(3)
            for part in slices(batch.column(0)):
                held = _Windows(part, window)
                at, gone, kept, spans = [], [], [], []
                for i in range(len(part)):
                    row = part.lo + i
                    if _digest(part, i) != shas[row].as_py():
                        continue
                    n = int(held.first[i + 1] - held.first[i])
                    hit = np.flatnonzero(_alive(held.at(window, i), np.asarray(anchors[row].values, dtype=np.int64)))
                    mark = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(mark, hit, 1)
                    np.add.at(mark, hit + window, -1)
                    covered = np.cumsum(mark[:-1]) > 0
                    text = part.text(i).split()
                    at.append(row)
                    gone.append(int(covered.sum()))
                    left = [text[k] for k in np.flatnonzero(~covered)]
                    kept.append(b" ".join(left).decode())
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(take), shas.take(take), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "sha", "n_removed", "kept"])

    return run


def _texts_of(docs: DataFrame, alive: DataFrame) -> DataFrame:
    """(text, doc_id, sha, anchors) of the documents in `alive`; other texts are not shuffled."""
    few = id_filter(docs.select("text", "doc_id"), alive.select("doc_id"))
    return few.join(alive, "doc_id").select("text", "doc_id", "sha", "anchors")


def removed_classes(docs: DataFrame, base: DataFrame, window: int, first: int) -> DataFrame:
    """(doc_id, sha, n_removed, kept) of the class heads that lose words; kept: the words left, joined by one space."""
    heads = base.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    rows = cut(heads.groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.first("anchors").alias("anchors")), "heads")
    steps = levels(window, first)
    for m, longer in zip(steps, [*steps[1:], None]):
        flat = rows.select("doc_id", "sha", F.explode("anchors").alias("anchor"))
        held = flat.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
        held = held.select(F.struct("anchor").alias("_k"), "low")
        alive = flat.withColumn("_k", F.struct("anchor")).join(held, "_k")
        if longer is None:
            alive = alive.where("doc_id > low")
        alive = cut(alive.groupBy("doc_id", "sha").agg(F.collect_set("anchor").alias("anchors")), f"alive{m}")
        few = _texts_of(docs, alive)
        if longer is None:
            return map_batches(few, _remove(window), "doc_id long, sha string, n_removed long, kept string")
        rows = cut(map_batches(few, _extend(window, m, longer), "doc_id long, sha string, anchors array<long>"), f"level{longer}")
    raise AssertionError("the window is the last level")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the words left, joined by one space) of every row of `docs`."""
    steps = levels(window, first)
    fields = T.StructType.fromDDL("n_words long, sha string, anchors array<long>")
    base = cut(annotate(docs.select("doc_id", "text"), ["doc_id"], fields, _base(window, steps[0])), "base")
    gone = removed_classes(docs, base, window, first).select("sha", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    heads = base.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull()).groupBy("sha").agg(F.min("doc_id").alias("head"))
    known = heads.join(gone.dropDuplicates(["sha"]), "sha", "left").select(F.struct("sha").alias("_k"), "head", "n_removed", "kept_sha256")
    rows = base.select("doc_id", "n_words", "sha").withColumn("_k", F.struct("sha")).join(known, "_k", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("head"), F.lit(False))
    at_head = F.coalesce(F.col("doc_id") == F.col("head"), F.lit(False))
    return rows.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(at_head, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).when(at_head, F.coalesce("kept_sha256", "sha")).otherwise(F.col("sha")).alias("kept_sha256"))
