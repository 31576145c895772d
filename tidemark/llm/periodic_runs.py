"""Periodic runs of words by tiles of every scale, and texts with the repeats taken out.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that holds its period
`copies` times or more, has `least` words or more, and that no neighbouring word extends. Periods fall into octaves
[P, 2P), P a power of two, and in each octave every P-th word of a text is a boundary.

1. Texts are exploded into overlapping tiles of each octave: a stretch of boundaries with P words before it and 4P after
   it. A tile is a row of its own, so a long text's tiles are solved by many tasks. A run holds two boundaries in a row
   whose next P words come again p words on; tiles where no period of the octave does that (by hashes of P words, doubled
   from octave to octave) hold nothing and are not sent.
2. Each tile is solved for itself: the Z-function forward from a boundary tells how far every period goes on, the
   Z-function of the reversed words how far back it holds. A period of which a part is a period already is a shorter one's
   and is left to its own octave.
3. A tile cuts longer runs into fragments. These are shuffled by text and period and stitched: two fragments of one run
   share a period's words or more, those of two runs fewer.

Texts without a fragment take no part in any shuffle.

Defined results: a null, empty or wordless text has no run and an empty collapsed text; equal rows have equal results,
whatever their number; very long texts are worked on as a whole in one task for step 1 only (some 200 bytes a word), steps 2
and 3 by tile; runs of equal length are told apart by start, then period; an empty table gives an empty result. Only the
text and the columns that are kept are read; their names may clash with those made here if a prefix is given. Words are
told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.texts import PLAIN_WORD, Slice, as_signed, fresh, id_marks, map_batches, mix, ranges, run_hashes, slices, words, _ODD
from tidemark.session import cut

#: A run holds its period so often, and so many words.
COPIES, LEAST = 4, 6
#: Words of a tile without its margins, at least; a tile of a large octave holds eight boundaries.
CORE = 4096
_CELLS = 1 << 20
#: Words up to which the Z-function compares one by one.
_SHORT = 64

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@lru_cache(maxsize=4)
def _least_primes(n: int) -> np.ndarray:
    """The least prime factor of every number below n (n a power of two)."""
    least = np.zeros(n, dtype=np.int64)
    for k in range(2, n):
        if k * k >= n:
            break
        if not least[k]:
            place = least[k * k :: k]
            place[place == 0] = k
    least[least == 0] = np.flatnonzero(least == 0)
    return least


def _hits(grams: np.ndarray, begin: np.ndarray, size: np.ndarray, octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, boundary (word of the text) and period wherever the P words at a boundary come again a period later."""
    texts = np.flatnonzero(size >= COPIES * octave)
    count = (size[texts] - 2 * octave) // octave + 1
    own, place = np.repeat(texts, count), ranges(count) * octave
    found = []
    step = max(1, _CELLS // octave)
    ahead = np.arange(octave, 2 * octave)
    for i in range(0, len(own), step):
        at = begin[own[i : i + step]] + place[i : i + step]
        other = at[:, None] + ahead
        room = place[i : i + step, None] + ahead <= size[own[i : i + step], None] - octave
        row, p = np.nonzero((grams[np.minimum(other, len(grams) - 1)] == grams[at][:, None]) & room)
        found.append((row + i, p + octave))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    row, p = (np.concatenate(x) for x in zip(*found))
    code = row * octave + (p - octave)
    later, earlier = np.isin(code + octave, code), np.isin(code - octave, code)
    later[later] &= own[row[later] + 1] == own[row[later]]
    earlier[earlier] &= own[row[earlier] - 1] == own[row[earlier]]
    keep = later | earlier
    return own[row[keep]], place[row[keep]], p[keep]


def _primitive(at: np.ndarray, p: np.ndarray, grams: np.ndarray, half: np.ndarray | None, octave: int) -> np.ndarray:
    """Whether the p words from `at` on are no repetition of fewer words."""
    is_one = np.ones(len(p), dtype=bool)
    if octave == 1:
        return is_one
    least = _least_primes(2 * octave)
    rest = p.copy()
    while True:
        live = np.flatnonzero(is_one & (rest > 1))
        if not len(live):
            return is_one
        prime = least[rest[live]]
        q = p[live] // prime
        span, a = p[live] - q, at[live]
        wide = span >= octave
        same = np.empty(len(live), dtype=bool)
        for which, table, n in ((wide, grams, octave), (~wide, half, octave // 2)):
            x, s, d = a[which], span[which], q[which]
            same[which] = (table[x] == table[x + d]) & (table[x + s - n] == table[x + s - n + d])
        is_one[live[same]] = False
        r = rest[live]
        while True:
            divides = (r % prime == 0) & (r > 1)
            if not divides.any():
                break
            r[divides] //= prime[divides]
        rest[live] = r


def explode_tiles(part: Slice) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """(row of the slice, octave, first word, words, boundaries) of all tiles that may hold a run. Words are numbers that
    tell the words of one tile apart; boundaries are counted from its first word. Both are 32-bit."""
    starts, ends, first = words(part, PLAIN_WORD)
    begin, size = first[:-1], np.diff(first)
    if not len(starts):
        return
    word = run_hashes(part.data, starts, ends)
    grams, half, octave = word, None, 1
    while (size >= COPIES * octave).any():
        own, place, period = _hits(grams, begin, size, octave)
        ok = _primitive(begin[own] + place, period, grams, half, octave)
        core = max(8 * octave, CORE)
        marked = np.unique(np.stack([own[ok], place[ok] // core, place[ok]], axis=1), axis=0)
        if len(marked):
            cuts = np.flatnonzero((np.diff(marked[:, :2], axis=0) != 0).any(axis=1)) + 1
            for group in np.split(marked, cuts):
                row, at = int(group[0, 0]), group[:, 2]
                lo, hi = max(int(at[0]) - octave, 0), min(int(at[-1]) + 4 * octave, int(size[row]))
                local = np.unique(word[begin[row] + lo : begin[row] + hi], return_inverse=True)[1]
                yield row, octave, lo, local.astype("<i4").tobytes(), (at - lo).astype("<i4").tobytes()
        if len(grams) <= octave:
            return
        grams, half = mix(grams[:-octave] * _ODD[1] + (grams[octave:] ^ _ODD[2]) * _ODD[3]), grams
        octave *= 2


def z_function(w: np.ndarray) -> list[int]:
    """For each place, how many words from there on equal those from the beginning on."""
    n = len(w)
    held = w.tolist() if n <= _SHORT else w
    z = [0] * n
    if not n:
        return z
    z[0] = n
    left = right = 0
    for i in range(1, n) if n <= _SHORT else (np.flatnonzero(w[1:] == w[0]) + 1).tolist():
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        if n <= _SHORT:
            while i + k < n and held[k] == held[i + k]:
                k += 1
        else:
            step = 16
            while i + k < n:  # compares ever longer stretches
                differ = np.flatnonzero(w[k : min(k + step, n - i)] != w[i + k : i + k + step])
                if len(differ):
                    k += int(differ[0])
                    break
                k += min(step, n - i - k)
                step *= 2
        z[i] = k
        left, right = i, i + k
    return z


def solve_tile(w: np.ndarray, boundaries: np.ndarray, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the fragments around a tile's boundaries whose smallest period lies in the octave."""
    least = _least_primes(2 * octave)
    found: dict[int, list[list[int]]] = {}
    for b in boundaries.tolist():
        z = z_function(w[b : b + 4 * octave])
        periods = []
        for p in range(octave, min(2 * octave, len(z))):
            if z[p] < octave:
                continue
            rest, is_one = p, True
            while rest > 1 and is_one:
                prime = int(least[rest])
                is_one = z[p // prime] < p - p // prime
                while rest % prime == 0:
                    rest //= prime
            if is_one:
                periods.append(p)
        if not periods:
            continue
        before = w[max(b - octave, 0) : b][::-1]
        around = w[max(b - octave, 0) : b + 2 * octave][::-1]
        back = z_function(np.concatenate([before, [-1], around]))
        for p in periods:
            # The word before b + p in the reversed stretch; nothing goes back beyond the tile's margin.
            at = len(before) + 1 + (len(around) - len(before) - p)
            start, end = b - min(back[at], len(before)) if len(before) else b, b + p + z[p]
            held = found.setdefault(p, [])
            if held and start + p <= held[-1][1]:
                held[-1][1] = max(held[-1][1], end)
            else:
                held.append([start, end])
    return [(p, s, e) for p, held in found.items() for s, e in held]


def _tiles(keyed: DataFrame) -> DataFrame:
    schema = T.StructType([*[T.StructField(k, T.LongType()) for k in ("k1", "k2")], T.StructField("octave", T.IntegerType()), T.StructField("lo", T.LongType()),
                           T.StructField("words", T.BinaryType()), T.StructField("boundaries", T.BinaryType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for part in slices(batch.column(0)):
                held, size = [], 0
                for row, *tile in explode_tiles(part):
                    held.append((int(k1[part.lo + row]), int(k2[part.lo + row]), *tile))
                    size += len(tile[2])
                    if size > 1 << 22:
                        yield _batch(held, names)
                        held, size = [], 0
                if held:
                    yield _batch(held, names)

    return map_batches(keyed.select("text", "k1", "k2"), run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _fragments(tiles: DataFrame) -> DataFrame:
    names = ["k1", "k2", "period", "start", "end"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k1, k2, octave, lo, held, marks in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "octave", "lo", "words", "boundaries"))):
                for p, s, e in solve_tile(np.frombuffer(held, "<i4"), np.frombuffer(marks, "<i4"), octave):
                    rows.append((k1, k2, p, lo + s, lo + e))
            if rows:
                columns = np.array(rows, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return map_batches(tiles, run, schema)


def stitch(fragments: DataFrame) -> DataFrame:
    """(k1, k2, runs) from fragments (k1, k2, period, start, end): runs by start, then period."""
    one = Window.partitionBy("k1", "k2", "period").orderBy("start", "end")
    reach = F.max("end").over(one.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") + F.col("period") <= reach, 0).otherwise(1)
    whole = fragments.distinct().withColumn("new", new).withColumn("run", F.sum("new").over(one.rowsBetween(Window.unboundedPreceding, 0)))
    whole = whole.groupBy("k1", "k2", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    whole = whole.withColumn("length", F.col("end") - F.col("start")).where(f"length >= {LEAST} and length >= {COPIES} * period")
    return whole.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))


def _collapsed(part: Slice, row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words, words dropped, and the words left joined by one space, of each text of a slice, given all their runs."""
    starts, ends, first = words(part, PLAIN_WORD)
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(change, first[row] + start + period, 1)
    np.add.at(change, first[row] + start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(kept)])[first]
    n_kept = np.diff(before)
    s, size = starts[kept], (ends - starts)[kept] + 1
    size[before[1:][n_kept > 0] - 1] -= 1  # no space after a text's last word
    past = np.cumsum(size)
    out = part.data[np.minimum(np.repeat(s, size) + ranges(size), max(len(part.data) - 1, 0))] if len(s) else np.zeros(0, np.uint8)
    spaces = np.delete(past - 1, before[1:][n_kept > 0] - 1)
    out[spaces] = 0x20
    off = np.concatenate([[0], past])[before].astype(np.int64)
    text = pa.LargeStringArray.from_buffers(len(part), pa.py_buffer(off.tobytes()), pa.py_buffer(out.tobytes()))
    return np.diff(first), np.diff(first) - n_kept, text


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The columns `keep` of every row of `docs`, and n_words, runs (start, length and period in words, by start, then
    period), n_dropped (words that a run contains after its first period) and collapsed (the other words, joined by one
    space)."""
    spark = docs.sparkSession
    k1, k2 = fresh("k1", keep), fresh("k2", keep)
    own = fresh("text", [*keep, k1, k2])
    held = [docs[c] for c in keep]
    keyed = docs.select(*held, docs[text].alias(own), F.xxhash64(*held, docs[text]).alias(k1), F.xxhash64(docs[text], F.lit(13), *held).alias(k2))
    plain = keyed.select(F.col(own).alias("text"), F.col(k1).alias("k1"), F.col(k2).alias("k2"))
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tiles = _tiles(plain).repartition(parts, "k1", "k2", "octave", "lo")
    found = cut(stitch(_fragments(tiles)), "runs")

    made = [("n_words", T.LongType()), ("runs", T._parse_datatype_string(RUNS)), ("n_dropped", T.LongType()), ("collapsed", T.StringType())]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(prefix + n, t) for n, t in made])
    arrow = to_arrow_schema(schema)
    runs_type = arrow.field(len(keep) + 1).type
    marks = id_marks(found.select(F.col("k1").alias(k1)))

    def finish(batch: pa.RecordBatch, runs: pa.ListArray | None) -> Iterator[pa.RecordBatch]:
        """Rows of text, kept columns and whatever else; runs by row."""
        if runs is not None:
            runs = runs.fill_null([]) if runs.null_count else runs
            offsets = runs.offsets.to_numpy()
            flat = runs.flatten()
            offsets = offsets - offsets[0]
            start, length, period = (flat.field(i).to_numpy() for i in range(3))
        for part in slices(batch.column(0)):
            if runs is None:
                own_runs = pa.array([[]] * len(part), runs_type)
                row = s = n = p = np.zeros(0, dtype=np.int64)
            else:
                own_runs = runs.slice(part.lo, len(part)).cast(runs_type)
                lo, hi = offsets[part.lo], offsets[part.hi]
                row = np.repeat(np.arange(len(part)), np.diff(offsets[part.lo : part.hi + 1]))
                s, n, p = start[lo:hi], length[lo:hi], period[lo:hi]
            n_words, dropped, collapsed = _collapsed(part, row, s, n, p)
            new = [pa.array(n_words), own_runs, pa.array(dropped), collapsed]
            new = [a if a.type == arrow.field(len(keep) + i).type else a.cast(arrow.field(len(keep) + i).type) for i, a in enumerate(new)]
            old = [c.slice(part.lo, len(part)) for c in batch.columns[1 : len(keep) + 1]]
            yield pa.RecordBatch.from_arrays(old + new, names=arrow.names)

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from finish(marks.marked(batch, others=True), None)

    def with_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from finish(batch, batch.column(len(keep) + 1))

    rest = map_batches(keyed.select(own, *keep, marks.place(F.col(k1))), without, schema)
    suspected = marked_rows(keyed.select("*", marks.place(F.col(k1))), marks, keyed.schema)
    names = {"k1": k1, "k2": k2}
    column = fresh("runs", keyed.columns)
    joined = suspected.join(found.select(*[F.col(a).alias(b) for a, b in names.items()], F.col("runs").alias(column)), [k1, k2], "left")
    return rest.unionByName(map_batches(joined.select(own, *keep, column), with_runs, schema))


def marked_rows(rows: DataFrame, marks, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = marks.marked(batch)
            yield pa.RecordBatch.from_arrays(own.columns[:-1], names=own.schema.names[:-1])

    return map_batches(rows, run, schema)
