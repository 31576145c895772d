"""Best-fit packing by a configuration linear program over the length histogram.

Documents become token ids with an end id; longer ones than a sequence are cut from the back, so that only the first
piece is shorter. Whatever the input, there are at most `capacity` distinct lengths, so the program is solved on the
driver from the histogram alone: a configuration is a multiset of lengths that fits one sequence, and the fewest
sequences that cover all pieces are wanted. Multiplicative weights price the lengths, lengths covered less than others
becoming dearer; an unbounded-knapsack dynamic program finds the best filling of every space at these prices, and from
it, for each length still short, the best configuration that holds it. The fractional solution is rounded down,
fullest configurations first; what is left is filled best fit by best fit, a whole group of equal sequences at a time.

Pieces then find their places in parallel: the k-th piece of a length takes the k-th place of that length, and k is the
number of such pieces in earlier tasks plus the place within the task, so no length (one may hold a third of all pieces)
meets in one task.

Defined results: a null or empty text is one piece of the end id alone; equal rows are packed each; doc_id may be null;
an empty table gives an empty result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.texts import NARROW_BYTES, map_batches, slices
from tidemark.llm.tokens import encoder
from tidemark.session import cut, small_frame

CAPACITY = 2048
#: Rounds of the multiplicative weights, how far short of the best a configuration may be, the weights' step, and the
#: share of what its scarcest length still lacks that a configuration takes at once.
ROUNDS, SLACK, STEP, SHARE = 60, 0.003, 3.0, 0.6


def _prices(w: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every space the best value of lengths that fit it, and the length to take first (0: leave one place)."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, dtype=np.int64)
    for space in range(1, capacity + 1):
        k = np.searchsorted(lengths, space, "right")
        best[space] = best[space - 1]
        if k:
            value = best[space - lengths[:k]] + w[:k]
            i = k - 1 - int(value[::-1].argmax())  # of equal ones the longest: short lengths fill gaps later
            if value[i] > best[space]:
                best[space], take[space] = value[i], lengths[i]
    return best, take


def _filling(take: np.ndarray, space: int) -> dict[int, int]:
    found: dict[int, int] = {}
    while space > 0:
        length = int(take[space])
        if length:
            found[length] = found.get(length, 0) + 1
            space -= length
        else:
            space -= 1
    return found


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Configurations (length: pieces of it) with their numbers of sequences, together holding exactly the histogram."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if not left:
        return []
    plan: list[tuple[dict[int, int], int]] = []
    if left.get(capacity):
        plan.append(({capacity: 1}, left.pop(capacity)))
    lengths = np.array(sorted(left), dtype=np.int64)
    demand = np.array([left[int(n)] for n in lengths], dtype=float)
    place = {int(n): i for i, n in enumerate(lengths)}
    open_demand = demand.copy()
    used: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(rounds if len(lengths) else 0):
        live = open_demand >= np.minimum(1.0, demand)
        if not live.any():
            break
        w = np.where(live, lengths / capacity * np.exp(STEP * (open_demand / demand - 1)), 0.0)
        best, take = _prices(w[live], lengths[live], capacity)
        value = w + best[capacity - lengths]
        for i in np.flatnonzero(live & (value >= (1 - SLACK) * value[live].max()))[::-1]:
            config = _filling(take, capacity - int(lengths[i]))
            config[int(lengths[i])] = config.get(int(lengths[i]), 0) + 1
            step = min(open_demand[place[n]] / a for n, a in config.items()) * SHARE
            if step <= 0:
                continue
            key = tuple(sorted(config.items()))
            used[key] = used.get(key, 0) + step
            for n, a in config.items():
                open_demand[place[n]] -= a * step
    for key, number in used.items():
        number = min(int(number + 0.5), *(left[n] // a for n, a in key))
        if number > 0:
            plan.append((dict(key), number))
            for n, a in key:
                left[n] -= number * a
    remaining = np.array([left[int(n)] for n in lengths], dtype=np.int64)
    while remaining.any():
        config, space, free = {}, capacity, remaining.copy()
        while True:
            fits = np.flatnonzero((free > 0) & (lengths <= space))
            if not len(fits):
                break
            i = int(fits[-1])
            a = min(int(free[i]), space // int(lengths[i]))
            config[i] = a
            free[i] -= a
            space -= a * int(lengths[i])
            if free[i] and lengths[i] <= space:
                break
            free[i] = 0
        number = min(int(remaining[i]) // a for i, a in config.items())
        plan.append(({int(lengths[i]): a for i, a in config.items()}, number))
        for i, a in config.items():
            remaining[i] -= a * number
    return plan


def _places(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, lo, hi, first sequence, sequences, offset): pieces lo..hi-1 of a length, dealt over the sequences."""
    rows, given, sequence = [], {}, 0
    for config, number in plan:
        offset = 0
        for n, a in sorted(config.items(), reverse=True):
            lo = given.get(n, 0)
            given[n] = lo + a * number
            rows.append((n, lo, lo + a * number, sequence, number, offset))
            offset += a * n
        sequence += number
    return rows


def _pieces(path: str, end_id: int, capacity: int):
    schema = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for part in slices(batch.column(0), NARROW_BYTES):
                ids, count = encoder(path).encode(part)
                at = np.concatenate([[0], np.cumsum(count)])
                rows, piece, start, length, crc, rank = [], [], [], [], [], []
                for i in range(len(part)):
                    own = np.append(ids[at[i] : at[i + 1]], end_id).astype("<u4")
                    head = len(own) % capacity or capacity
                    edges = [0, *range(min(head, len(own)), len(own) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append(part.lo + i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(own[a:b].tobytes()))
                        rank.append(int(seen[b - a]))
                        seen[b - a] += 1
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array([task] * len(rows), pa.int32()), pa.array(rank, pa.int64())], names=schema)

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document."""
    spark = docs.sparkSession
    pieces = map_batches(
        docs.select("text", "doc_id"), _pieces(tokenizer, end_id, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")
    pieces = cut(pieces, "pieces")
    by_task = cut(pieces.groupBy("part", "length").agg(F.count("*").alias("c")), "by_task")
    histogram = {r["length"]: r["c"] for r in by_task.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # `capacity` rows at most
    places = small_frame(spark, _places(solve(histogram, capacity)), "length long, lo long, hi long, first long, of long, at long")
    before = F.sum("c").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = by_task.select(F.struct("part", "length").alias("_k"), F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.withColumn("_k", F.struct("part", "length")).join(before, "_k").withColumn("k", F.col("before") + F.col("rank"))
    # At most one row for each length of each configuration: bounded by the program's size, not by the input.
    places = F.broadcast(places.withColumnRenamed("length", "_n"))
    found = ranked.join(places, (F.col("length") == F.col("_n")) & (F.col("k") >= F.col("lo")) & (F.col("k") < F.col("hi")))
    nth = F.col("k") - F.col("lo")
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + nth % F.col("of")).alias("sequence_id"),
        (F.col("at") + F.expr("(k - lo) div of") * F.col("length")).alias("offset"))
