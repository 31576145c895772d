"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark, texts scanned once.

Normalising maps A-Z to lower case and every ASCII byte that is no letter or digit to a separator; words are what
is left, every other character included. A window is 13 consecutive words of an item; a shorter item is one window.
The automaton holds windows as " w1 w2 ... w13 " and runs over a document's words joined the same way, so a match
begins and ends at word borders. Matches are mapped back to word numbers and, for `spans`, to code points of the
original text.

Defined results: a null or empty text, or one without words, has no words and no hits and is not contaminated; rows
are judged one by one, so repeated rows repeat their result; a null or wordless item has no window; an item id given
twice counts once; an item without an id has windows that hit and is not counted among the items; a very long text is scanned
whole, in one task; an empty table gives an empty result, an empty benchmark no hits. Only `id_col` and `text_col`
are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.texts import Slice, annotate, byte_class, kept, lists, map_batches, slices, words
from tidemark.session import cut

WINDOW = 13
#: Bytes of windows and item ids that one automaton may hold (it takes some fifty times as many); a larger benchmark is scanned
#: for in several narrow passes.
SHARD_BYTES = 4 << 20

_WORD = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x41, 0x5A), (0x5B, 0x60), (0x7B, 0x7F)], inverted=True)
_WORD[65:91] = True
_MAP = bytes(i + 32 if 65 <= i <= 90 else i if _WORD[i] else 32 for i in range(256))


def normal(text: bytes) -> bytes:
    return b" ".join(text.translate(_MAP).split())


def windows(text: str, size: int = WINDOW) -> set[bytes]:
    found = normal(text.encode()).split()
    return {b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def window_table(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(window, items, hash): every distinct window of the benchmark and the sorted ids of the items that have it."""
    rows = benchmark.select(benchmark[text_col].alias("text"), benchmark[item_col].cast("string").alias("item")).where("text is not null")

    def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(1).to_pylist()
            for part in slices(batch.column(0)):
                for i in range(len(part)):
                    found = list(windows(part.text(i).decode(), window))
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([items[part.lo + i]] * len(found), pa.string())], names=["window", "item"])

    found = map_batches(rows, cut_windows, "window binary, item string")
    # An item without an id takes part in hits and is named by nothing.
    found = found.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return cut(found.withColumn("hash", F.xxhash64("window")), "windows")


def _shards(benchmark: DataFrame, item_col: str, text_col: str, window: int, limit: int) -> tuple[int, Iterator[list[tuple[int, bytes, list[str]]]]]:
    """The windows (words, bytes, items) in a number of shares of about `limit` bytes, dealt by hash; the driver holds one at a time."""
    table = window_table(benchmark, item_col, text_col, window)
    size = F.length("window") + F.aggregate("items", F.lit(0).cast("long"), lambda n, item: n + F.length(item))
    total = table.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    number = max(1, -(-total // limit))

    def share(k: int) -> list[tuple[int, bytes, list[str]]]:
        rows = table.where(F.pmod("hash", F.lit(number)) == k).select("window", "items").toArrow()
        found = zip(rows.column("window").to_pylist(), rows.column("items").to_pylist())
        return [(bytes(w).count(b" ") + 1, bytes(w), items) for w, items in sorted(found)]

    return number, map(share, range(number))


def _automaton(patterns: list[tuple[int, bytes, list[str]]]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for number, (words_of, pattern, _) in enumerate(patterns):
        made.add_word(" " + pattern.decode("latin-1") + " ", (words_of, number))
    made.make_automaton()
    return made


def _scan(sent):
    def scan(part: Slice) -> list[pa.Array]:
        patterns = sent.value
        find = kept("automaton", lambda: _automaton(patterns)) if patterns else None
        n_words, hit_counts, hit_words, item_counts, items = [], [], [], [], []
        for i in range(len(part)):
            text = normal(part.text(i))
            n_words.append(text.count(b" ") + 1 if text else 0)
            ends = list(find.iter(" " + text.decode("latin-1") + " ")) if find and text else ()
            if not ends:
                hit_counts.append(0)
                item_counts.append(0)
                continue
            spaces = np.flatnonzero(np.frombuffer(b" " + text + b" ", dtype=np.uint8) == 32)
            last = np.searchsorted(spaces, np.array([end for end, _ in ends])) - 1
            mark = np.zeros(n_words[-1] + 1, dtype=np.int64)
            sizes = np.array([size for _, (size, _) in ends])
            np.add.at(mark, last - sizes + 1, 1)
            np.add.at(mark, last + 1, -1)
            hit = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            hit_counts.append(len(hit))
            hit_words.append(hit)
            own = sorted({item for number in {number for _, (_, number) in ends} for item in patterns[number][2]})
            item_counts.append(len(own))
            items.extend(own)
        flat = np.concatenate(hit_words) if hit_words else np.zeros(0, np.int64)
        return [
            pa.array(n_words, pa.int64()), lists(np.array(hit_counts), pa.array(flat, pa.int64())),
            lists(np.array(item_counts), pa.array(items, pa.string()))]

    return scan


def _spans(part: Slice, hits: pa.Array) -> pa.Array:
    """Runs of hit words as code points of the original text, end exclusive."""
    starts, ends, first = words(part, _WORD)
    point = np.cumsum((part.data & 0xC0) != 0x80) if len(part.data) else np.zeros(0, np.int64)
    rows = []
    for i, own in enumerate(hits.to_pylist()):
        if not own:
            rows.append([])
            continue
        own = np.sort(np.array(own))
        cuts = np.flatnonzero(np.diff(own) > 1)
        lo, hi = own[np.concatenate([[0], cuts + 1])], own[np.concatenate([cuts, [len(own) - 1]])]
        base = point[part.off[i]] - 1
        rows.append([{"start": int(point[starts[first[i] + a]] - 1 - base), "end": int(point[ends[first[i] + b] - 1] - base)} for a, b in zip(lo, hi)])
    return pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str], prefix: str = "", id_col: str = "item_id",
                  text_col: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, spans: bool = False) -> DataFrame:
    """`keep` of `docs`, and with `prefix`: n_words, n_hit, n_items, items (sorted), contaminated, and with `spans`
    the hit passages as (start, end) code points of the text."""
    sc = docs.sparkSession.sparkContext
    hits = T.StructType.fromDDL(f"`{prefix}n_words` long, `{prefix}hits` array<long>, `{prefix}items` array<string>")
    done = docs
    number, shares = _shards(benchmark, id_col, text_col, window, shard_bytes)
    for k, share in enumerate(shares):
        scan = _scan(sc.broadcast(share))
        if k == 0:
            done = annotate(done, [*dict.fromkeys([*keep, "text"])] if spans or number > 1 else keep, hits, scan)
            continue
        done = cut(done, "scanned")  # one automaton at a time in a task
        again = T.StructType.fromDDL(f"`{prefix}more_n` long, `{prefix}more_hits` array<long>, `{prefix}more_items` array<string>")
        done = annotate(done, done.columns, again, scan)
        done = done.withColumns({
            f"{prefix}hits": F.array_union(f"{prefix}hits", f"{prefix}more_hits"), f"{prefix}items": F.array_union(f"{prefix}items", f"{prefix}more_items"),
        }).drop(f"{prefix}more_n", f"{prefix}more_hits", f"{prefix}more_items")
    result = done.withColumns({
        f"{prefix}n_hit": F.size(f"{prefix}hits").cast("long"), f"{prefix}n_items": F.size(f"{prefix}items").cast("long"),
        f"{prefix}items": F.array_sort(f"{prefix}items")})
    result = result.withColumn(f"{prefix}contaminated", (F.col(f"{prefix}n_hit") > 0) & (20 * F.col(f"{prefix}n_hit") >= F.col(f"{prefix}n_words")))
    made = [f"{prefix}{c}" for c in ("n_words", "n_hit", "n_items", "items", "contaminated")]
    if not spans:
        return result.select(*keep, *made)
    return with_spans(result, [*keep, *made], f"{prefix}hits", f"{prefix}spans")


def with_spans(found: DataFrame, keep: list[str], hits: str, name: str) -> DataFrame:
    """`keep` of `found` and the passages its `hits` (word numbers) cover in `text`."""
    schema = T.StructType([*[found.schema[c] for c in keep], T.StructField(name, T._parse_datatype_string("array<struct<start:long,end:long>>"))])

    def run(batches):
        for batch in batches:
            for part in slices(batch.column(0)):
                own = batch.slice(part.lo, len(part))
                yield pa.RecordBatch.from_arrays([*own.columns[2:], _spans(part, own.column(1))], names=schema.names)

    return map_batches(found.select(found["text"].alias("_text"), found[hits].alias("_hits"), *[found[c] for c in keep]), run, schema)
