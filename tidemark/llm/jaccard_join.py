"""N-gram Jaccard self-join by a token-group matrix.

A document's set holds its distinct n-word shingles (64-bit hashes). Sets are ordered rarest token first, by counts of
the whole corpus in 2^22 buckets, which is only an order and may be coarse. Then, exactly:

1. Equal sets form one class; copies cost nothing from here on.
2. Two sets that link share a token among each one's first n - ceil(t n) + 1 tokens (its prefix). Tokens in the prefix
   of one class alone, or of two whose sizes and places rule a link out, are dropped.
3. Similar classes are put into groups: each goes to the class with which its prefix shares most. Groups are cut to a
   bounded number of tokens, opened once, and linked inside; groups of more than one part are opened again with one
   class of each component found so far.
4. What is connected becomes the groups of the matrix, again of bounded size: each group's union of prefix tokens is
   stored as rows (token, group, smallest and largest set). A query (class) meets groups of other components on its
   tokens. With p the place of the first token that it shares with the group's union, no member can share more than
   n - p tokens with it; the group is opened only if that can reach what the smallest fitting member needs. Where the
   group is one class, both sides' counts of tokens by hash bucket (about eight a bucket) bound the overlap once more.
5. Opened groups are verified against the whole sets, in parts of bounded size. Components of all links are the result.

Links inside a component are not looked for again, so a group of near copies never gives all its pairs.

Defined results: null, empty and wordless texts have an empty set and link with nothing; fewer words than n make one
shingle; a row's component is the smallest doc_id its set reaches, so repeated rows and ties share it; rows without a
doc_id take part and have a null component only where every document of theirs lacks an id; an empty table gives an
empty result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.graph import components
from tidemark.llm.texts import (
    ASCII_LOWER, NARROW_BYTES, PLAIN_WORD, U8, Slice, annotate, as_signed, gram_hashes, lists, map_batches, mix, ranges, run_hashes, slices, words)
from tidemark.session import cut

BUCKET_BITS = 22
BUCKETS = 1 << BUCKET_BITS
CHUNK = 1 << 14
_SHIFT = U8(64 - BUCKET_BITS)
#: Bounds of what one opened group holds: tokens and classes.
GROUP_TOKENS, GROUP_CLASSES = 200_000, 512
#: A token of more components than this is told apart by the next tokens of its classes, FINER times at most, where that makes
#: no more than FINER_ROWS rows of one on average: so always fewer than the pairs that it saves.
HOT_COMPONENTS, FINER, FINER_ROWS = 32, 2, 8
#: Tokens of whole groups that are solved at once.
SOLVED_TOKENS = 500_000


def shingle_sets(part: Slice, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = ASCII_LOWER[part.data]
    starts, ends, first = words(part, PLAIN_WORD, data)
    h = run_hashes(data, starts, ends)
    grams = gram_hashes(h, n)
    sets = []
    for i in range(len(part)):
        a, b = first[i], first[i + 1]
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            whole = np.array([b - a], dtype=U8)
            for x in h[a:b]:
                whole = mix(whole * U8(0x9E3779B97F4A7C15) + x)
            sets.append(whole)
        else:
            sets.append(np.zeros(0, dtype=U8))
    return sets


def _signature(s: np.ndarray) -> tuple[int, int]:
    x = mix(s ^ U8(0x27D4EB2F165667C5))
    return int(x.sum().view(np.int64)) if len(s) else 0, int(np.bitwise_xor.reduce(x * U8(0xC2B2AE3D27D4EB4F) + (x >> U8(17))).view(np.int64)) if len(s) else 0


def bucket_counts(docs: DataFrame, n: int) -> np.ndarray:
    """In how many texts tokens of each bucket occur, as fixed-point logarithms that only serve as an order.

    Every task adds up its own texts, then chunks of buckets are added up; 8 MB reach the driver, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.uint32)
        seen = False
        for batch in batches:
            for part in slices(batch.column(0), NARROW_BYTES):
                np.add.at(total, (np.concatenate(shingle_sets(part, n)) >> _SHIFT).astype(np.int64), np.uint32(1))
                seen = True
        for k in range(BUCKETS // CHUNK if seen else 0):
            own = total[k * CHUNK : (k + 1) * CHUNK]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([(own.astype(np.uint8) if own.max() < 256 else own).tobytes()], pa.binary())], names=["chunk", "counts"])

    def add(key, table):
        total = np.zeros(CHUNK, dtype=np.float64)
        for value in table.column("counts"):
            raw = value.as_buffer()
            total += np.frombuffer(raw, dtype=np.uint8 if raw.size == CHUNK else np.uint32)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([np.rint(1024 * np.log2(1 + total)).astype("<u2").tobytes()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    sums = map_batches(docs.select("text"), count, schema).groupBy("chunk").applyInArrow(add, schema)
    result = np.zeros(BUCKETS, dtype=np.uint16)
    for chunk, counts in sums.collect():
        result[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(counts, dtype="<u2")
    return result


def histogram(s: np.ndarray) -> bytes:
    """How many tokens fall into each of 64 or more buckets (by their first bits), about eight in one; 255 is 255 or more."""
    bits = max(6, min(16, (len(s) // 8).bit_length() - 1 if len(s) >= 8 else 0))
    return np.minimum(np.bincount((s >> U8(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def overlap_bound(a: bytes, b: bytes) -> int:
    """No two sets with these histograms share more tokens than this."""
    x, y = (np.frombuffer(v, dtype=np.uint8).astype(np.int64) for v in (a, b))
    x, y = (np.where(v == 255, 1 << 40, v) for v in (x, y))
    size = min(len(x), len(y))
    return int(np.minimum(x.reshape(size, -1).sum(axis=1), y.reshape(size, -1).sum(axis=1)).sum())


def may_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Rows (node, other, ...) whose histograms allow the similarity."""
    own = classes.select("node", F.col("n").alias("_n"), F.col("hist").alias("_h"))
    theirs = classes.select(F.col("node").alias("other"), F.col("n").alias("_n2"), F.col("hist").alias("_h2"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n, b, m = (batch.column(k) for k in range(4))
            need = percent * (n.to_numpy() + m.to_numpy())
            good = [(100 + percent) * overlap_bound(a[i].as_py(), b[i].as_py()) >= need[i] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(good, pa.bool_())).columns[4:], names=batch.schema.names[4:])

    both = pairs.join(own, "node").join(theirs, "other").select("_h", "_n", "_h2", "_n2", *pairs.columns)
    return map_batches(both, keep, pairs.schema)


def _least(percent: int, n: np.ndarray) -> np.ndarray:
    """ceil(percent * n / 100)."""
    return -(-n * percent // 100)


def set_table(docs: DataFrame, counts, n: int, percent: int) -> DataFrame:
    """doc_id, size, signature and histogram of the set, and its prefix in the common order with FINER tokens more."""

    def make(part: Slice) -> list[pa.Array]:
        weight = counts.value
        sizes, one, two, prefixes, hists = [], [], [], [], []
        for s in shingle_sets(part, n):
            a, b = _signature(s)
            sizes.append(len(s))
            hists.append(histogram(s))
            one.append(a)
            two.append(b)
            if len(s):
                keep = len(s) - _least(percent, len(s)) + 1 + FINER
                prefixes.append(s[np.lexsort((s, weight[(s >> _SHIFT).astype(np.int64)]))[:keep]])
            else:
                prefixes.append(s)
        return [
            pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
            pa.array(hists, pa.binary()), lists(np.array([len(p) for p in prefixes]), pa.array(as_signed(np.concatenate(prefixes)), pa.int64()))]

    fields = T.StructType.fromDDL("n long, one long, two long, hist binary, prefix array<long>")
    return annotate(docs.select("doc_id", "text"), ["doc_id"], fields, make, limit=NARROW_BYTES)


def could_link(n: Column, m: Column, percent: int) -> Column:
    """Whether two different sets of these sizes can be similar enough: at most the smaller one is shared, and of equal ones all
    but a token."""
    low, high, equal = F.least(n, m), F.greatest(n, m), (n == m).cast("int")
    return 100 * (low - equal) >= percent * (high + equal)


def _slack(percent: int) -> Column:
    """Tokens that a set of n may have beyond what any similar one shares."""
    return F.expr(f"cast(n - (n * {percent} + 99) div 100 as int)")


def _mixed(placed: DataFrame, percent: int) -> DataFrame:
    """Rows whose token is in two components or more and can be the first one that their set shares with a similar one: so
    few tokens come before it that what is left can reach the overlap with the smallest fitting set of the token."""
    each = placed.groupBy("_k.token").agg(
        F.min("component").alias("_a"), F.max("component").alias("_b"), F.min("n").alias("_lo"), F.max(F.col("n") - F.col("pos")).alias("_reach"))
    each = each.where("_a < _b").select(F.struct("token").alias("_k"), "_lo", "_reach")
    need = percent * (F.col("n") + F.greatest("_lo", F.ceil(F.col("n") * percent / 100)))
    can = (F.least(F.col("n") - F.col("pos"), "_reach") * (100 + percent)) >= need
    return placed.join(each, "_k").where(can).select(*placed.columns)


def finer(placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """`placed` (_k, node, n, pos, ...) with tokens of many components replaced by the first two, then three, shared ones.

    Two similar sets that share a key's tokens first share another one among the next few: where the key's last token is at place
    `last` and it holds `depth` tokens, at slack + depth at the latest. So a hot token of short sets, whose classes would meet
    all its groups, becomes keys that few share. (In long sets places tell more, and the next tokens are many.) Sets so small
    that fewer tokens make them similar keep the coarse key beside the finer ones."""
    done, rest = None, placed.withColumn("last", F.col("pos"))
    for depth in range(1, FINER + 1):
        ahead = F.greatest(_slack(percent) + depth - F.col("last"), F.lit(0))
        hot = rest.groupBy("_k.token").agg(F.approx_count_distinct("component", 0.1).alias("c"), F.avg(ahead).alias("rows"))
        hot = hot.where((F.col("c") > HOT_COMPONENTS) & (F.col("rows") <= FINER_ROWS))
        hot = cut(hot.select(F.struct("token").alias("_k")), "hot")
        if hot.isEmpty():
            break
        small = rest.join(hot, "_k", "left_semi").where(F.expr(f"(n * {percent} + 99) div 100 <= {depth}"))
        kept = rest.join(hot, "_k", "left_anti").unionByName(small)
        done = kept if done is None else done.unionByName(kept)
        more = rest.join(hot, "_k", "left_semi").join(classes.select("node", "prefix"), "node")
        after = F.slice("prefix", F.col("last") + 2, ahead)
        more = more.select(*rest.columns, F.posexplode(after).alias("_i", "_next"))
        place = F.col("last") + 1 + F.col("_i")
        more = more.select(*[
            {"_k": F.struct(F.xxhash64("_k.token", "_next").alias("token")).alias("_k"), "pos": (place - depth).alias("pos"), "last": place.alias("last")}.get(c, F.col(c))
            for c in rest.columns])
        rest = cut(_mixed(more, percent), "finer")
    found = rest if done is None else done.unionByName(rest)
    return found.drop("last")


def _links(percent: int):
    """Links inside groups: rows (g, node, asks, tokens) sorted by g and node; every row with asks is held against the others.
    A class that is linked to others gives one row: itself and the smallest class that its group's links reach."""

    def solve(g: np.ndarray, node: np.ndarray, asks: np.ndarray, tokens: pa.ListArray) -> list[tuple[int, int]]:
        off = tokens.offsets.to_numpy().astype(np.int64)
        flat = tokens.values.to_numpy().view(U8)[off[0] : off[-1]]
        off = off - off[0]
        size = np.diff(off)
        own = np.repeat(np.arange(len(node)), size)
        _, tid = np.unique(mix(flat ^ mix(g.view(U8)[own] * U8(0x9E3779B97F4A7C15))), return_inverse=True)
        order = np.argsort(tid, kind="stable")
        posted = own[order]
        begin = np.searchsorted(tid[order], np.arange(len(tid) and int(tid.max()) + 2))
        root = np.arange(len(node))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i in np.flatnonzero(asks):
            mine = tid[off[i] : off[i + 1]]
            lens = begin[mine + 1] - begin[mine]
            if lens.sum() == len(mine):
                continue
            shared = posted[np.repeat(begin[mine], lens) + ranges(lens)]
            low = int(shared.min())
            count = np.bincount(shared - low)
            at = np.arange(low, low + len(count))
            good = at[(100 * count >= percent * (size[i] + size[at] - count)) & (count > 0) & (at != i)]
            for j in good:
                a, b = find(int(i)), find(int(j))
                root[max(a, b)] = min(a, b)
        return [(int(node[i]), int(node[find(i)])) for i in range(len(node)) if root[i] != i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        before = (None, None)

        def ready(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts).combine_chunks()
            if not table.num_rows:
                return
            g, node, asks = (table.column(c).to_numpy() for c in ("g", "node", "asks"))
            tokens = table.column("tokens").chunk(0)
            off = tokens.offsets.to_numpy()
            begin = np.append(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g))
            at = 0
            while at < len(begin) - 1:
                stop = max(at + 1, int(np.searchsorted(off[begin], off[begin[at]] + SOLVED_TOKENS, "right")) - 1)
                lo, hi = begin[at], begin[stop]
                found = solve(g[lo:hi], node[lo:hi], asks[lo:hi], tokens.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])
                at = stop

        for batch in batches:
            if not batch.num_rows:
                continue
            g, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # A repeated row gives the same class again.
            new = np.append(before != (g[0], node[0]), (g[1:] != g[:-1]) | (node[1:] != node[:-1]))
            before = (g[-1], node[-1])
            batch = batch.filter(pa.array(new))
            if not batch.num_rows:
                continue
            g = g[new]
            last = int(np.searchsorted(g, g[-1]))  # the last group may go on in the next batch
            if last:
                yield from ready([*held, batch.slice(0, last)])
                held = [batch.slice(last)]
            elif held and held[-1].column(0)[0].as_py() == g[0]:
                held.append(batch)
            else:
                yield from ready(held) if held else ()
                held = [batch]
        if held:
            yield from ready(held)

    return run


def open_groups(docs: DataFrame, classes: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Verified links inside groups, as (a, b): b is the smallest class that a reaches in its group. Rows are (g, node,
    asks), groups of bounded size.

    Whole sets are computed again from one text of each class; other texts are not shuffled."""

    def make(part: Slice) -> list[pa.Array]:
        found = shingle_sets(part, n)
        marks = [_signature(s) for s in found]
        return [
            pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
            lists(np.array([len(s) for s in found]), pa.array(as_signed(np.concatenate(found)), pa.int64()))]

    wanted = cut(rows.join(classes.select("node", "doc_id", "one", "two"), "node").select("g", "node", F.col("asks").cast("int").alias("asks"), "doc_id", "one", "two"), "wanted")
    if wanted.isEmpty():
        return wanted.select(F.col("node").alias("a"), F.col("node").alias("b"))
    made = annotate(docs, ["doc_id"], T.StructType.fromDDL("one long, two long, tokens array<long>"), make, among=wanted.select("doc_id"), limit=NARROW_BYTES)
    # A class of rows without a doc_id is met by them.
    asked = wanted.select("g", "node", "asks", F.col("one").alias("_one"), F.col("two").alias("_two"), F.col("doc_id").alias("_id"))
    same = (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    full = made.join(asked, same).select("g", "node", "asks", "tokens")
    return map_batches(full.repartition("g").sortWithinPartitions("g", "node"), _links(percent), "a long, b long")


def _parts(rows: DataFrame, key: str, salt: int) -> DataFrame:
    """`rows` (node, n, key) with `part`: each key's rows dealt into parts of bounded size by the node's hash."""
    sizes = rows.groupBy(key).agg(F.sum("n").alias("_t"), F.count("*").alias("_c"))
    sizes = sizes.select(F.struct(key).alias("_k"), F.ceil(F.greatest(F.col("_t") / GROUP_TOKENS, F.col("_c") / GROUP_CLASSES)).alias("parts"), F.col("_c").alias("of"))
    return rows.withColumn("_k", F.struct(key)).join(sizes, "_k").drop("_k").withColumn("part", F.pmod(F.xxhash64("node", F.lit(salt)), F.col("parts")))


def _with_root(rows: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """`rows` with `component`: what links (a, b) say of the key, or the key itself."""
    return rows.join(links.select(F.col("a").alias(key), F.col("b").alias("component")), key, "left").withColumn("component", F.coalesce("component", key))


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs`."""
    sc = docs.sparkSession.sparkContext
    counts = sc.broadcast(bucket_counts(docs, n))
    sets = cut(set_table(docs, counts, n, percent), "sets")
    classes = sets.where("n > 0").groupBy("one", "two", "n").agg(F.min("doc_id").alias("doc_id"), F.first("hist").alias("hist"), F.first("prefix").alias("prefix"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    # A set that no other size fits has no partner.
    some = classes.where(100 * F.col("n") >= percent * (F.col("n") + 1))
    tokens = some.select("node", "n", F.posexplode(F.slice("prefix", F.lit(1), _slack(percent) + 1)).alias("pos", "token"))
    shared = tokens.groupBy("token").agg(
        F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.min(F.col("n") - F.col("pos")).alias("reach"))
    # Where just two classes share a token, their sizes and places already say whether it can link them.
    can = could_link(F.col("lo"), F.col("hi"), percent) & (F.col("reach") * (100 + percent) >= percent * (F.col("lo") + F.col("hi")))
    shared = shared.where(((F.col("c") > 2) & ((F.col("lo") < F.col("hi")) | could_link(F.col("lo"), F.col("hi"), percent))) | ((F.col("c") == 2) & can))
    # The join's keys are no columns of the aggregate, so that it has shuffles of its own, whose hot tokens AQE can split.
    key = F.col("token").bitwiseXOR(F.lit(1)).alias("_k")
    blocks = tokens.select(key, "node", "n", "pos").join(shared.select(key), "_k", "left_semi")
    blocks = cut(blocks.select(F.col("_k").bitwiseXOR(F.lit(1)).alias("token"), "node", "n", "pos"), "blocks")

    # Each class goes to the class that shares most with it among those where its tokens come earliest. Of many copies of one
    # text, each with edits of its own, that is the one with the fewest rare tokens before them: the plainest, which the others
    # link with even where they do not link one another.
    hubs = blocks.groupBy("token").agg(F.min(F.struct("pos", "node", "n")).alias("h"))
    hubs = hubs.select(F.struct("token").alias("_k"), F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.pos").alias("hub_pos"))
    reach = F.least(F.col("n") - F.col("pos"), F.col("hub_n") - F.col("hub_pos"))
    fits = (reach * (100 + percent) >= percent * (F.col("n") + F.col("hub_n"))) & ((F.col("node") == F.col("hub")) | could_link(F.col("n"), F.col("hub_n"), percent))
    home = blocks.withColumn("_k", F.struct("token")).join(hubs, "_k").where(fits).groupBy("node", "n", "hub").agg(F.count("*").alias("c"))
    home = home.groupBy("node", "n").agg(F.max(F.struct("c", (-F.col("hub")).alias("h"))).alias("best")).select("node", "n", (-F.col("best.h")).alias("home"))
    apart = may_link(home.where("node <> home").withColumnRenamed("home", "other"), classes, percent).select("node", "n", F.col("other").alias("home"))
    home = cut(_parts(home.where("node = home").union(apart), "home", 1).where("of > 1"), "homes")
    # A class is in one group here, so what a group's links reach is the component so far.
    inside = cut(open_groups(docs, classes, home.select(F.xxhash64("home", "part").alias("g"), "node", F.lit(1).alias("asks")), n, percent), "inside")

    # Groups of several parts: one class of each component so far, together once more.
    split = _with_root(home.where("parts > 1").select("node", "n", "home"), "node", inside)
    leaders = split.groupBy("home", "component").agg(F.min(F.struct("node", "n")).alias("x")).select("home", F.col("x.node").alias("node"), F.col("x.n").alias("n"))
    leaders = _parts(leaders, "home", 2).where("of > 1").select(F.xxhash64("home", "part", F.lit(2)).alias("g"), "node", F.lit(1).alias("asks"))
    between = cut(open_groups(docs, classes, leaders, n, percent), "between")

    # The matrix: what is connected makes groups, each with its union of tokens.
    nodes = blocks.select("node", "n").distinct()
    labelled = _with_root(_with_root(nodes, "node", inside).withColumnRenamed("component", "_first"), "_first", between).drop("_first")
    grouped = _parts(labelled, "component", 3).withColumn("group", F.xxhash64("component", "part"))
    grouped = cut(grouped.select("node", "component", F.col("of").alias("members"), "group"), "grouped")
    placed = cut(blocks.join(grouped, "node").withColumn("_k", F.struct("token")).drop("token"), "placed")
    placed = finer(cut(_mixed(placed, percent), "mixed"), classes, percent)
    matrix = placed.groupBy("_k.token", F.col("group").alias("g"), F.col("component").alias("of"), F.col("members").alias("size")).agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("pos")).alias("reach"))
    matrix = matrix.withColumn("_k", F.struct("token")).drop("token")
    need = percent * (F.col("n") + F.greatest("lo", F.ceil(F.col("n") * percent / 100)))
    meets = (
        (F.struct("members", "component") < F.struct("size", "of"))
        & (F.col("hi") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("lo") * percent)
        & ((F.col("lo") < F.col("n")) | (F.col("hi") > F.col("n")) | could_link(F.col("n"), F.col("n"), percent))
        & ((F.col("n") - F.col("pos")) * (100 + percent) >= need) & (F.col("reach") * (100 + percent) >= need))
    asked = cut(placed.join(matrix, "_k").where(meets).select("node", "n", "g", F.col("of").alias("other"), "size").distinct(), "asked")
    # A group of one class is a component of one, and so named by it.
    asked = cut(may_link(asked.where("size = 1"), classes, percent).union(asked.where("size > 1")).select("node", "n", "g"), "opened")
    # Each opened group is held against its queries in parts of bounded size; its members go to every part.
    dealt = _parts(asked.withColumnRenamed("g", "key"), "key", 4)
    members = dealt.select(F.col("key").alias("group"), "part").distinct().join(grouped.select("node", "group"), "group")
    rows = dealt.select(F.xxhash64("key", "part").alias("g"), "node", F.lit(1).alias("asks")).union(
        members.select(F.xxhash64("group", "part").alias("g"), "node", F.lit(0).alias("asks")))
    links = cut(open_groups(docs, classes, rows, n, percent), "links")

    # Components are joined where a class of one is linked to a class of another.
    own = grouped.select("node", "component")
    links = links.join(own.select(F.col("node").alias("a"), F.col("component").alias("u")), "a").join(own.select(F.col("node").alias("b"), F.col("component").alias("v")), "b")
    found = components(links, "u", "v").withColumnRenamed("component", "root")
    ends = own.join(found.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    named = classes.select("node", "one", "two", "doc_id").join(ends, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.select("one", "two", F.struct("component").alias("_k")).join(lowest.select(F.struct("component").alias("_k"), "component_id"), "_k")
    named = named.select(F.struct("one", "two").alias("_k"), "component_id")
    linked = sets.where("n > 0").withColumn("_k", F.struct("one", "two")).join(named, "_k")
    alone = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)
